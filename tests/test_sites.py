"""Seeds, parcels, sites and decisions on a small synthetic store: six parcels on a grid of about 111 m."""
import math

import pytest
from pyspark.sql import functions as F

from siteforge.functions import geo, text
from siteforge.operators import audit, joins, metrics, models, names, outcomes, ranking, sampling, sites, tiles, vectors
from siteforge.sources import readers, writers

LAT, LON, DLAT, DLON = 40.0, -100.0, 0.001, 0.0013
PARCELS = [("P1", 0, 0, 0.8, "CITY OF XVILLE"), ("P2", 1, 0, 0.8, "City of Xville."), ("P3", 0, 20, 0.8, "ACME LLC"), ("P4", 1, 20, 0.8, "SOMEONE ELSE"), ("BIG", 50, 0, 50.0, "TOWN")]


def centre(i, j):
    return LAT + (j + 0.4) * DLAT, LON + (i + 0.4) * DLON


@pytest.fixture(scope="module")
def parcels(spark):
    rows = []
    for name, i, j, share, owner in PARCELS:
        a, b = LAT + j * DLAT, LON + i * DLON
        ring = [(a, b), (a, b + share * DLON), (a + share * DLAT, b + share * DLON), (a + share * DLAT, b), (a, b)]
        rows += [(name, owner, k, la, lo) for k, (la, lo) in enumerate(ring)]
    x, y = geo.albers_xy(F.col("la"), F.col("lo"))
    d = spark.createDataFrame(rows, "ll_uuid string, owner string, k int, la double, lo double").withColumns({"x": x, "y": y})
    ring = F.transform(F.array_sort(F.collect_list(F.struct("k", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return d.groupBy("ll_uuid", "owner").agg(ring.alias("ring"))


def seeded(spark, rows):
    s = spark.createDataFrame(rows, "plant string, seed string, source string, origin string, lat double, lon double, independent boolean")
    x, y = geo.albers_xy(F.col("lat"), F.col("lon"))
    return s.withColumns({"x": x, "y": y})


A = [
    ("A", "a1", "cwns_point", "cwns", *centre(0, 0), True), ("A", "a2", "icis_fac_frs", "icis_facility", *centre(1, 0), True), ("A", "a3", "cwns_addr", "cwns", *centre(0, 0), True),
    ("A", "a4", "icis_feat_INF", "icis_feature", centre(0, 20)[0], LON - 0.0001, True), ("A", "a5", "icis_fac_addr", "icis_facility", LAT + 0.5, LON + 0.5, False),
]


def matched(spark, parcels, rows):
    s = seeded(spark, rows)
    return s.join(sites.seeds_to_parcels(s.select("seed", "x", "y"), parcels.select("ll_uuid", "ring"), 500.0).drop("x", "y"), "seed")


def test_seeds_fall_on_parcels(spark, parcels):
    m = {r.seed: r for r in matched(spark, parcels, A).collect()}
    assert (m["a1"].ll_uuid, m["a1"].match_kind, m["a2"].ll_uuid) == ("P1", "inside", "P2")
    assert (m["a4"].ll_uuid, m["a4"].match_kind) == ("P3", "snapped") and 0 < m["a4"].snap_m <= 100
    assert m["a5"].ll_uuid is None and m["a5"].match_kind == "none"


def test_sites_merge_count_and_rank(spark, parcels):
    sp, s = sites.build_sites(matched(spark, parcels, A), parcels)
    one, two = s.orderBy("site_rank").collect()
    assert one.ll_uuids == ["P1", "P2"] and one.rep_ll_uuid == "P1" and (one.n_seeds, one.n_origins) == (3, 2) and one.has_cwns_point and one.has_icis_fac_frs
    assert one.sources == "cwns_addr+cwns_point+icis_fac_frs" and one.is_best_site and one.n_sites == 2 and (one.n_unparcelled_seeds, one.plant_n_origins) == (1, 3)
    assert two.ll_uuids == ["P3"] and two.n_origins == 1 and two.snapped and not two.has_cwns_point
    assert 2000 < two.d_to_cwns_point_m < 2500 and abs(two.d_to_cwns_point_m - two.d_nearest_other_site_m) < 400
    got = {r.seed: r.site_id for r in sp.collect()}
    assert got["a4"] == "A_s2" and got["a5"] is None


def test_copies_owners_and_size_keep_sites_apart(spark, parcels):
    rows = [("B", "b1", "cwns_point", "cwns", *centre(0, 0), True), ("B", "b2", "icis_fac_frs", "icis_facility", *centre(0, 0), False)]
    b = sites.build_sites(matched(spark, parcels, rows), parcels)[1].first()
    assert (b.n_origins, b.n_origins_all) == (1, 2)
    rows = [("M", "m1", "cwns_point", "cwns", *centre(0, 20), True), ("M", "m2", "icis_fac_frs", "icis_facility", *centre(1, 20), True)]
    assert sites.build_sites(matched(spark, parcels, rows), parcels)[1].count() == 2
    pair = parcels.where("ll_uuid in ('P1', 'P2')").withColumn("plant", F.lit("x"))
    assert [(r.a, r.b) for r in sites.merge_edges(pair).collect()] == [("P1", "P2")] and sites.merge_edges(pair, largest=10.0).count() == 0
    assert sites.merge_edges(pair.withColumn("owner", F.lit(" -"))).count() == 0
    d = sites.copies(seeded(spark, A).withColumn("ord", F.substring("seed", 2, 1).cast("int")), "plant", "seed", "ord")
    assert {r.seed: r.copy_of for r in d.collect() if r.copy_of} == {"a3": "a1"}


def test_missing_points_become_seeds(spark):
    s = seeded(spark, A[1:3]).withColumn("copy_of", F.lit("")).drop("x", "y")
    plants = spark.createDataFrame([("A", *centre(0, 0)), ("Z", None, None)], "plant string, lat double, lon double")
    got = {r.seed: (r.source, r.independent, r.copy_of) for r in sites.with_plant_seeds(s, plants).collect()}
    assert got["A_cwns_point_1"] == ("cwns_point", True, "") and got["a3"][1:] == (False, "A_cwns_point_1") and got["a2"][1:] == (True, "") and len(got) == 3


def test_candidate_features(spark, parcels):
    m = matched(spark, parcels, A)
    _, s = sites.build_sites(m, parcels)
    la, lo = centre(0, 0)
    far = [("P1", 0.0), ("P2b", 400.0), ("P5", 1500.0), ("P9", 30000.0)]
    cand = spark.createDataFrame([("A", u, la + d / 111195.0, lo) for u, d in far] + [("E", "P1", la, lo)], "plant string, ll_uuid string, lat double, lon double")
    f = {(r.plant, r.ll_uuid): r for r in sites.seed_features(cand, seeded(spark, A), m, s).collect()}
    assert f["A", "P1"].n_origins_500m == 2 and f["A", "P1"].on_parcel_cwns_point and f["A", "P1"].seed_parcel_n_origins == 1 and f["A", "P1"].in_seed_site and f["A", "P1"].seed_site_is_best
    assert f["A", "P9"].n_origins_2km == 0 and not f["A", "P9"].on_seed_parcel and f["A", "P5"].n_origins_2km == 3 and f["A", "P2b"].n_origins_500m == 2
    assert f["E", "P1"].d_seed_nearest is None and f["E", "P1"].n_seeds_1km == 0 and f["E", "P1"].in_seed_site is False


def test_plant_decisions(spark, parcels):
    p1, p2, p3 = centre(0, 0), centre(1, 0), centre(0, 20)
    rows = [
        ("A", "A1", "cwns_point", "cwns", *p1, True), ("A", "A2", "icis_fac_frs", "icis_facility", *p2, True), ("A", "A3", "icis_feat_INF", "icis_feature", *p3, True), ("B", "B1", "cwns_point", "cwns", *p3, True), ("B", "B2", "icis_fac_frs", "icis_facility", *p1, True),
        ("D", "D1", "cwns_point", "cwns", *p1, True), ("D", "D2", "icis_fac_frs", "icis_facility", *p2, True), ("D", "D3", "icis_feat_INF", "icis_feature", *p3, True), ("D", "D4", "icis_fac_addr", "icis_facility", *p3, True),
    ]
    _, s = sites.build_sites(matched(spark, parcels, rows), parcels)
    plants = spark.createDataFrame([("A",), ("B",), ("D",), ("E",)], "plant string")

    def decide(osm, threshold):
        cols = {"rep": F.col("rep_ll_uuid"), "prob": F.col("n_origins") / 3, "osm": F.col("rep_ll_uuid").isin(*osm) if osm else F.lit(False), "lat": F.col("site_lat"), "lon": F.col("site_lon")}
        return {r.plant: r for r in outcomes.site_decision(s.withColumns(cols), plants, threshold).collect()}

    o = decide([], 0.6)
    assert (o["A"].trigger_reason, o["A"].accepted_sources, o["A"].reported_ll_uuid, o["A"].multi_pass) == ("none", "cwns_point+icis_fac_frs", "P1", False)
    assert (o["B"].trigger_reason, o["B"].accepted, o["B"].best_site_sources, o["B"].accepted_site_id) == ("low_confidence", False, "cwns_point", None)
    assert o["D"].trigger_reason == "none" and o["D"].multi_pass and o["D"].alt_dist_m > 2000 and o["D"].n_sites == 2
    assert (o["E"].trigger_reason, o["E"].route) == ("no_parcel", "no_parcel")
    b = decide(["P3"], 0.99)["B"]
    assert (b.route, b.reported_ll_uuid, b.trigger_reason) == ("osm_confirmed", "P3", "none")


def test_final_statuses(spark):
    cols = "k string, Verified string, Original_Correct string, Corrected_X double, Corrected_Y double, How_Corrected string, route string, trigger_reason string, accepted_sources string, top string, top_score double, fallback boolean, top_lat double, top_lon double, reported_in_site boolean, reported_lat double, reported_lon double, state_scored boolean, pop_ok boolean, pop_band string"
    plain = dict(Verified=None, Original_Correct=None, Corrected_X=None, Corrected_Y=None, How_Corrected=None, route="model", trigger_reason="none", accepted_sources="cwns_point", top=None, top_score=None, fallback=False, top_lat=None, top_lon=None, reported_in_site=False, reported_lat=40.0, reported_lon=-100.0, state_scored=True, pop_ok=True, pop_band=">1k")
    low = dict(trigger_reason="low_confidence", accepted_sources=None, top="T", top_score=0.95, top_lat=40.01, top_lon=-100.0)
    rows = {
        "A": {}, "B": dict(accepted_sources="icis_fac_frs", top_lat=40.02, top_lon=-100.0), "C": low, "D": dict(Verified="Yes", Original_Correct="No", Corrected_X=-100.1, Corrected_Y=40.1, How_Corrected="manual"), "E": low | dict(top_score=0.5),
        "F": dict(route=None, trigger_reason=None, state_scored=False), "G": low | dict(top_lat=None, top_lon=None), "H": low | dict(reported_in_site=True), "I": dict(Original_Correct="No"), "J": low | dict(fallback=True, pop_band="100-1k"),
    }
    names_ = [c.split()[0] for c in cols.split(", ")]
    df = spark.createDataFrame([tuple(({"k": k} | plain | more)[c] for c in names_) for k, more in rows.items()], cols)
    o = {r.k: r for r in outcomes.corrected_output(df, 0.9).collect()}
    want = {"A": "kept_model", "B": "moved", "C": "moved", "D": "verified_corrected", "E": "flagged_not_moved", "F": "not_assessed", "G": "flagged_not_moved", "H": "kept_site", "I": "reviewed_unresolved", "J": "moved"}
    assert {k: r.status for k, r in o.items()} == want
    assert o["B"].loc_basis == "stage1_accept_seed" and o["C"].loc_basis == "stage2_move" and o["D"].loc_basis == "reviewer" and o["F"].status_reason == "no_imagery_state" and o["G"].status_reason == "move_parcel_not_found"
    assert (o["D"].out_lat, o["D"].out_lon, o["D"].confidence_tier) == (40.1, -100.1, "verified") and o["C"].moved_m > 1000 and o["A"].moved_m == 0 and o["J"].confidence_tier == "model_small_plant"
    assert outcomes.corrected_output(df, 0.9, True).where("k = 'J'").first().status == "flagged_not_moved"


def test_holdout_outcomes(spark):
    rows = [("A", "none", ["P1"], "P1", None, "P1"), ("B", "none", ["P1"], "P1", None, "P9"), ("C", "low_confidence", None, "P1", "P3", "P3"), ("D", "no_parcel", None, None, "P3", "P4"), ("E", "none", None, "P1", None, None), ("F", "none", None, "P1", None, "P1")]
    df = spark.createDataFrame(rows, "k string, t string, site array<string>, rep string, top string, truth string")
    o = df.select("k", outcomes.holdout_outcome(F.lit(True), *[F.col(c) for c in ("truth", "t", "site", "rep", "top")]).alias("o"))
    assert [r.o for r in o.orderBy("k").collect()] == ["accepted_right", "accepted_wrong", "moved_right", "flagged_wrong", "truth_unresolved", "accepted_right"]


def test_names_match_like_the_rules(spark):
    df = spark.createDataFrame([(1, "Bigtown Creek WWTP", "BIGTOWN CREEK SD"), (2, "Bigtwn Plant", "Bigtown LLC"), (3, "BCWSA Plant", "Bucks County Water & Sewer Authority"), (4, "Bucks County Water & Sewer Authority", "BCWSA"), (5, "Springfield Plant", "Jones"), (6, "x", None), (7, "igtown Plant", "Bigtown")], "k int, name string, owner string")
    idf, default = names.idf_table(df)
    got = {r.k: (r.name_match_score, r.name_match_available) for r in names.name_scores(df, "name", "owner", idf, default).collect()}
    assert got[1][0] == pytest.approx(1.0) and 0.88 < got[2][0] < 1 and got[3][0] == pytest.approx(1.0) and got[4][0] == 1.0 and got[5] == (0.0, True) and got[6] == (0.0, False)
    assert got[7][0] > 0.88  # a typo at the word's start


def test_similar_tokens_are_exact(spark):
    words = ["bigtown", "igtown", "bigtowns", "bgtown", "xigtown", "springfield", "spingfield", "springfeld", "creek", "creeks", "abcdefghij", "abcdefghi", "bcdefghijk", "zzz", "a"]
    d = spark.createDataFrame([(w,) for w in words], "tok string")
    got = {(r.tok, r.u) for r in names.similar_tokens(d, d.withColumnRenamed("tok", "u")).collect()}
    assert got == {(a, b) for a in words for b in words if 200 * text._lcs(a, b) / (len(a) + len(b)) >= 88}


def test_distances_anywhere(spark):
    import random

    rng = random.Random(1)
    for lat0, lon0 in ((65.0, 10.0), (71.9, 179.95), (-89.9, 0.0), (0.0, -179.99)):
        a = [(i, lat0 + rng.uniform(-0.1, 0.1), (lon0 + rng.uniform(-0.2, 0.2) + 180) % 360 - 180) for i in range(60)]
        h = lambda p, q: 2 * 6371008.8 * math.asin(math.sqrt(min(1, math.sin(math.radians(q[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(q[1])) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2)))
        want = {(p[0], q[0]) for p in a for q in a if h(p, q) <= 5000}
        left = spark.createDataFrame(a, "k int, lat double, lon double")
        right = spark.createDataFrame(a, "o int, rlat double, rlon double")
        assert {(r.k, r.o) for r in joins.within_distance(left, right, 5000.0).collect()} == want


def test_best_row_takes_text_ids(spark):
    df = spark.createDataFrame([("p", "b", 1.0), ("p", "a", 1.0), ("q", "c", None)], "place string, plant string, s double")
    assert {(r.place, r.plant) for r in ranking.best_row(df, ["place"], "s", "plant").collect()} == {("p", "a"), ("q", "c")}


def test_running_sums_quantiles_and_mcnemar(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    r = metrics.running(df, [F.col("v")], {"n": F.lit(1)}).where("n <> v + 1")
    assert r.isEmpty()
    q = {x.share: x.value for x in metrics.quantiles(df, "v", [0.0, 0.25, 0.5, 1.0]).collect()}
    assert q == {0.0: 0.0, 0.25: 249.75, 0.5: 499.5, 1.0: 999.0}
    p = spark.createDataFrame([(20, 7), (0, 0), (5, 5)], "b long, c long").select(metrics.mcnemar(F.col("b"), F.col("c")).alias("p")).collect()
    assert p[0].p == pytest.approx(2 * sum(math.comb(27, i) for i in range(8)) / 2**27) and p[1].p == 1.0 and p[2].p == 1.0


def test_shapes(spark):
    ring = lambda pts: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in pts])
    u = ring([(0, 0), (9, 0), (9, 9), (6, 9), (6, 3), (3, 3), (3, 9), (0, 9), (0, 0)])  # its centroid is in the gap
    d = tiles.interior_points(spark.range(1).select(u.alias("ring")))
    p = d.first()
    assert p.point_method == "polylabel" and d.select(geo.in_ring(F.col("ring"), F.col("px"), F.col("py")).alias("i"), geo.ring_distance(F.col("ring"), F.col("px"), F.col("py")).alias("d")).first().i
    s = spark.range(1).select(geo.surface_point(u).alias("p"), u.alias("u")).select(geo.in_ring(F.col("u"), F.col("p.x"), F.col("p.y")).alias("i")).first()
    assert s.i
    box = lambda a, b, c, e: ring([(a, b), (c, b), (c, e), (a, e), (a, b)])
    g = spark.range(1).select(geo.ring_gap(box(0, 0, 1, 1), box(4, 5, 6, 6)).alias("a"), geo.ring_gap(box(0, 0, 9, 9), box(2, 2, 3, 3)).alias("b"), geo.ring_gap(box(0, 4, 9, 5), box(4, 0, 5, 9)).alias("c")).first()
    assert g.a == pytest.approx(5.0) and g.b == 0 and g.c == 0
    x, y = geo.albers_xy(F.lit(35.0), F.lit(-75.0), (6378206.4, 0.00676866))
    xy = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert (round(xy.x, 1), round(xy.y, 1)) == (1885472.7, 1535925.0)  # the published example, on the Clarke 1866 ellipsoid


def test_tiles_and_views(spark):
    big = spark.createDataFrame([(1, 60000.0), (2, 100.0)], "k int, w double").select("k", geo.box_ring(F.lit(0.0), F.lit(0.0), F.col("w"), F.lit(2000.0)).alias("ring"))
    d = {r.k: r for r in tiles.capped(big, F.lit(1), F.lit(None).cast("double"), F.lit(None).cast("double")).collect()}
    assert d[1].cap_reason == "area" and d[2].cap_reason is None and len(d[1].footprint) == 5
    w = spark.createDataFrame([(0.0, 0.0, 900.0, 700.0)], "x0 double, y0 double, x1 double, y1 double")
    cells = {(r.q, r.r) for r in tiles.cells_of_box(w).collect()}
    q, r = geo.hex_cell(F.col("x"), F.col("y"))
    fine = spark.range(91).select((F.col("id") * 10.0).alias("x")).crossJoin(spark.range(71).select((F.col("id") * 10.0).alias("y"))).select(q.alias("q"), r.alias("r")).distinct()
    assert {(c.q, c.r) for c in fine.collect()} <= cells
    pts = spark.createDataFrame([(i, 40.0, -100.0) for i in range(5)], "k int, lat double, lon double")
    rows, big_, cut = tiles.view(pts, -100.01, 39.99, -99.99, 40.01, "k", 3)
    assert rows.count() == 3 and not big_ and cut and tiles.view(pts, -101.0, 39.0, -99.0, 41.0, "k")[1]


def test_gates_folds_and_samples(spark, tmp_path):
    df = spark.range(10).withColumn("ok", F.col("id") < 9)
    with pytest.raises(ValueError):
        audit.require(audit.gates(df, {"g": (F.col("ok"), 0.95)}))
    with pytest.raises(ValueError):
        audit.paired(df, df.where("id < 5"), "id")
    with pytest.raises(KeyError):
        outcomes.aligned(df, ["id", "gone"])
    with pytest.raises(TypeError):
        outcomes.aligned(df.withColumn("a", F.array("id")), ["a"])
    with pytest.raises(ValueError):
        outcomes.reserve(df, df.where("id = 3"), "id")
    d = spark.range(5000).select("id", (F.col("id") < 10).alias("pos"), ((F.col("id") >= 10) & (F.col("id") < 30)).alias("seed"))
    n = sampling.negatives(d, "id", F.col("pos"), F.col("seed"), F.col("id") % 2 == 0, 50, 0.7)
    assert n.where("pos").count() == 10 and n.where("not pos").count() == 500 and n.where("seed").count() == 20
    pts = spark.range(200).select("id", (F.col("id") % 10).alias("g"), (F.col("id") % 10 * 1.0).alias("lat"), F.lit(0.0).alias("lon"))
    folds = models.group_folds(pts, "g", folds=2, blocks=4)
    assert folds.count() == 10 and folds.select("fold").distinct().count() == 2
    y = spark.range(100).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2).cast("double").alias("copy"))
    with pytest.raises(ValueError):
        models.refuse_leaks(models.leaks(y, ["copy"], "y"))
    e = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0])], "k int, e array<double>")
    assert {(r.q, r.v) for r in vectors.similar(e, e, "k", "e", 0.9).collect()} == {(1, 2), (2, 1)}
    old = str(tmp_path / "t")
    df.write.parquet(old)
    with pytest.raises(ValueError):
        writers.replace_table(df.limit(2), old, 3)
    assert spark.read.parquet(old).count() == 10 and readers.footer(spark, old)[0] == 10


def test_text_rules(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    assert one(text.norm_name(F.lit("St. Paul WWTP #2 & Co"))) == "saint paul wastewater treatment plant number 2 and county"
    assert one(text.acronym_hit(F.lit("bcwsa"), F.lit("bcwsa"))) and one(text.acronym_hit(F.lit("bcw"), F.lit("bcwsa"))) and not one(text.acronym_hit(F.lit("bc"), F.lit("bcwsa")))
    assert one(text.address_class(F.lit("c/o P.O. Box 7"))) == "po_box" and one(text.clean_placeholder(F.lit(" unk "))) == ""
    t = one(text.tile_name(F.lit("0a1b2c3d-17000281001_6fcc5c83-0000-0000-0000-143ad9895c1e_r01_c01_rgb.txt")))
    assert t.site == "17000281001" and one(text.tile_name(F.lit("TRI_12345ABCDE_r01_c01.txt"))).site == "TRI_12345ABCDE" and one(text.tile_name(F.lit("junk.txt"))) is None
    assert one(text.keep_ends(F.lit("10%\r20%\r100%\nok"), 50, 50)) == "100%\nok"
    assert one(text.source_category(F.lit("cwns_addr+icis_fac_addr"))).startswith("Both") and one(text.source_category(F.lit("icis_feat_INF+icis_feat_INO"))) == "ICIS permit feature (INF/INO)"


def test_interior_points_far_from_the_origin(spark):
    """The centroid keeps its digits, and the ring's expression stands in the plan a few times only (2740 before)."""
    s = F.col("id").cast("double") * 8192
    d = tiles.interior_points(spark.range(1000).select("id", geo.box_ring(s + 1e8, s + 3e8, s + 1e8 + 10, s + 3e8 + 7).alias("ring")))
    assert d._jdf.queryExecution().optimizedPlan().toString().count("cast(id") < 100
    assert d.where("point_method <> 'centroid' or abs(px - 1e8 - id * 8192 - 5) > 1e-6 or abs(py - 3e8 - id * 8192 - 3.5) > 1e-6").isEmpty()
    assert d.count() == 1000


def test_coverage_ends_with_the_raster(spark):
    z = spark.createDataFrame([(1, -10.0, 65.0), (2, 200.0, 5.0)], "zone long, x double, y double").select("zone", geo.box_ring(F.col("x"), F.col("y"), F.col("x") + 40, F.col("y") + 40).alias("ring"))
    got = {(r.zone, r.px, r.py) for r in tiles.coverage(z, 30.0, (4, 3)).collect()}
    assert got == {(1, 0, 2)} and tiles.coverage(z, 30.0).count() == 8


def test_points_share_places(spark):
    """points_in_boxes and close_by_place look a place up once and still give every row there."""
    pts = [(i, float(i % 5), float(i % 3)) for i in range(60)]
    box = [(j, j - 1.0, 0.0, j + 0.5, 1.0) for j in range(5)]
    p, b = spark.createDataFrame(pts, "k long, x double, y double"), spark.createDataFrame(box, "b long, x0 double, y0 double, x1 double, y1 double")
    got = joins.points_in_boxes(p, b, 0.75)
    assert got.columns == ["k", "x", "y", "b", "x0", "y0", "x1", "y1"]
    assert sorted((r.k, r.b) for r in got.collect()) == sorted((k, j) for k, x, y in pts for j, x0, y0, x1, y1 in box if x0 <= x <= x1 and y0 <= y <= y1)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1  # places, before the cells are joined
    ll = spark.createDataFrame([(i, 70.0 + (i * 7 % 4) / 100, 179.99 if i % 2 else -179.99) for i in range(40)], "k long, lat double, lon double")
    right = ll.select(F.col("k").alias("o"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    want = sorted((r.k, r.o) for r in joins.within_distance(ll, right, 1500.0).where("k < o").collect())
    assert sorted(map(tuple, joins.close_by_place(ll, "k", 1500.0).collect())) == want and len(want) > 100


def test_corners_as_rings(spark):
    c = [(F.lit(0.0), F.lit(0.0)), (F.lit(4.0), F.lit(0.0)), (F.lit(1.0), F.lit(2.0)), (F.lit(0.0), F.lit(4.0))]
    ring = F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in [*c, c[0]]])
    p = spark.range(400).select((F.col("id") % 20 / 4 - 0.5).alias("x"), (F.floor(F.col("id") / 20) / 4 - 0.5).alias("y"))
    d = p.select(geo.in_corners(c, F.col("x"), F.col("y")).alias("a"), geo.in_ring(ring, F.col("x"), F.col("y")).alias("b"))
    assert d.where("a <> b or a is null").isEmpty() and 0 < d.where("a").count() < 400


def test_iou_pairs(spark):
    """Every pair once, in any shape: long and flat boxes too, and shared cells don't repeat it."""
    import random

    rnd = random.Random(7)
    rows = [(i, x, y, x + rnd.choice([0.0, 0.3, 1.0, 3.0]) * rnd.random(), y + rnd.choice([0.2, 1.0, 3.0]) * rnd.random()) for i in range(300) for x, y in [(rnd.uniform(-2, 2), rnd.uniform(-2, 2))]]
    rows += [(300 + i, 0.0, 0.0, 1.0, 1.0) for i in range(3)]

    def iou(a, b):
        w, h = max(0.0, min(a[3], b[3]) - max(a[1], b[1])), max(0.0, min(a[4], b[4]) - max(a[2], b[2]))
        u = (a[3] - a[1]) * (a[4] - a[2]) + (b[3] - b[1]) * (b[4] - b[2]) - w * h
        return w * h / u if u > 0 else 0.0

    d = spark.createDataFrame(rows, "k long, x0 double, y0 double, x1 double, y1 double")
    for least in (0.0, 0.2, 0.6):
        want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and iou(a, b) > least)
        got = joins.iou_pairs(d, "k", least, 0.25)
        assert sorted(map(tuple, got.collect())) == want and want
        assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_site_points_far_from_the_origin(spark):
    """A site's point without objects keeps its digits, and its ring's expression stands in the plan a few times only."""
    s = F.col("id").cast("double") * 8192
    d = spark.range(50).select(F.col("id").alias("site"), geo.box_ring(s + 1e8, s + 3e8, s + 1e8 + 10, s + 3e8 + 7).alias("ring"), F.lit(True).alias("seed"))
    p = tiles.site_points(d, spark.createDataFrame([(1, 1e8 + 8193.0, 3e8 + 8194.0, 0.9)], "site long, x double, y double, conf double"))
    assert p._jdf.queryExecution().optimizedPlan().toString().count("cast(id") < 200
    got = {r.site: (r.x, r.y, r.coord_method) for r in p.collect()}
    assert len(got) == 50 and got[1] == (1e8 + 8193.0, 3e8 + 8194.0, "objects") and got[2] == (1e8 + 16384 + 5, 3e8 + 16384 + 3.5, "centroid")


def test_rings_of_four_corners_by_arithmetic(spark):
    """Boxes, bent and crossed quadrilaterals, and those without area or end give the same point by arithmetic as by the general way; a
    site's objects are reduced to places before any ring is tested."""
    import random

    rnd = random.Random(3)
    rings = [[(rnd.uniform(-9, 9) + 1e5, rnd.uniform(-9, 9)) for _ in range(4)] for _ in range(60)]
    rings += [[(0.0, 0.0), (4.0, 4.0), (2.0, 2.0), (1.0, 1.0)], [(3.0, 3.0)] * 4, [(0.0, 0.0), (4.0, 0.0), (1.0, 1.0), (0.0, 4.0)]]
    rings = [[*r, r[0]] for r in rings] + [[(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 3.0), (9.0, 9.0)]]
    d = spark.createDataFrame(list(enumerate(rings)), "k long, ring array<struct<x:double,y:double>>")
    r = F.col("ring")
    four, corners = geo.four_corners(r)
    assert d.where(four).count() == len(rings) - 1
    near = lambda a, b: F.abs(a["x"] - b["x"]) + F.abs(a["y"] - b["y"]) < 1e-9
    assert d.where(four & ~near(geo.corners_centroid(corners), geo.centroid(r))).count() == 0
    c = geo.centroid(r)
    want = {x.k: "centroid" if x.i else "polylabel" for x in d.select("k", geo.in_ring(r, c["x"], c["y"]).alias("i")).collect()}
    got = {x.k: x.point_method for x in tiles.interior_points(d).collect()}
    assert got == want and set(got.values()) == {"centroid", "polylabel"}
    objects = spark.createDataFrame([(1, 1.0, 1.0, 0.9)] * 5, "site long, x double, y double, conf double")
    sites = d.select(F.col("k").alias("site"), "ring", F.lit(True).alias("seed"))
    plan = tiles.site_points(sites, objects)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    tested = next(i for i, line in enumerate(plan) if "Join Inner" in line and "exists" in line)
    assert any("Aggregate [site" in line for line in plan[tested:])
