"""From seeds to sites: copies, parcels under seeds, parcels merged into sites, ranked evidence, candidate features."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.functions import geo, text
from siteforge.operators import cluster, joins

# Sources in order, distances in metres, areas in square metres.
SOURCES = ["cwns_point", "cwns_addr", "icis_fac_frs", "icis_fac_addr", "icis_feat_INF", "icis_feat_INO"]
COPY_M, SNAP_M, GAP_M, MAX_AREA_M2 = 1.0, 100.0, 50.0, 2_000_000.0


def copies(seeds: DataFrame, plant: str, seed: str, ord_: str, metres: float = COPY_M) -> DataFrame:
    """seeds (plant, seed, ord, lat, lon) with copy_of: the earliest seed of the same plant within `metres` that comes before."""
    b = seeds.select(F.col(plant).alias("p_"), F.col(seed).alias("s_"), F.col(ord_).alias("o_"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    near = joins.within_distance(seeds, b, metres).where((F.col(plant) == F.col("p_")) & (F.col("o_") < F.col(ord_)))
    first = near.groupBy(plant, seed).agg(F.min(F.struct("o_", "s_"))["s_"].alias("copy_of"))
    return seeds.join(first, [plant, seed], "left")


def with_plant_seeds(seeds: DataFrame, plants: DataFrame) -> DataFrame:
    """seeds (plant, seed, source, origin, lat, lon, independent, copy_of) of the plants (plant, lat, lon), and a cwns_point seed at
    the plant's own coordinates for each that has none. Seeds within COPY_M of it become its copies."""
    own = seeds.join(plants.select("plant").distinct(), "plant", "left_semi")
    have = own.where("source = 'cwns_point'").select("plant").distinct()
    new = plants.where("lat is not null and lon is not null").dropDuplicates(["plant"]).join(have, "plant", "left_anti")
    add = new.select("plant", F.concat("plant", F.lit("_cwns_point_1")).alias("seed"), F.lit("cwns_point").alias("source"), F.lit("cwns").alias("origin"), "lat", "lon", F.lit(True).alias("independent"), F.lit("").alias("copy_of"))
    d = own.join(add.select("plant", F.col("seed").alias("s_"), F.col("lat").alias("la"), F.col("lon").alias("lo")), "plant", "left")
    near = F.coalesce(geo.haversine_m(F.col("lat"), F.col("lon"), F.col("la"), F.col("lo")) <= COPY_M, F.lit(False))
    d = d.withColumns({"independent": F.col("independent") & ~near, "copy_of": F.when(near, F.col("s_")).otherwise(F.coalesce("copy_of", F.lit("")))}).drop("s_", "la", "lo")
    return d.unionByName(add, allowMissingColumns=True)


def seeds_to_parcels(seeds: DataFrame, parcels: DataFrame, cell: float, snap: float = SNAP_M) -> DataFrame:
    """seeds (seed, x, y) with ll_uuid, match_kind (inside, snapped, none) and snap_m; parcels (ll_uuid, ring), all in metres.

    Inside wins, ties to the lowest id; else the nearest parcel within `snap`. Both sides meet on grid cells that the parcel's box
    covers, widened by `snap`.
    """
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    boxes = parcels.select("ll_uuid", "ring", (F.array_min(xs) - snap).alias("x0"), (F.array_min(ys) - snap).alias("y0"), (F.array_max(xs) + snap).alias("x1"), (F.array_max(ys) + snap).alias("y1"))
    near = joins.points_in_boxes(seeds.select("seed", "x", "y"), boxes, cell).withColumn("d", geo.ring_distance(F.col("ring"), F.col("x"), F.col("y"))).where(F.col("d") <= snap)
    best = near.groupBy("seed").agg(F.min(F.struct("d", "ll_uuid")).alias("m")).select("seed", "m.*")
    kind = F.when(F.col("ll_uuid").isNull(), "none").when(F.col("d") == 0, "inside").otherwise("snapped")
    return seeds.join(best, "seed", "left").withColumns({"match_kind": kind, "snap_m": F.col("d")}).drop("d")


def merge_edges(parcels: DataFrame, gap: float = GAP_M, largest: float = MAX_AREA_M2) -> DataFrame:
    """(plant, a, b): pairs of one plant's parcels (plant, ll_uuid, owner, ring) of one non-empty owner, none oversized, at most `gap` apart."""
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    box = F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))
    p = parcels.select("plant", F.col("ll_uuid").alias("a"), text.norm_owner(F.col("owner")).alias("o"), F.col("ring").alias("ra"), box.alias("ba"), geo.ring_area(F.col("ring")).alias("area")).where(f"o <> '' and area <= {largest}").drop("area")
    q = p.select("plant", F.col("a").alias("b"), "o", F.col("ra").alias("rb"), F.col("ba").alias("bb"))
    # boxes first: few pairs need their shapes compared
    near = f"a < b and ba.x0 - bb.x1 <= {gap} and bb.x0 - ba.x1 <= {gap} and ba.y0 - bb.y1 <= {gap} and bb.y0 - ba.y1 <= {gap}"
    return p.join(q, ["plant", "o"]).where(near).select("plant", "a", "b", geo.ring_gap(F.col("ra"), F.col("rb")).alias("gap_")).where(f"gap_ <= {gap}").drop("gap_")


def build_sites(matched: DataFrame, parcels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matched with site_id, sites): matched (plant, seed, source, origin, independent, lat, lon, ll_uuid, match_kind) and the geometry
    and owners of its parcels (ll_uuid, owner, ring in metres).

    Parcels of one plant merge by merge_edges. Sites rank by independent origins, independent seeds, the plant's own point, then their
    parcel's id. The representative parcel holds the plant's own point, else most independent seeds (all seeds if none is independent).
    """
    have = matched.where("ll_uuid is not null")
    own = have.select("plant", "ll_uuid").distinct()
    shaped = own.join(parcels, "ll_uuid")
    label = cluster.components(own.select("plant", F.col("ll_uuid").alias("node")), merge_edges(shaped), "plant").withColumnRenamed("node", "ll_uuid")
    m = have.join(label, ["plant", "ll_uuid"])
    counts = m.groupBy("plant", "label", "ll_uuid").agg(F.bool_or(F.col("source") == "cwns_point").alias("point"), F.count_if("independent").alias("ind"), F.count(F.lit(1)).alias("n"))
    some = W.partitionBy("plant", "label")
    counts = counts.withColumn("score", F.when(F.sum("ind").over(some) > 0, F.col("ind")).otherwise(F.col("n")))
    rep = counts.groupBy("plant", "label").agg(F.min(F.struct(~F.col("point"), -F.col("score"), "ll_uuid"))["ll_uuid"].alias("rep_ll_uuid"))
    big = shaped.select("plant", "ll_uuid", (geo.ring_area(F.col("ring")) > MAX_AREA_M2).alias("big"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "+")
    has = [F.bool_or(F.col("source") == s).alias(f"has_{s}") for s in SOURCES]
    sites = m.join(big, ["plant", "ll_uuid"], "left").groupBy("plant", "label").agg(
        F.array_sort(F.collect_set("ll_uuid")).alias("ll_uuids"), F.count_distinct("ll_uuid").alias("site_n_parcels"), F.array_sort(F.collect_list("seed")).alias("seed_ids"), joined("source").alias("sources"),
        F.count(F.lit(1)).alias("n_seeds"), F.count_if("independent").alias("n_independent_seeds"), F.count_distinct(F.when(F.col("independent"), F.col("origin"))).alias("n_origins"), F.count_distinct("origin").alias("n_origins_all"),
        F.avg("lat").alias("site_lat"), F.avg("lon").alias("site_lon"), F.coalesce(F.bool_or("big"), F.lit(False)).alias("oversized"), F.bool_or(F.col("match_kind") == "snapped").alias("snapped"), *has,
    ).join(rep, ["plant", "label"])
    sites = sites.withColumns({"has_cwns": F.col("has_cwns_point") | F.col("has_cwns_addr"), "has_icis": F.greatest(*[F.col(f"has_{s}") for s in SOURCES if s.startswith("icis")])})
    order = W.partitionBy("plant").orderBy(F.desc("n_origins"), F.desc("n_independent_seeds"), F.desc("has_cwns_point"), "rep_ll_uuid")
    sites = sites.withColumn("site_rank", F.row_number().over(order))
    sites = sites.withColumns({"site_id": F.concat("plant", F.lit("_s"), F.col("site_rank").cast("string")), "is_best_site": F.col("site_rank") == 1, "n_sites": F.count(F.lit(1)).over(W.partitionBy("plant"))})
    own_point = F.min(F.when(F.col("source") == "cwns_point", F.struct("seed", "lat", "lon")))
    plants = matched.groupBy("plant").agg(
        F.count_distinct(F.when(F.col("independent"), F.col("origin"))).alias("plant_n_origins"), F.count(F.lit(1)).alias("plant_n_seeds"), F.count_if(F.col("ll_uuid").isNull()).alias("n_unparcelled_seeds"), own_point.alias("pt")
    )
    sites = sites.join(plants, "plant").withColumn("d_to_cwns_point_m", geo.haversine_m(F.col("pt.lat"), F.col("pt.lon"), F.col("site_lat"), F.col("site_lon"))).drop("pt")
    other = sites.select("plant", F.col("site_id").alias("o_"), F.col("site_lat").alias("ola"), F.col("site_lon").alias("olo"))  # a plant's few sites
    far = sites.select("plant", "site_id", "site_lat", "site_lon").join(other, "plant").where("site_id <> o_")
    far = far.groupBy("plant", "site_id").agg(F.min(geo.haversine_m(F.col("site_lat"), F.col("site_lon"), F.col("ola"), F.col("olo"))).alias("d_nearest_other_site_m"))
    sites = sites.join(far, ["plant", "site_id"], "left")
    named = label.join(sites.select("plant", "label", "site_id"), ["plant", "label"]).select("plant", "ll_uuid", "site_id")
    return matched.join(named, ["plant", "ll_uuid"], "left"), sites.drop("label")


def seed_features(cand: DataFrame, seeds: DataFrame, matched: DataFrame, sites: DataFrame) -> DataFrame:
    """cand (plant, ll_uuid, lat, lon) with the evidence of its plant's seeds; every column has its default where a plant has none.

    seeds (plant, seed, source, origin, lat, lon, independent); matched (plant, seed, ll_uuid); sites (plant, ll_uuids, n_origins, is_best_site).
    """
    s = seeds.select("plant", "source", "origin", "independent", F.col("lat").alias("sla"), F.col("lon").alias("slo"))
    d = cand.join(s, "plant").withColumn("d", geo.haversine_m(F.col("lat"), F.col("lon"), F.col("sla"), F.col("slo")))
    within = lambda r: F.count_distinct(F.when(F.col("independent") & (F.col("d") <= r), F.col("origin")))
    dist = [F.min(F.when(F.col("source") == x, F.col("d"))).alias(f"d_seed_{x}") for x in SOURCES]
    near = d.groupBy("plant", "ll_uuid").agg(
        *dist, F.min("d").alias("d_seed_nearest"), F.min(F.when(F.col("independent"), F.col("d"))).alias("d_seed_nearest_indep"), within(500).alias("n_origins_500m"), within(1000).alias("n_origins_1km"),
        within(2000).alias("n_origins_2km"), F.count_if(F.col("independent") & (F.col("d") <= 1000)).alias("n_seeds_1km"),
    )
    on = matched.where("ll_uuid is not null").select("plant", "seed", "ll_uuid").join(seeds.select("plant", "seed", "source", "origin", "independent"), ["plant", "seed"]).groupBy("plant", "ll_uuid").agg(
        F.lit(True).alias("on_seed_parcel"), F.count_distinct(F.when(F.col("independent"), F.col("origin"))).alias("seed_parcel_n_origins"), F.bool_or(F.col("source") == "cwns_point").alias("on_parcel_cwns_point"),
        F.bool_or(F.col("source") == "cwns_addr").alias("on_parcel_cwns_addr"), F.bool_or(F.col("source").startswith("icis")).alias("on_parcel_icis"),
    )
    part = sites.select("plant", F.explode("ll_uuids").alias("ll_uuid"), "n_origins", "is_best_site").groupBy("plant", "ll_uuid").agg(F.max(F.struct("n_origins", "is_best_site")).alias("m"))
    part = part.select("plant", "ll_uuid", F.lit(True).alias("in_seed_site"), F.col("m.n_origins").alias("seed_site_n_origins"), F.col("m.is_best_site").alias("seed_site_is_best"))
    out = cand
    for more in (near, on, part):
        out = out.join(more, ["plant", "ll_uuid"], "left")
    counts = ["n_origins_500m", "n_origins_1km", "n_origins_2km", "n_seeds_1km", "seed_parcel_n_origins", "seed_site_n_origins"]
    flags = ["on_seed_parcel", "on_parcel_cwns_point", "on_parcel_cwns_addr", "on_parcel_icis", "in_seed_site", "seed_site_is_best"]
    return out.na.fill(0, counts).na.fill(False, flags)


def without_reported(cand: DataFrame, reported: DataFrame) -> DataFrame:
    """Candidates (plant, ll_uuid) less each plant's reported parcel."""
    return cand.join(reported.select("plant", "ll_uuid"), ["plant", "ll_uuid"], "left_anti")


def provenance(df: DataFrame, seeds: DataFrame, metres: float = 250.0) -> DataFrame:
    """df (plant, lat, lon) with loc_sources and loc_n_origins (seeds within `metres`), nearest_source (all within a metre of the nearest) and its distance."""
    s = seeds.select("plant", "source", "origin", "independent", F.col("lat").alias("sla"), F.col("lon").alias("slo"))
    d = df.select("plant", "lat", "lon").join(s, "plant").withColumn("d", geo.haversine_m(F.col("lat"), F.col("lon"), F.col("sla"), F.col("slo")))
    low = d.groupBy("plant").agg(F.min("d").alias("low"))
    joined = lambda on: F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(on, F.col("source")))), "+"), F.lit(""))
    near = F.col("d") <= metres
    agg = d.join(low, "plant").groupBy("plant").agg(
        joined(near).alias("loc_sources"), F.count_distinct(F.when(near & F.col("independent"), F.col("origin"))).alias("loc_n_origins"), joined(F.col("d") <= F.col("low") + 1.0).alias("nearest_source"), F.min("d").alias("nearest_m")
    )
    return df.join(agg, "plant", "left").na.fill(0, ["loc_n_origins"])


def consensus(points: DataFrame, plants: DataFrame) -> DataFrame:
    """(plant, category, n_origins, consensus_origins, n_clusters, lat, lon) of points (plant, label, origin, is_cwns, lat, lon), whose label
    is their cluster. The best cluster has most origins, then most points; its centre is the mean of its points."""
    c = points.groupBy("plant", "label").agg(F.count_distinct("origin").alias("o"), F.count(F.lit(1)).alias("n"), F.bool_or("is_cwns").alias("has"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    total = points.groupBy("plant").agg(F.count_distinct("origin").alias("n_origins"), F.bool_or("is_cwns").alias("any_cwns"))
    rank = F.row_number().over(W.partitionBy("plant").orderBy(F.desc("o"), F.desc("n"), "label"))
    top = c.withColumn("r", rank).groupBy("plant").agg(
        F.count(F.lit(1)).alias("n_clusters"), F.max(F.when(F.col("r") == 1, F.struct("o", "n", "has", "lat", "lon"))).alias("a"), F.max(F.when(F.col("r") == 2, F.struct("o", "n"))).alias("b")
    )
    d = plants.join(total, "plant", "left").join(top, "plant", "left")
    tie = F.coalesce((F.col("a.o") == F.col("b.o")) & (F.col("a.n") == F.col("b.n")), F.lit(False))
    category = (
        F.when(F.col("n_clusters").isNull(), "no_location").when(F.col("n_origins") < 2, "thin").when(F.col("n_clusters") == 1, "all_agree").when(F.col("a.o") < 2, "no_consensus")
        .when(tie, "split").when(~F.col("any_cwns"), "cwns_missing").when(F.col("a.has"), "cwns_ok_outliers").otherwise("cwns_isolated")
    )
    zero = lambda x: F.coalesce(F.col(x), F.lit(0))
    return d.select("plant", category.alias("category"), zero("n_origins").alias("n_origins"), zero("a.o").alias("consensus_origins"), zero("n_clusters").alias("n_clusters"), F.col("a.lat").alias("lat"), F.col("a.lon").alias("lon"))


def distances_wide(points: DataFrame, plant: str, source: str, sources: list[str]) -> DataFrame:
    """(plant, d_<a>_<b> ...): the distance between each two sources' first points of a plant, null where one lacks."""
    one = points.groupBy(plant).agg(*[F.min(F.when(F.col(source) == s, F.struct("lat", "lon"))).alias(s) for s in sources])
    d = lambda a, b: geo.haversine_m(F.col(f"{a}.lat"), F.col(f"{a}.lon"), F.col(f"{b}.lat"), F.col(f"{b}.lon"))
    return one.select(plant, *[d(a, b).alias(f"d_{a}_{b}") for i, a in enumerate(sources) for b in sources[i + 1 :]])
