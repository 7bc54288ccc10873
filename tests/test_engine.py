"""Golden and invariant tests of the engine's own operators."""
import pytest
from pyspark.sql import functions as F

from siteforge.functions import geo, text
from siteforge.operators import cluster, joins, metrics, ranking, sampling
from siteforge.sources import readers, writers
from siteforge.sources.tables import table
from siteforge.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_competition_prefers_score_then_lowest_plant(spark):
    df = spark.createDataFrame([(1, 10, 5.0), (2, 10, 5.0), (2, 11, 1.0), (3, 11, 9.0)], "plant long, place long, score double")
    got = {(r.plant, r.place) for r in ranking.competition(df, "place", "plant", "score").collect()}
    assert got == {(1, 10), (3, 11)}  # plant 2 loses both


def test_latest_and_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    assert {(r.k, r.v) for r in writers.upsert(old, new, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}


def test_fail_closed(spark):
    df = spark.createDataFrame([(1,), (2,)], "k long")
    with pytest.raises(ValueError):
        joins.fail_closed_anti(df, None, ["k"])
    with pytest.raises(ValueError):
        joins.fail_closed_anti(df, df, ["k"])
    assert [r.k for r in joins.fail_closed_anti(df, df.where("k = 1"), ["k"]).collect()] == [2]
    with pytest.raises(ValueError):
        joins.left_checked(df, df.union(df), ["k"])


def test_ring_includes_its_border(spark):
    p = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    ring = F.array(p(0, 0), p(4, 0), p(4, 4), p(0, 4), p(0, 0))
    r = spark.range(1).select(geo.in_ring(ring, F.lit(4.0), F.lit(2.0)).alias("on"), geo.in_ring(ring, F.lit(1.0), F.lit(1.0)).alias("inside"), geo.in_ring(ring, F.lit(5.0), F.lit(1.0)).alias("out"), geo.ring_area(ring).alias("a")).first()
    assert (r.on, r.inside, r.out, r.a) == (True, True, False, 16.0)


def test_disk_size_and_distance(spark):
    d = joins.disk(spark.createDataFrame([(0, 0)], "q long, r long"), 18)
    assert d.count() == 3 * 18 * 18 + 3 * 18 + 1
    assert d.agg(F.max(geo.hex_distance(F.col("q"), F.col("r"), F.lit(0), F.lit(0)))).first()[0] == 18


def test_nearest_within_is_inclusive_and_exact(spark):
    a = spark.createDataFrame([(1, 40.0, -100.0)], "k long, lat double, lon double")
    b = spark.createDataFrame([(7, 40.0, -100.001), (8, 40.0, -100.0005), (9, 41.0, -100.0)], "o long, rlat double, rlon double")
    r = joins.nearest_within(a, b, "k", "o", 100.0).first()
    assert r.o == 8 and 42 < r.dist_m < 43


def test_accept_table_golden(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (1, 0.6)], "y int, p double")
    got = [(r.n_accepted, r.n_right) for r in metrics.accept_table(df, "p", "y").orderBy(F.desc("p")).collect()]
    assert got == [(1, 1), (2, 1), (3, 2), (4, 3)]
    assert metrics.auc(df, "p", "y").first().auc == pytest.approx(1 / 3)


def test_indel_ratio_differs_from_edit_distance(spark):
    r = spark.createDataFrame([("kitten", "sitting"), ("", ""), (None, "a")], "a string, b string").select(text.indel_ratio("a", "b").alias("r")).collect()
    assert r[0].r == pytest.approx(200 * 4 / 13) and r[1].r == 100.0 and r[2].r is None


def test_site_growth_follows_the_union(spark):
    rows = [("P", i, i == 0, "o", False, None, x, 0.0, x + 10, 10.0, i) for i, x in enumerate((0.0, 50.0, 100.0, 400.0))]
    df = spark.createDataFrame(rows, "plant string, parcel int, seed boolean, owner string, detected boolean, score double, x0 double, y0 double, x1 double, y1 double, pool int")
    assert [r.parcel for r in cluster.grow_sites(df, 50.0).orderBy("step").collect()] == [0, 1, 2]


def test_nms_measures_from_the_seed(spark):
    m = 1 / 111320
    df = spark.createDataFrame([("g", 1, 40.0, -100.0, 0.9), ("g", 2, 40.0 + 10 * m, -100.0, 0.8), ("g", 3, 40.0 + 20 * m, -100.0, 0.7)], "g string, id long, lat double, lon double, conf double")
    assert {(r.id, r.n_merged) for r in cluster.nms(df, ["g"], 12.0).collect()} == {(1, 2), (3, 1)}
    assert {r.id for r in cluster.keep_apart(df, ["g"], 12.0).collect()} == {1, 3}


def test_components_by_group(spark):
    nodes = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 1)], "g string, node long")
    edges = spark.createDataFrame([("a", 3, 4), ("a", 1, 3)], "g string, a long, b long")
    got = {(r.g, r.node): r.label for r in cluster.components(nodes, edges, "g").collect()}
    assert got == {("a", 0): 0, ("a", 1): 1, ("a", 2): 2, ("a", 3): 1, ("a", 4): 1, ("b", 1): 1}


def test_allocation_takes_n(spark):
    df = spark.createDataFrame([("x" if i % 3 else "y", i) for i in range(100)], "s string, k long")
    assert sampling.allocate(df, "s", 10).agg(F.sum("take")).first()[0] == 10
    assert sampling.stratified(df, "s", "k", 10).count() == 10


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n007,\n008,café\n", encoding="latin-1")
    rows = readers.csv_text(spark, str(tmp_path / "a.csv"), "id string, name string").collect()
    assert rows[0].id == "007" and rows[1].name == "café"
    assert readers.csv_strings(spark, str(tmp_path / "a.csv"), "ISO-8859-1").first().name == ""
    assert readers.newest_layer(["m_20240105", "m_01062024", "m_20240105_v2", "x"]) == "m_01062024"
    df = spark.createDataFrame([("AA", 1), ("BB", 2)], "state string, k int")
    writers.append_parts(df, str(tmp_path / "p"))
    writers.overwrite_partitions(df.where("state = 'AA'").withColumn("k", F.lit(9)), str(tmp_path / "p"))
    assert {(r.state, r.k) for r in spark.read.parquet(str(tmp_path / "p")).collect()} == {("AA", 9), ("BB", 2)}
    with pytest.raises(ValueError):
        writers.merge_shards({"t": [df, df]}, {"t": ["k"]}, str(tmp_path / "m"), 2)
    assert '"coordinates":[1.0,2.0]' in df.select(writers.geojson(F.lit(1.0), F.lit(2.0), F.col("k")).alias("j")).first().j


def test_streaming_upsert(spark, tmp_path):
    e = table(spark, SF, "events")
    e.write.parquet(str(tmp_path / "in"))
    q = incremental.upsert_stream(incremental.stream_parts(spark, str(tmp_path / "in"), e.schema), str(tmp_path / "out"), ["user_id"], ["ts", "event_id"], str(tmp_path / "ck"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "v=0")).count() == e.select("user_id").distinct().count()


def test_windows_drop_what_is_later_than_the_watermark(spark, tmp_path):
    rows = [("2024-01-01 00:05:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 03:00:00", "a", 4.0)]
    schema = "ts timestamp_ntz, event_type string, value double"
    frame = lambda r: spark.createDataFrame(r, "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def run():
        d = incremental.windowed(incremental.stream_parts(spark, src, schema)).select(F.col("window.start").alias("start"), "event_type", "n", "total")
        d.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()

    frame(rows).coalesce(1).write.parquet(src)
    run()
    frame([("2024-01-01 00:10:00", "a", 100.0), ("2024-01-01 05:00:00", "a", 8.0)]).coalesce(1).write.mode("append").parquet(src)  # the first is too late
    run()
    got = sorted((r.n, r.total) for r in spark.read.parquet(out).collect())
    assert got == [(1, 4.0), (2, 3.0)]


def test_resume_retries_failures(spark):
    work = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    done = spark.createDataFrame([(1, True), (2, False)], "k long, od_ran boolean")
    assert {r.k for r in incremental.pending(work, done, ["k"], "od_ran").collect()} == {2, 3}


def test_registry_matches_oracles():
    from siteforge.plans import registry

    assert set(registry.oracle_sql()) <= set(registry.queries()) and len(registry.queries()) > 150


def test_components_of_a_long_chain_estimate_no_huge_size(spark):
    """A round must not multiply the last round's estimated size: its digits had doubled from join to join."""
    from pyspark.sql import functions as F

    from siteforge.operators import cluster

    n = 600
    edges = spark.range(n - 1).select(F.lit(0).alias("g"), (F.col("id") * 7 % n).alias("a"), ((F.col("id") + 1) * 7 % n).alias("b"))
    got = cluster.components(spark.range(n).select(F.lit(0).alias("g"), F.col("id").alias("node")), edges, "g")
    assert got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 300
    assert got.where("label <> 0").isEmpty() and got.count() == n


def test_components_in_rounds_and_at_once(spark, monkeypatch):
    """More edges than one task takes go through rounds, with the same labels; nulls join nothing."""
    import random

    from siteforge.operators import cluster

    rng = random.Random(3)
    n = 400
    chain = [("a", i * 7 % n, (i + 1) * 7 % n) for i in range(150)]
    pairs = [("b", rng.randrange(n), rng.randrange(n)) for _ in range(180)]
    name = {(g, i): i for g in "ab" for i in range(n)}
    moved = True
    while moved:
        moved = False
        for g, a, b in chain + pairs:
            low = min(name[g, a], name[g, b])
            moved |= (name[g, a], name[g, b]) != (low, low)
            name[g, a] = name[g, b] = low
    nodes = spark.createDataFrame([(g, i) for g in "ab" for i in range(n)] + [(None, 1), ("a", None)], "g string, node long")
    edges = spark.createDataFrame(chain + pairs + [("a", None, 1), (None, 1, 2), ("a", 5, 5)], "g string, a long, b long")
    for few in (100_000, 10):
        monkeypatch.setattr(cluster, "FEW", few)
        got = {(r.g, r.node): r.label for r in cluster.components(nodes, edges, "g").collect()}
        assert got == name | {(None, 1): 1, ("a", None): None}


def test_chained_clusters_against_all_pairs(spark):
    """Clusters over the antimeridian, by the poles and over the equator; many points of one place or cell are not paired."""
    import math
    import random

    from siteforge.functions.geo import EARTH_M
    from siteforge.operators import cluster

    def metres(p, q):
        a = math.sin(math.radians(q[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(q[1])) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
        return 2 * EARTH_M * math.asin(math.sqrt(min(1.0, a)))

    rng = random.Random(5)
    boxes = [((-6, 6), (-8, 8)), ((40, 48), (174, 180)), ((40, 48), (-180, -174)), ((86, 90), (-180, 180)), ((-90, -87), (-180, 180))]
    rows = [(rng.choice("xy"), round(rng.uniform(*la), 1), round(rng.uniform(*lo), 1)) for la, lo in boxes for _ in range(90)]
    rows += [("x", 1.0, 1.0)] * 3000
    rng.shuffle(rows)
    places = sorted({(*r, i) for i, r in reversed(list(enumerate(rows)))})
    name = {}
    for *r, i in places:
        name[tuple(r)] = min(i, name.get(tuple(r), i))
    own, moved = list(name), True
    steps = [(p, q) for j, p in enumerate(own) for q in own[:j] if p[0] == q[0] and metres(p, q) <= 120000]
    while moved:
        moved = False
        for p, q in steps:
            moved |= name[p] != name[q]
            name[p] = name[q] = min(name[p], name[q])
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)] + [("x", None, 1.0, -1), (None, 1.0, 1.0, -2)], "g string, lat double, lon double, id long")
    got = {r.id: r.label for r in cluster.chained(df, "g", "id", 120000.0).collect()}
    assert got == {i: name[r] for i, r in enumerate(rows)} | {-1: -1, -2: -2}
    assert 20 < len(set(got.values())) < len(own) - 50


def test_g15_pairs_no_two_points_of_a_place(spark, tmp_path):
    """60 times as many customers at the same places: the result is the same for the smallest of each place."""
    from pyspark.sql import functions as F

    from siteforge.plans import registry

    one = spark.read.parquet("/root/testdata/sf0.01/customer.parquet")
    copies = one.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(59)))).withColumn("c_custkey", (F.col("c_custkey") + F.col("i") * 45000).cast("long")).drop("i")
    copies.write.parquet(f"{tmp_path}/customer.parquet")
    q = registry.queries()["g15_components"]
    small = {r.node: r.label for r in q(spark, "/root/testdata/sf0.01").collect()}
    large = q(spark, str(tmp_path)).collect()
    assert len(large) == 60 * len(small) and all(r.label == small[r.node % 45000] for r in large)


def test_g16_counts_all_points_of_a_place(spark, tmp_path):
    """Repeated customers at the same places: clusters keep their labels and origins, and count every customer."""
    from pyspark.sql import functions as F

    from siteforge.plans import registry

    one = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    copies = one.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(59)))).withColumn("c_custkey", (F.col("c_custkey") + F.col("i") * 45000).cast("long")).drop("i")
    copies.write.parquet(f"{tmp_path}/customer.parquet")
    q = registry.queries()["g16_clusters"]
    small, large = ({r.label: r for r in q(spark, d).collect()} for d in ("/root/testdata/sf0.001", str(tmp_path)))
    assert large.keys() == small.keys() and all((r.n, r.origins) == (60 * small[k].n, small[k].origins) for k, r in large.items())


def test_g16_takes_few_jobs(spark):
    """Clusters of sf0.1 in few Spark jobs (about 40 before, most of them overhead), in groups of several clusters too."""
    from siteforge.plans import registry

    spark.sparkContext.setJobGroup("g16", "g16")
    try:
        rows = registry.queries()["g16_clusters"](spark, "/root/testdata/sf0.1").collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sum(r.n for r in rows) == 15000 and len(rows) > 25
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("g16")) <= 20


def test_chains_of_one_task_and_of_joins_are_the_same(spark, monkeypatch):
    """Groups of over MANY places are chained by joins; both ways agree with brute force near a step's length and where a box is split."""
    import numpy as np

    from siteforge.functions.geo import EARTH_M
    from siteforge.operators import cluster

    rng = np.random.default_rng(7)
    step = 120000 / 111195
    lat = np.concatenate([rng.uniform(30, 57, 250), 60 + rng.integers(0, 4, 250) * step * 1.0005 + rng.normal(0, 2e-4, 250), [90.0, 90.0, -90.0]])
    lon = np.concatenate([rng.uniform(-15, 15, 250), rng.normal(0, 1e-4, 250), [0.0, 77.0, 5.0]])
    y, x = np.radians(lat), np.radians(lon)
    h = np.sin((y[:, None] - y) / 2) ** 2 + np.cos(y)[:, None] * np.cos(y) * np.sin((x[:, None] - x) / 2) ** 2
    near, want = 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(1, h))) <= 120000, np.arange(len(lat))
    while ((low := np.where(near, want, len(lat)).min(axis=1)) < want).any():
        want = low
    assert cluster._chain(lat, lon, 120000.0).tolist() == want.tolist() and len(set(want)) > 5
    df = spark.createDataFrame([("x", float(a), float(o), f"{i:04}") for i, (a, o) in enumerate(zip(lat, lon))], "g string, lat double, lon double, id string")
    for most in (cluster.MANY, 0):
        monkeypatch.setattr(cluster, "MANY", most)
        assert {int(r.id): int(r.label) for r in cluster.chained(df, "g", "id", 120000.0).collect()} == dict(enumerate(want.tolist()))
