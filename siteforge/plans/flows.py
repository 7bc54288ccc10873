"""Sampling, clusters, zonal and tile operators, and the compound flows built from them."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.functions import geo, text
from siteforge.operators import cluster, joins, names, ranking, sampling
from siteforge.plans.points import LAT, LON, hav, lat, lon
from siteforge.plans.ranking import _S, scored
from siteforge.plans.registry import query
from siteforge.plans.relations import customers, suppliers
from siteforge.sources.tables import table


@query("m1_shuffle_prefix", "SELECT o_orderkey FROM orders ORDER BY sha1('q:' || o_orderkey), o_orderkey LIMIT 100")
def m1_shuffle_prefix(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey").orderBy(sampling.hashed(F.col("o_orderkey"), "q"), "o_orderkey").limit(100)


_ALLOC = """(SELECT p, size, least(size, base + (row_number() OVER (ORDER BY exact - base DESC, p) <= 200 - sum(base) OVER ())::INT)::BIGINT AS take
    FROM (SELECT p, size, 200 * size / sum(size) OVER () AS exact, floor(200 * size / sum(size) OVER ())::BIGINT AS base FROM (SELECT o_orderpriority AS p, count(*) AS size FROM orders GROUP BY 1)))"""


@query("m2_allocation", f"SELECT p AS o_orderpriority, size, take FROM {_ALLOC}")
def m2_allocation(spark, sf_dir):
    return sampling.allocate(table(spark, sf_dir, "orders"), "o_orderpriority", 200)


@query("m3_stratified", f"SELECT o_orderkey FROM (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY sha1('s:' || o_orderkey), o_orderkey) AS r FROM orders) JOIN {_ALLOC} ON p = o_orderpriority WHERE r <= take")
def m3_stratified(spark, sf_dir):
    return sampling.stratified(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 200).select("o_orderkey")


@query("m3_weighted", "SELECT c_custkey FROM customer WHERE c_acctbal > 0 ORDER BY -ln((('0x' || substr(sha1(c_custkey::VARCHAR), 1, 8))::BIGINT + 0.5) / 4294967296.0) / c_acctbal, c_custkey LIMIT 60")
def m3_weighted(spark, sf_dir):
    return sampling.weighted(table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", "c_acctbal"), "c_custkey", F.col("c_acctbal"), 60).select("c_custkey")


@query("m4_at_most", "SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY sha1('c:' || c_custkey), c_custkey) AS r FROM customer) WHERE r <= 4")
def m4_at_most(spark, sf_dir):
    return sampling.at_most(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], "c_custkey", 4).select("c_custkey")


@query(
    "m5_negatives",
    """WITH o AS (SELECT o_orderkey, o_orderstatus = 'P' AND o_totalprice > 250000 AS pos, o_totalprice > 400000 AS keep, o_orderpriority = '1-URGENT' AS hard, sha1('n:' || o_orderkey) AS h FROM orders), c AS (SELECT greatest(0, 5 * count(*) FILTER (WHERE pos) - count(*) FILTER (WHERE keep AND NOT pos)) AS room FROM o),
    r AS (SELECT o_orderkey, hard, row_number() OVER (PARTITION BY hard ORDER BY h, o_orderkey) AS n FROM o WHERE NOT pos AND NOT keep) SELECT o_orderkey FROM o WHERE pos OR keep UNION ALL SELECT o_orderkey FROM r, c WHERE n <= CASE WHEN hard THEN floor(room * 0.7) ELSE room - floor(room * 0.7) END""",
)
def m5_negatives(spark, sf_dir):
    """Positives and kept seeds stay; hard and easy negatives fill the budget."""
    o = table(spark, sf_dir, "orders")
    pos = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 250000)
    return sampling.negatives(o, "o_orderkey", pos, F.col("o_totalprice") > 400000, F.col("o_orderpriority") == "1-URGENT", 5, 0.7).select("o_orderkey")


@query("m6_group_split", "SELECT o_orderkey, ('0x' || substr(sha1(o_custkey::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < 0.25 AS test FROM orders")
def m6_group_split(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", (text.hash_fraction(F.col("o_custkey")) < 0.25).alias("test"))


@query("g1_area_filter", "SELECT p_partkey, round((p_size * 10.0) * (p_size * 7.0) / 2, 3) AS area FROM part WHERE (p_size * 10.0) * (p_size * 7.0) / 2 <= 40000")
def g1_area_filter(spark, sf_dir):
    """Shoelace area of derived triangles, large ones dropped."""
    p = lambda x, y: F.struct((F.col("p_size") * x).alias("x"), (F.col("p_size") * y).alias("y"))
    ring = F.array(p(0.0, 0.0), p(10.0, 0.0), p(0.0, 7.0), p(0.0, 0.0))
    return table(spark, sf_dir, "part").select("p_partkey", geo.ring_area(ring).alias("area")).where("area <= 40000").select("p_partkey", F.round("area", 3).alias("area"))


@query(
    "g9_zonal",
    """WITH px AS (SELECT l_partkey % 100 AS x, l_suppkey AS y, l_linenumber AS v, l_quantity AS cover FROM lineitem),
    z AS (SELECT s_suppkey, v, count(*) FILTER (WHERE cover >= 25) AS n FROM supplier JOIN px ON y = s_suppkey AND x BETWEEN s_nationkey AND s_nationkey + 40 GROUP BY 1, 2)
    SELECT s_suppkey, sum(n)::BIGINT AS pixels, sum(CASE WHEN v = 1 THEN n ELSE 0 END)::BIGINT AS water, arg_min(v, -n * 100 + v) AS dominant FROM z WHERE n > 0 GROUP BY 1""",
)
def g9_zonal(spark, sf_dir):
    """Zonal statistics over a pixel table: pixels of at least half coverage, the dominant value with ties to the smallest."""
    px = table(spark, sf_dir, "lineitem").where("l_quantity >= 25").select((F.col("l_partkey") % 100).alias("x"), F.col("l_suppkey").alias("s_suppkey"), F.col("l_linenumber").alias("v"))
    z = px.join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey").where("x between s_nationkey and s_nationkey + 40").groupBy("s_suppkey", "v").agg(F.count(F.lit(1)).alias("n"))
    return z.groupBy("s_suppkey").agg(F.sum("n").alias("pixels"), F.sum(F.when(F.col("v") == 1, F.col("n")).otherwise(0)).alias("water"), F.min(F.struct(-F.col("n"), F.col("v"))).alias("m")).select("s_suppkey", "pixels", "water", F.col("m.v").alias("dominant"))


@query("g10_tiles", "SELECT p_partkey, i AS tx, j AS ty FROM part, range(0, 30) r(i), range(0, 30) q(j) WHERE i < CASE WHEN p_size * 50 < 500 OR p_size * 30 < 500 THEN 1 ELSE ceil(p_size * 50 / 450.0) END AND j < CASE WHEN p_size * 50 < 500 OR p_size * 30 < 500 THEN 1 ELSE ceil(p_size * 30 / 450.0) END")
def g10_tiles(spark, sf_dir):
    """Tile grid over a box with stride 450, one tile if a side is below 500."""
    w, h = F.col("p_size") * 50, F.col("p_size") * 30
    n = lambda side: F.when((w < 500) | (h < 500), F.lit(1)).otherwise(F.ceil(side / 450.0).cast("int"))
    t = table(spark, sf_dir, "part").select("p_partkey", n(w).alias("nx"), n(h).alias("ny"))
    return t.withColumn("tx", F.explode(F.sequence(F.lit(0), F.col("nx") - 1))).withColumn("ty", F.explode(F.sequence(F.lit(0), F.col("ny") - 1))).select("p_partkey", "tx", "ty")


_PTS = f"(SELECT c_custkey, c_nationkey, {LAT.format(k='c_custkey')} AS lat, {LON.format(k='c_custkey')} AS lon FROM customer)"
_CC = f"""WITH RECURSIVE e AS (SELECT a.c_custkey AS a, b.c_custkey AS b FROM {_PTS} a JOIN {_PTS} b ON a.c_nationkey = b.c_nationkey AND a.c_custkey <> b.c_custkey AND {hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 120000),
    r AS (SELECT c_custkey AS node, c_custkey AS label FROM customer UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.node)"""


@query("g15_components", f"{_CC} SELECT node, min(label) AS label FROM r GROUP BY 1")
def g15_components(spark, sf_dir):
    return cluster.chained(customers(spark, sf_dir), "c_nationkey", "c_custkey", 120000).select(F.col("c_custkey").alias("node"), "label")


@query("g16_clusters", f"{_CC}, c AS (SELECT node, min(label) AS label FROM r GROUP BY 1) SELECT label, count(*) AS n, count(DISTINCT c_mktsegment) AS origins, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(DISTINCT c_mktsegment) DESC, count(*) DESC, label) AS rk FROM c JOIN customer ON c_custkey = node GROUP BY label, c_nationkey")
def g16_clusters(spark, sf_dir):
    """Chained clusters with independent origins, ranked best first in their group."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").where(k.isNotNull()).select("c_custkey", "c_nationkey", "c_mktsegment", lat(k).alias("lat"), lon(k).alias("lon"))
    g = cluster.chained(c, "c_nationkey", "c_custkey", 120000).groupBy("label", "c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c_mktsegment").alias("origins"))
    return g.select("label", "n", "origins", F.row_number().over(W.partitionBy("c_nationkey").orderBy(F.desc("origins"), F.desc("n"), "label")).alias("rk"))


@query("g18_agreement", f"SELECT c_custkey, CASE WHEN d <= 250000 THEN 'same' WHEN d <= 1000000 THEN 'close' WHEN d <= 2500000 THEN 'near' ELSE 'far' END AS cls FROM (SELECT c_custkey, {hav('lat', 'lon', '35.0', '-100.0')} AS d FROM {_PTS})")
def g18_agreement(spark, sf_dir):
    d = geo.haversine_m(F.col("lat"), F.col("lon"), F.lit(35.0), F.lit(-100.0))
    return customers(spark, sf_dir).select("c_custkey", F.when(d <= 250000, "same").when(d <= 1000000, "close").when(d <= 2500000, "near").otherwise("far").alias("cls"))


def _objects(spark, sf_dir):
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("plant"), "event_type", k.alias("id"), (40 + (k * 37 % 1000) / 1000000.0).alias("lat"), (-100 + (k * 91 % 1000) / 1000000.0).alias("lon"), (1 + k % 97).cast("double").alias("conf"))


@query("g4_keep_apart")
def g4_keep_apart(spark, sf_dir):
    return cluster.keep_apart(_objects(spark, sf_dir), ["plant", "event_type"], 12.0).select("plant", "event_type", "id")


@query("g5_nms")
def g5_nms(spark, sf_dir):
    n = cluster.nms(_objects(spark, sf_dir), ["plant", "event_type"], 12.0)
    return n.select("plant", "event_type", "id", F.round("lat", 7).alias("lat"), F.round("lon", 7).alias("lon"), "n_merged")


@query("g6_site_assembly")
def g6_site_assembly(spark, sf_dir):
    k = F.col("l_partkey")
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("plant"), k.alias("parcel")).agg(F.max("l_quantity").alias("q"), F.max("l_discount").alias("d"))
    x, y = (F.col("parcel") % 20) * 60.0, (F.col("parcel") * 7 % 20) * 60.0
    r = F.row_number().over(W.partitionBy("plant").orderBy(F.desc("q"), "parcel"))
    df = li.select("plant", "parcel", (r == 1).alias("seed"), (F.col("parcel") % 3).cast("string").alias("owner"), (F.col("q") > 30).alias("detected"), (F.col("d") * 10).alias("score"), x.alias("x0"), y.alias("y0"), (x + 40).alias("x1"), (y + 40).alias("y1"), r.alias("pool"))
    return cluster.grow_sites(df, 200.0)


@query(
    "w25_medoid",
    f"""WITH p AS (SELECT *, c_custkey // 8 AS g FROM {_PTS}), d AS (SELECT a.g, a.c_custkey, sum({hav('a.lat', 'a.lon', 'b.lat', 'b.lon')}) AS t FROM p a JOIN p b ON a.g = b.g GROUP BY 1, 2)
    SELECT g, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY round(t), c_custkey) AS r FROM d) WHERE r = 1""",
)
def w25_medoid(spark, sf_dir):
    """Least total distance within a group (a plant's few sources: eight neighbouring customers), ties to the smallest id."""
    a = customers(spark, sf_dir).withColumn("g", F.floor(F.col("c_custkey") / 8))
    b = a.select("g", F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    t = a.join(b, "g").groupBy("g", "c_custkey").agg(F.round(F.sum(geo.haversine_m(F.col("lat"), F.col("lon"), F.col("rlat"), F.col("rlon")))).alias("t"))
    return ranking.best_row(t, ["g"], "t", "c_custkey", descending=False).select("g", "c_custkey")


@query("k6_duplicate_diagnosis", "SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_partkey) > 1 AS part_differs, count(DISTINCT l_returnflag) > 1 AS flag_differs FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def k6_duplicate_diagnosis(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    return d.agg(F.count(F.lit(1)).alias("n"), (F.count_distinct("l_partkey") > 1).alias("part_differs"), (F.count_distinct("l_returnflag") > 1).alias("flag_differs")).where("n > 1")


@query("k10_upsert", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p DESC, event_id DESC) AS r FROM (SELECT *, 0 AS p FROM events WHERE event_type = 'view' UNION ALL SELECT *, 1 AS p FROM events WHERE event_type = 'click')) WHERE r = 1")
def k10_upsert(spark, sf_dir):
    """A later root wins, then the newest row (S9, K10)."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    u = e.where("event_type = 'view'").withColumn("p", F.lit(0)).unionByName(e.where("event_type = 'click'").withColumn("p", F.lit(1)))
    return ranking.latest(u, ["user_id"], ["p", "event_id"]).select("user_id", "event_id")


@query(
    "c7_candidates",
    f"""WITH s AS (SELECT * FROM ({_S}) WHERE l_partkey % 7 <> l_orderkey % 7), p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY score DESC, l_orderkey) AS rn FROM s) WHERE rn = 1)
    SELECT l_orderkey, l_partkey, rk, n FROM (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_partkey) AS rk, count(*) OVER (PARTITION BY l_orderkey) AS n FROM p) WHERE rk <= 20""",
)
def c7_candidates(spark, sf_dir):
    """Candidates without the reported parcel, competition, pool size and top 20."""
    s = scored(spark, sf_dir).where(~(F.col("l_partkey") % 7).eqNullSafe(F.col("l_orderkey") % 7))
    won = ranking.best_row(s, ["l_partkey"], "score", "l_orderkey").withColumn("n", F.count(F.lit(1)).over(W.partitionBy("l_orderkey")))
    return ranking.top_k(won, ["l_orderkey"], [F.desc("score"), F.col("l_partkey")], 20, "rk").select("l_orderkey", "l_partkey", "rk", "n")


@query(
    "c8_rerank_fallback",
    "SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN fired THEN l_tax ELSE l_quantity END DESC, l_partkey, l_linenumber, l_suppkey) AS rk, NOT fired AS fallback FROM (SELECT *, bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS fired FROM lineitem)",
)
def c8_rerank_fallback(spark, sf_dir):
    """Pools in which no candidate fired are ordered by the earlier score."""
    d = table(spark, sf_dir, "lineitem").withColumn("fired", F.bool_or(F.col("l_returnflag") == "R").over(W.partitionBy("l_orderkey")))
    s = F.when(F.col("fired"), F.col("l_tax")).otherwise(F.col("l_quantity"))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", F.row_number().over(W.partitionBy("l_orderkey").orderBy(s.desc(), "l_partkey", "l_linenumber", "l_suppkey")).alias("rk"), (~F.col("fired")).alias("fallback"))


@query(
    "c9_review_queue",
    """WITH held AS (SELECT o_orderkey, 'holdout' AS slice FROM orders WHERE ('0x' || substr(sha1(o_orderkey::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < 0.02),
    r0 AS (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM held)), aud AS (SELECT o_orderkey, 'audit' AS slice FROM r0 WHERE o_orderstatus = 'P' ORDER BY sha1('a:' || o_orderkey), o_orderkey LIMIT 20),
    rest AS (SELECT * FROM r0 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM aud)), unc AS (SELECT o_orderkey, 'uncertain' AS slice FROM rest WHERE o_totalprice BETWEEN 100000 AND 120000 ORDER BY sha1('u:' || o_orderkey), o_orderkey LIMIT 70)
    SELECT * FROM held UNION ALL SELECT * FROM aud UNION ALL SELECT * FROM unc UNION ALL (SELECT o_orderkey, 'random' AS slice FROM rest WHERE o_orderkey NOT IN (SELECT o_orderkey FROM unc) ORDER BY sha1('r:' || o_orderkey), o_orderkey LIMIT 30)""",
)
def c9_review_queue(spark, sf_dir):
    """Holdout, an audit of 20 accepted plants, then 70 uncertain and 30 random ones; a shortfall is not filled up."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    in_hold = text.hash_fraction(F.col("o_orderkey")) < 0.02
    take = lambda df, seed, n, name: df.orderBy(sampling.hashed(F.col("o_orderkey"), seed), "o_orderkey").limit(n).select("o_orderkey", F.lit(name).alias("slice"))
    audited = take(o.where(~in_hold & (F.col("o_orderstatus") == "P")), "a", 20, "audit")
    rest = o.where(~in_hold).join(audited.select("o_orderkey"), "o_orderkey", "left_anti")
    unc = take(rest.where("o_totalprice between 100000 and 120000"), "u", 70, "uncertain")
    rnd = take(rest.join(unc.select("o_orderkey"), "o_orderkey", "left_anti"), "r", 30, "random")
    return o.where(in_hold).select("o_orderkey", F.lit("holdout").alias("slice")).unionByName(audited).unionByName(unc).unionByName(rnd)


@query("c10_provenance", f"SELECT c_custkey, string_agg(DISTINCT s_nationkey::VARCHAR, '+' ORDER BY s_nationkey::VARCHAR) AS sources, count(DISTINCT s_nationkey) AS n, round(min({hav('lat', 'lon', 'rlat', 'rlon')}) / 1000, 3) AS km FROM {_PTS} c, (SELECT s_suppkey, s_nationkey, {LAT.format(k='s_suppkey * 31')} AS rlat, {LON.format(k='s_suppkey * 31')} AS rlon FROM supplier) WHERE {hav('lat', 'lon', 'rlat', 'rlon')} <= 70000 GROUP BY 1")
def c10_provenance(spark, sf_dir):
    p = joins.within_distance(customers(spark, sf_dir), suppliers(spark, sf_dir), 70000)
    return p.groupBy("c_custkey").agg(F.array_join(F.array_sort(F.collect_set(F.col("s_nationkey").cast("string"))), "+").alias("sources"), F.count_distinct("s_nationkey").alias("n"), F.round(F.min("dist_m") / 1000, 3).alias("km"))


@query("c12_master_update", "SELECT c_custkey, coalesce(o.status, c.c_mktsegment) AS seg FROM customer c LEFT JOIN (SELECT o_custkey, max_by(o_orderstatus, o_orderkey) AS status FROM orders WHERE o_totalprice > 200000 GROUP BY 1) o ON o_custkey = c_custkey")
def c12_master_update(spark, sf_dir):
    """Null never overwrites (C13): the newest verdict where there is one, else what was there."""
    v = table(spark, sf_dir, "orders").where("o_totalprice > 200000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderstatus", "o_orderkey").alias("status"))
    return table(spark, sf_dir, "customer").join(v, "c_custkey", "left").select("c_custkey", F.coalesce("status", "c_mktsegment").alias("seg"))


@query("c22_top_up", "SELECT user_id, min(event_id) AS event_id FROM (SELECT user_id, event_id FROM events WHERE event_type = 'view' UNION ALL SELECT user_id, event_id FROM events WHERE event_type <> 'view' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'view')) GROUP BY 1")
def c22_top_up(spark, sf_dir):
    """Only missing ids are computed, appended, first kept."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    done = e.where("event_type = 'view'")
    more = e.where("event_type <> 'view'").join(done.select("user_id"), "user_id", "left_anti")
    return done.unionByName(more).groupBy("user_id").agg(F.min("event_id").alias("event_id"))


@query("f22_name_match")
def f22_name_match(spark, sf_dir):
    """Rarity-weighted match of each candidate's owner with its plant's name: Indel ratios and acronyms (no SQL: longest common subsequences)."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.concat("p_name", F.when(F.col("p_partkey") % 5 == 0, " WWTP").otherwise(" Plant")).alias("name"), "p_type")
    idf, default = names.idf_table(p)
    owner = F.when(F.col("k") % 4 == 0, F.regexp_replace("name", "^(.)", "x")).when(F.col("k") % 4 == 1, F.concat(F.substring("name", 1, 5), F.lit(" & Co"))).when(F.col("k") % 4 == 2, F.col("p_type"))
    d = names.name_scores(p.withColumn("owner", owner), "name", "owner", idf, default)
    return d.select("k", F.round("name_match_score", 6).alias("score"), F.col("name_match_available").alias("available"))


@query("x2_forest")
def x2_forest(spark, sf_dir):
    """Preprocessing and a weighted random forest scored on its hold-out (rows only: trees are not SQL)."""
    from siteforge.operators import models

    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("top"), F.count(F.lit(1)).alias("n"))
    d = c.join(o, "c_custkey").withColumn("label", (F.col("top") > 350000).cast("double"))
    held = text.hash_fraction(F.col("c_custkey")) < 0.25
    model = models.train(d.where(~held), ["c_mktsegment"], ["c_acctbal", "n"], "label", trees=20)
    return models.score(model, d.where(held)).select("c_custkey", F.round("score", 4).alias("score"))
