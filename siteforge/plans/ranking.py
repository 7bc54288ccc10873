"""Ranking, top-k, newest-row and competition queries (windows)."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.operators import ranking as op
from siteforge.plans.registry import query
from siteforge.sources.tables import table

_S = "SELECT l_orderkey, l_partkey, max(l_extendedprice * (1 - l_discount)) AS score FROM lineitem GROUP BY 1, 2"


def scored(spark, sf_dir):
    """Plant = order, parcel = part, score = discounted price."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey", "l_partkey").agg(F.max(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("score"))


@query(
    "w17_competition",
    f"""WITH s AS ({_S}),
    p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY score DESC, l_orderkey) AS rn FROM s) WHERE rn = 1),
    o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_partkey) AS rk FROM p)
    SELECT l_orderkey, l_partkey, round(score, 4) AS score FROM o WHERE rk = 1""",
)
def w17_competition(spark, sf_dir):
    """Each parcel goes to its best plant, then each plant keeps its best parcel won; a plant may end with none."""
    c = op.competition(scored(spark, sf_dir), "l_partkey", "l_orderkey", "score")
    return c.select("l_orderkey", "l_partkey", F.round("score", 4).alias("score"))


@query("w1_row_number", f"SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_partkey) AS rk FROM ({_S})")
def w1_row_number(spark, sf_dir):
    return scored(spark, sf_dir).select("l_orderkey", "l_partkey", F.row_number().over(W.partitionBy("l_orderkey").orderBy(F.desc("score"), "l_partkey")).alias("rk"))


@query("w2_rank_min", "SELECT l_orderkey, l_linenumber, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS rk FROM lineitem")
def w2_rank_min(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.rank().over(W.partitionBy("l_orderkey").orderBy(F.desc("l_quantity"))).alias("rk"))


@query("w3_rank_first", "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber, l_partkey, l_suppkey) AS rk FROM lineitem")
def w3_rank_first(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_quantity", "l_linenumber", "l_partkey", "l_suppkey")).alias("rk"))


@query(
    "w4_pool_features",
    """SELECT l_orderkey, l_linenumber, max(l_quantity) OVER p AS pool_max, max(l_quantity) OVER p - l_quantity AS gap, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS rank_min,
    sum(CASE WHEN l_quantity = m THEN 1 ELSE 0 END) OVER p AS n_at_max, l_quantity = m AS is_max
    FROM (SELECT *, max(l_quantity) OVER (PARTITION BY l_orderkey) AS m FROM lineitem) WINDOW p AS (PARTITION BY l_orderkey)""",
)
def w4_pool_features(spark, sf_dir):
    f = op.pool_features(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity")
    return f.select("l_orderkey", "l_linenumber", "pool_max", "gap", "rank_min", "n_at_max", (F.col("gap") == 0).alias("is_max"))


@query(
    "w5_pool_share",
    "SELECT l_orderkey, l_linenumber, CASE WHEN sum(l_quantity) OVER p > 0 THEN l_quantity / sum(l_quantity) OVER p ELSE 0.0 END AS share FROM lineitem WINDOW p AS (PARTITION BY l_orderkey)",
)
def w5_pool_share(spark, sf_dir):
    return op.pool_features(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity").select("l_orderkey", "l_linenumber", "share")


@query("w6_leaders", "SELECT l_orderkey, l_linenumber FROM (SELECT *, min(l_quantity) OVER (PARTITION BY l_orderkey) AS m FROM lineitem) WHERE l_quantity <= m + 1")
def w6_leaders(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("m", F.min("l_quantity").over(W.partitionBy("l_orderkey"))).where("l_quantity <= m + 1").select("l_orderkey", "l_linenumber")


@query("w7_cumulative", "SELECT l_orderkey, l_linenumber, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS run FROM lineitem")
def w7_cumulative(spark, sf_dir):
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.sum("l_quantity").over(w).alias("run"))


@query("w8_top_k", f"SELECT l_orderkey, l_partkey, rk FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_partkey) AS rk FROM ({_S})) WHERE rk <= 3")
def w8_top_k(spark, sf_dir):
    return op.top_k(scored(spark, sf_dir), ["l_orderkey"], [F.desc("score"), F.col("l_partkey")], 3, "rk").select("l_orderkey", "l_partkey", "rk")


@query("w9_latest", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def w9_latest(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return op.latest(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("w10_first", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1")
def w10_first(spark, sf_dir):
    """First row wins, by an explicit ordinal."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("event_id"))


@query("w11_lowest_version", "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r = 1")
def w11_lowest_version(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("m")).select("l_orderkey", "m.l_linenumber", "m.l_partkey")


@query(
    "w12_near_tie_best",
    """SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_tax DESC, l_linenumber, l_partkey, l_suppkey) AS r
    FROM (SELECT *, max(l_quantity) OVER (PARTITION BY l_orderkey) AS m FROM lineitem) WHERE l_quantity >= m - 5) WHERE r = 1""",
)
def w12_near_tie_best(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_partkey", "l_suppkey")
    return op.near_tie_best(li, "l_orderkey", "l_quantity", 5, [F.desc("l_tax"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]).select("l_orderkey", "l_linenumber")


@query(
    "w13_runner_up",
    """SELECT l_orderkey, max(CASE WHEN r = 1 THEN l_linenumber END) AS best, max(CASE WHEN r = 2 THEN l_linenumber END) AS alt,
    coalesce(abs(max(CASE WHEN r = 1 THEN l_discount END) - max(CASE WHEN r = 2 THEN l_discount END)) <= 0.051, false) AS multi_pass
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r <= 2 GROUP BY 1""",
)
def w13_runner_up(spark, sf_dir):
    t = op.top_k(table(spark, sf_dir, "lineitem"), ["l_orderkey"], [F.desc("l_quantity"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")], 2, "r")
    at = lambda r, c: F.max(F.when(F.col("r") == r, F.col(c)))
    close = F.abs(at(1, "l_discount") - at(2, "l_discount")) <= 0.051
    return t.groupBy("l_orderkey").agg(at(1, "l_linenumber").alias("best"), at(2, "l_linenumber").alias("alt"), F.coalesce(close, F.lit(False)).alias("multi_pass"))


@query(
    "w14_site_rank",
    """SELECT c_custkey, concat(c_nationkey, '_s', row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_custkey)) AS site_id
    FROM (SELECT c_custkey, c_nationkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)""",
)
def w14_site_rank(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("o_orderkey").alias("n"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(n, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    r = F.row_number().over(W.partitionBy("c_nationkey").orderBy(F.desc("n"), "c_custkey"))
    return c.select("c_custkey", F.concat(F.col("c_nationkey").cast("string"), F.lit("_s"), r.cast("string")).alias("site_id"))


@query(
    "w15_representative",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1""",
)
def w15_representative(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return op.top_k(o, ["o_custkey"], [F.desc(F.col("o_orderstatus") == "F"), F.desc("o_totalprice"), F.col("o_orderkey")], 1).select("o_custkey", "o_orderkey")


@query("w16_primary", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1 AS is_primary FROM orders")
def w16_primary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_custkey", "o_orderkey", (F.row_number().over(W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")) == 1).alias("is_primary"))


@query(
    "w18_clipped_rank",
    "SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY greatest(coalesce(c_acctbal, 0), 0) DESC, c_custkey) AS rk FROM customer",
)
def w18_clipped_rank(spark, sf_dir):
    s = F.greatest(F.coalesce("c_acctbal", F.lit(0.0)), F.lit(0.0))
    return table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.row_number().over(W.partitionBy("c_nationkey").orderBy(s.desc(), "c_custkey")).alias("rk"))


@query(
    "w19_round_robin",
    """SELECT o_orderkey, turn, row_number() OVER (PARTITION BY turn ORDER BY o_orderpriority) AS place
    FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS turn FROM orders)""",
)
def w19_round_robin(spark, sf_dir):
    """Interleave groups: turn within the group, then place within the turn."""
    o = table(spark, sf_dir, "orders").withColumn("turn", F.row_number().over(W.partitionBy("o_orderpriority").orderBy("o_orderdate", "o_orderkey")))
    return o.select("o_orderkey", "turn", F.row_number().over(W.partitionBy("turn").orderBy("o_orderpriority")).alias("place"))


@query("w20_null_order", "SELECT o_orderkey, o_clerk FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS o_clerk FROM orders) ORDER BY o_clerk ASC NULLS FIRST, o_orderkey DESC")
def w20_null_order(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("o_clerk"))
    return o.orderBy(F.asc_nulls_first("o_clerk"), F.desc("o_orderkey"))


@query("w21_predicate_first", "SELECT conv_id, turn FROM conversations ORDER BY (role = 'assistant') DESC, conv_id, turn LIMIT 1")
def w21_predicate_first(spark, sf_dir):
    return table(spark, sf_dir, "conversations").orderBy(F.desc(F.col("role") == "assistant"), "conv_id", "turn").limit(1).select("conv_id", "turn")


@query("w22_nlargest", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def w22_nlargest(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query(
    "w23_last_of_tie",
    "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_quantity ORDER BY l_linenumber DESC, l_partkey, l_suppkey) = 1 AS is_last FROM lineitem",
)
def w23_last_of_tie(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.row_number().over(W.partitionBy("l_orderkey", "l_quantity").orderBy(F.desc("l_linenumber"), "l_partkey", "l_suppkey")) == 1).alias("is_last"))


@query("w24_duplicated", "SELECT doc_id FROM (SELECT doc_id, count(*) OVER (PARTITION BY md5(text)) AS n FROM documents) WHERE n > 1")
def w24_duplicated(spark, sf_dir):
    """Rows whose content occurs more than once: hashes are counted with map-side combination, then joined back."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    return d.join(d.groupBy("h").count().where("count > 1"), "h", "left_semi").select("doc_id")
