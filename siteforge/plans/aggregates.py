"""Aggregations, pivots, metrics."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.operators import metrics
from siteforge.plans.registry import query
from siteforge.sources.tables import table


@query(
    "a1_discharge_features",
    """SELECT l_orderkey, bool_or(l_returnflag = 'R') AS any_returned, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS open_quantity,
    bool_or(l_shipdate >= TIMESTAMP '1996-01-01') AS late, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY 1""",
)
def a1_discharge_features(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0)).alias("open_quantity"),
        F.bool_or(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).alias("late"),
        F.count_distinct("l_suppkey").alias("n_suppliers"),
    )


@query(
    "a2_quality_score",
    """SELECT c_nationkey, round(avg((c_acctbal > 0)::INT), 9) AS share_positive, round(avg((c_mktsegment = 'BUILDING')::INT), 9) AS share_building,
    round((avg((c_acctbal > 0)::INT) + avg((c_mktsegment = 'BUILDING')::INT)) / 2, 9) AS score FROM customer GROUP BY 1""",
)
def a2_quality_score(spark, sf_dir):
    p, b = F.avg((F.col("c_acctbal") > 0).cast("int")), F.avg((F.col("c_mktsegment") == "BUILDING").cast("int"))
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.round(p, 9).alias("share_positive"), F.round(b, 9).alias("share_building"), F.round((p + b) / 2, 9).alias("score"))


@query("a3_count", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def a3_count(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a4_dominant_code",
    "SELECT l_partkey, code FROM (SELECT l_partkey, l_linenumber AS code, row_number() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC, l_linenumber) AS r FROM lineitem GROUP BY 1, 2) WHERE r = 1",
)
def a4_dominant_code(spark, sf_dir):
    """Most frequent value, ties to the smallest: two combinable aggregates."""
    n = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_linenumber").count()
    return n.groupBy("l_partkey").agg(F.max(F.struct("count", -F.col("l_linenumber"))).alias("m")).select("l_partkey", (-F.col("m.col2")).alias("code"))


@query(
    "a5_dominant_class",
    "SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY 1, 2) WHERE r = 1",
)
def a5_dominant_class(spark, sf_dir):
    n = table(spark, sf_dir, "events").groupBy("user_id", "event_type").count()
    return n.groupBy("user_id").agg(F.min(F.struct(-F.col("count"), F.col("event_type"))).alias("m")).select("user_id", "m.event_type")


@query("a6_filtered_counts", "SELECT l_suppkey, count(*) FILTER (WHERE l_quantity >= 25) AS covered, count(*) FILTER (WHERE l_returnflag = 'A') AS water FROM lineitem GROUP BY 1")
def a6_filtered_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_quantity") >= 25).alias("covered"), F.count_if(F.col("l_returnflag") == "A").alias("water"))


_CLASSES = ["click", "error", "purchase", "signup", "view"]


@query(
    "a7_wide_by_class",
    "SELECT user_id, count(*) AS n_objects, count(DISTINCT event_type) AS n_classes, "
    + ", ".join(f"coalesce(bool_or(event_type = '{c}'), false) AS has_{c}, count(*) FILTER (WHERE event_type = '{c}') AS n_{c}, max(CASE WHEN event_type = '{c}' THEN value END) AS max_{c}" for c in _CLASSES)
    + " FROM events GROUP BY 1",
)
def a7_wide_by_class(spark, sf_dir):
    is_ = lambda c: F.col("event_type") == c
    cols = [x for c in _CLASSES for x in (F.bool_or(is_(c)).alias(f"has_{c}"), F.count_if(is_(c)).alias(f"n_{c}"), F.max(F.when(is_(c), F.col("value"))).alias(f"max_{c}"))]
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_objects"), F.count_distinct("event_type").alias("n_classes"), *cols)


@query("a8_sentinels", "SELECT c_custkey, coalesce(count(o_orderkey), 0) AS n, CASE WHEN max(o_totalprice) IS NULL THEN -1 ELSE max(o_totalprice) END AS top FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def a8_sentinels(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("o_orderkey").alias("n"), F.max("o_totalprice").alias("top"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("top", F.lit(-1.0)).alias("top"))


@query("a9_weighted_centre", "SELECT l_orderkey, round(sum(l_partkey * l_quantity) / sum(l_quantity), 6) AS x FROM lineitem GROUP BY 1")
def a9_weighted_centre(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum(F.col("l_partkey") * F.col("l_quantity")) / F.sum("l_quantity"), 6).alias("x"))


@query("a10_sorted_join", "SELECT user_id, string_agg(DISTINCT event_type, '+' ORDER BY event_type) AS sources FROM events GROUP BY 1")
def a10_sorted_join(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), "+").alias("sources"))


@query("a11_filtered_nunique", "SELECT l_orderkey, count(DISTINCT CASE WHEN l_returnflag <> 'N' THEN l_suppkey END) AS n FROM lineitem GROUP BY 1")
def a11_filtered_nunique(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count_distinct(F.when(F.col("l_returnflag") != "N", F.col("l_suppkey"))).alias("n"))


@query("a12_quantiles", "SELECT l_returnflag, quantile_cont(l_quantity, 0.5) AS med, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90 FROM lineitem GROUP BY 1")
def a12_quantiles(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.percentile("l_quantity", F.lit(0.5)).alias("med"), F.round(F.percentile("l_extendedprice", F.lit(0.9)), 6).alias("p90"))


@query("a13_spread", "SELECT l_suppkey, min(l_quantity) AS lo, max(l_quantity) AS hi, median(l_quantity) AS med, quantile_cont(l_quantity, 0.9) AS p90 FROM lineitem GROUP BY 1")
def a13_spread(spark, sf_dir):
    q = "l_quantity"
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.min(q).alias("lo"), F.max(q).alias("hi"), F.median(q).alias("med"), F.percentile(q, F.lit(0.9)).alias("p90"))


@query("a14_value_counts", "SELECT coalesce(c, '(null)') AS v, count(*) AS n FROM (SELECT nullif(o_orderpriority, '5-LOW') AS c FROM orders) GROUP BY 1 ORDER BY n DESC, v LIMIT 3")
def a14_value_counts(spark, sf_dir):
    v = F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("(null)"))
    return table(spark, sf_dir, "orders").groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "v").limit(3)


@query("a15_crosstab", "SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS \"F\", count(*) FILTER (WHERE l_linestatus = 'O') AS \"O\" FROM lineitem GROUP BY 1")
def a15_crosstab(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).count().na.fill(0, ["F", "O"])


@query("a16_pivot_min", "SELECT l_suppkey, min(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS \"A\", min(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS \"N\", min(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS \"R\" FROM lineitem GROUP BY 1")
def a16_pivot_min(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.min("l_quantity"))


@query(
    "a17_margin",
    "SELECT l_orderkey, max(CASE WHEN r = 1 THEN l_quantity END) - max(CASE WHEN r = 2 THEN l_quantity END) AS margin FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber) AS r FROM lineitem) GROUP BY 1",
)
def a17_margin(spark, sf_dir):
    r = F.row_number().over(W.partitionBy("l_orderkey").orderBy(F.desc("l_quantity"), "l_linenumber"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", r.alias("r"))
    return li.groupBy("l_orderkey").agg((F.max(F.when(F.col("r") == 1, F.col("l_quantity"))) - F.max(F.when(F.col("r") == 2, F.col("l_quantity")))).alias("margin"))


@query("a18_describe", "SELECT count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS sd, min(l_quantity) AS lo, quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.75) AS q3, max(l_quantity) AS hi FROM lineitem")
def a18_describe(spark, sf_dir):
    """Quartiles by range-partitioned ranks: no task gathers the values."""
    q, li = "l_quantity", table(spark, sf_dir, "lineitem").select("l_quantity")
    one = li.agg(F.count(q).alias("n"), F.round(F.avg(q), 6).alias("mean"), F.round(F.stddev_samp(q), 6).alias("sd"), F.min(q).alias("lo"), F.max(q).alias("hi"))
    at = metrics.quantiles(li, q, [0.25, 0.75]).agg(F.max(F.when(F.col("share") == 0.25, F.col("value"))).alias("q1"), F.max(F.when(F.col("share") == 0.75, F.col("value"))).alias("q3"))
    return one.join(F.broadcast(at))


@query("a19_having", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, l_partkey LIMIT 20")
def a19_having(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.desc("n"), "l_partkey").limit(20)


_RANKED = "(SELECT l_orderkey, l_returnflag = 'R' AS truth, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem)"
_FIRST = f"(SELECT l_orderkey, min(CASE WHEN truth THEN r END) AS pos FROM {_RANKED} GROUP BY 1)"


@query(
    "a20_recall_at_k",
    f"""SELECT count(*) AS pools, count(pos) AS with_truth, round(avg((coalesce(pos, 1000000) <= 1)::INT), 9) AS recall_all_1, round(avg((coalesce(pos, 1000000) <= 3)::INT), 9) AS recall_all_3,
    round(avg(CASE WHEN pos IS NOT NULL THEN (pos <= 1)::INT END), 9) AS recall_pool_1, round(avg(CASE WHEN pos IS NOT NULL THEN (pos <= 3)::INT END), 9) AS recall_pool_3, round(avg(1.0 / pos), 9) AS mrr FROM {_FIRST}""",
)
def a20_recall_at_k(spark, sf_dir):
    """Recall under both denominators, over pools with a positive, and the mean reciprocal rank (also A21, A22)."""
    r = F.row_number().over(W.partitionBy("l_orderkey").orderBy(F.desc("l_quantity"), "l_linenumber", "l_partkey", "l_suppkey"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_returnflag") == "R").alias("truth"), r.alias("r"))
    m = metrics.recall_at(li, "l_orderkey", "r", "truth", [1, 3])
    return m.select("pools", "with_truth", *[F.round(c, 9).alias(c) for c in m.columns[2:]])


@query(
    "a22_rescue_damage",
    """WITH b AS (SELECT l_orderkey, max_by(l_returnflag, l_extendedprice) = 'R' AS old, max_by(l_returnflag, l_extendedprice * (1 - l_discount)) = 'R' AS new FROM lineitem GROUP BY 1)
    SELECT count(*) FILTER (WHERE new AND NOT old) AS rescue, count(*) FILTER (WHERE old AND NOT new) AS damage FROM b""",
)
def a22_rescue_damage(spark, sf_dir):
    first = lambda c: F.max_by("l_returnflag", c) == "R"
    b = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(first(F.col("l_extendedprice")).alias("old"), first(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("new"))
    return b.agg(F.count_if(F.col("new") & ~F.col("old")).alias("rescue"), F.count_if(F.col("old") & ~F.col("new")).alias("damage"))


_LAB = "(SELECT (n_chars // 200)::DOUBLE AS s, quality AS y FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL)"


def labelled(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("n_chars") / 200).cast("double").alias("s"))
    return table(spark, sf_dir, "labels").where("quality is not null").select("doc_id", F.col("quality").alias("y")).join(d, "doc_id").select("s", "y")


@query(
    "a23_precision_wilson",
    f"""WITH c AS (SELECT unnest([1.0, 5.0, 10.0, 20.0]) AS cutoff), t AS (SELECT cutoff, count(*) AS n, sum(y) AS k FROM c JOIN {_LAB} ON s >= cutoff GROUP BY 1)
    SELECT cutoff::DOUBLE AS cutoff, n, k::BIGINT AS k, round((k/n + 1.96*1.96/(2*n) - 1.96*sqrt(k/n*(1-k/n)/n + 1.96*1.96/(4*n*n))) / (1 + 1.96*1.96/n), 9) AS lo,
    round((k/n + 1.96*1.96/(2*n) + 1.96*sqrt(k/n*(1-k/n)/n + 1.96*1.96/(4*n*n))) / (1 + 1.96*1.96/n), 9) AS hi FROM t""",
)
def a23_precision_wilson(spark, sf_dir):
    """Precision by cutoff with Wilson bounds: scores are combined first, and each falls in the cutoffs at or below it."""
    g = metrics.by_score(labelled(spark, sf_dir), "s", "y").withColumn("cutoff", F.explode(F.filter(F.array(*[F.lit(x) for x in (1.0, 5.0, 10.0, 20.0)]), lambda c: c <= F.col("s"))))
    t = g.groupBy("cutoff").agg(F.sum("n").alias("n"), F.sum("pos").alias("k"))
    lo, hi = metrics.wilson(F.col("k"), F.col("n"))
    return t.select("cutoff", "n", "k", F.round(lo, 9).alias("lo"), F.round(hi, 9).alias("hi"))


@query("a24_n_for_ci", "SELECT min(n) AS n FROM (SELECT unnest(range(1, 5000)) AS n) WHERE 2 * 1.96 * sqrt(0.9 * 0.1 / n + 1.96 * 1.96 / (4 * n * n)) / (1 + 1.96 * 1.96 / n) <= 0.1")
def a24_n_for_ci(spark, sf_dir):
    """Fewest plants for a Wilson interval of at most 0.1 at precision 0.9."""
    lo, hi = metrics.wilson(F.col("id") * 0.9, F.col("id"))
    return spark.range(1, 5000).where(hi - lo <= 0.1).agg(F.min("id").alias("n"))


@query(
    "a25_accept_table",
    f"""WITH g AS (SELECT s, count(*) AS n, sum(y) AS p FROM {_LAB} GROUP BY 1)
    SELECT s, sum(n) OVER w AS n_accepted, sum(p) OVER w AS n_right, round(sum(p) OVER w / sum(n) OVER w, 9) AS precision FROM g WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)""",
)
def a25_accept_table(spark, sf_dir):
    return metrics.accept_table(labelled(spark, sf_dir), "s", "y").withColumn("precision", F.round("precision", 9))


@query(
    "a26_roc",
    f"""WITH g AS (SELECT s, count(*) AS n, sum(y) AS p FROM {_LAB} GROUP BY 1), c AS (SELECT s, sum(p) OVER w AS tp, sum(n - p) OVER w AS fp, sum(p) OVER () AS pt, sum(n - p) OVER () AS ft FROM g WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING))
    SELECT s, tp, fp, round(tp / pt, 9) AS tpr, round(fp / ft, 9) AS fpr, round(tp / pt - fp / ft, 9) AS j FROM c""",
)
def a26_roc(spark, sf_dir):
    r = metrics.roc(labelled(spark, sf_dir), "s", "y")
    return r.select("s", "tp", "fp", *[F.round(c, 9).alias(c) for c in ("tpr", "fpr", "j")])


@query(
    "a27_auc",
    f"""SELECT round((sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 9) AS auc
    FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS rk FROM {_LAB})""",
)
def a27_auc(spark, sf_dir):
    return metrics.auc(labelled(spark, sf_dir), "s", "y").select(F.round("auc", 9).alias("auc"))


@query(
    "a28_confusion",
    f"""SELECT count(*) FILTER (WHERE s >= 10 AND y = 1) AS tp, count(*) FILTER (WHERE s >= 10 AND y = 0) AS fp, count(*) FILTER (WHERE s < 10 AND y = 1) AS fn, count(*) FILTER (WHERE s < 10 AND y = 0) AS tn,
    round(avg(pow(least(s / 50, 1) - y, 2)), 9) AS brier, round(avg(((s >= 10)::INT = y)::INT), 9) AS accuracy FROM {_LAB}""",
)
def a28_confusion(spark, sf_dir):
    hit, y = F.col("s") >= 10, F.col("y") == 1
    return labelled(spark, sf_dir).agg(
        F.count_if(hit & y).alias("tp"), F.count_if(hit & ~y).alias("fp"), F.count_if(~hit & y).alias("fn"), F.count_if(~hit & ~y).alias("tn"),
        F.round(F.avg(F.pow(F.least(F.col("s") / 50, F.lit(1.0)) - F.col("y"), 2)), 9).alias("brier"), F.round(F.avg((hit.cast("int") == F.col("y")).cast("int")), 9).alias("accuracy"),
    )


@query("a29_coverage", "SELECT c_nationkey, round(avg((c_acctbal >= 0)::INT), 9) AS share, avg((c_acctbal >= 0)::INT) < 0.9 AS low FROM customer GROUP BY 1")
def a29_coverage(spark, sf_dir):
    s = F.avg((F.col("c_acctbal") >= 0).cast("int"))
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.round(s, 9).alias("share"), (s < 0.9).alias("low"))


@query(
    "a30_ring_curve",
    "SELECT k, count(*) FILTER (WHERE l_linenumber <= k) AS recovered, count(*) AS ceiling, max(3 * k * k + 3 * k + 1) AS pool FROM lineitem, (SELECT unnest([1, 2, 4, 8]) AS k) GROUP BY 1",
)
def a30_ring_curve(spark, sf_dir):
    """One pass: counts by ring first, then the few rings against the few radii."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    g = g.withColumn("k", F.explode(F.array(*[F.lit(k) for k in (1, 2, 4, 8)])))
    return g.groupBy("k").agg(F.sum(F.when(F.col("l_linenumber") <= F.col("k"), F.col("n")).otherwise(0)).alias("recovered"), F.sum("n").alias("ceiling"), F.max(3 * F.col("k") * F.col("k") + 3 * F.col("k") + 1).alias("pool"))


@query(
    "a31_mcnemar_counts",
    "WITH b AS (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS a, bool_or(o_orderpriority = '1-URGENT') AS b FROM orders GROUP BY 1) SELECT count(*) FILTER (WHERE a AND NOT b) AS only_a, count(*) FILTER (WHERE b AND NOT a) AS only_b, count(*) FILTER (WHERE a AND b) AS both FROM b",
)
def a31_mcnemar_counts(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("a"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("b"))
    return g.agg(F.count_if(F.col("a") & ~F.col("b")).alias("only_a"), F.count_if(F.col("b") & ~F.col("a")).alias("only_b"), F.count_if(F.col("a") & F.col("b")).alias("both"))


@query("a32_class_weights", "SELECT quality, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 9) AS weight FROM labels WHERE quality IS NOT NULL GROUP BY 1")
def a32_class_weights(spark, sf_dir):
    g = table(spark, sf_dir, "labels").where("quality is not null").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy()  # a row a class
    return g.select("quality", F.round(F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n")), 9).alias("weight"))


@query("a33_zero_filled", "SELECT n_name, count(s_suppkey) AS n, coalesce(sum((s_acctbal > 0)::INT), 0)::BIGINT AS positive FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def a33_zero_filled(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("s_suppkey").alias("n"), F.sum((F.col("s_acctbal") > 0).cast("int")).alias("positive"))
    return table(spark, sf_dir, "nation").join(s, "n_nationkey", "left").select("n_name", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("positive", F.lit(0)).alias("positive"))


@query(
    "a34_idf",
    """WITH t AS (SELECT DISTINCT p_partkey, unnest(string_split(lower(p_name), ' ')) AS tok FROM part), n AS (SELECT count(*) AS n FROM part)
    SELECT tok, count(*) AS df, round(ln((1 + n) / (1 + count(*))) + 1, 9) AS idf FROM t, n WHERE tok <> '' GROUP BY tok, n""",
)
def a34_idf(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    n = p.count()
    t = p.select(F.explode(F.array_distinct(F.split(F.lower("p_name"), " "))).alias("tok")).where("tok <> ''")
    return t.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).withColumn("idf", F.round(F.log(F.lit(1 + n) / (1 + F.col("df"))) + 1, 9))


@query("a35_any_all", "SELECT o_custkey, bool_or(o_orderstatus = 'F') AND NOT bool_and(o_orderstatus = 'F') AS contradicts FROM orders GROUP BY 1")
def a35_any_all(spark, sf_dir):
    f = F.col("o_orderstatus") == "F"
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg((F.bool_or(f) & ~F.bool_and(f)).alias("contradicts"))


@query("a36_versions", "SELECT l_orderkey, bool_or(l_returnflag = 'R') AS any_r, count(*) AS n, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) AS parts FROM lineitem GROUP BY 1")
def a36_versions(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("any_r"), F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("l_linenumber")), ",").alias("parts"))
