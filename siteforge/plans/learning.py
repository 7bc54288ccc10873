"""Training, folds, thresholds, leak guards and importances over customers and their orders."""
from __future__ import annotations

from pyspark.sql import functions as F

from siteforge.functions import text
from siteforge.operators import metrics, models
from siteforge.plans.points import lat, lon
from siteforge.plans.registry import query
from siteforge.sources.tables import table
from siteforge.storage import new_path

_S = "(SELECT l_orderkey, l_quantity AS s, (l_returnflag = 'R')::INT AS y FROM lineitem)"


def scored(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("s"), (F.col("l_returnflag") == "R").cast("int").alias("y"))


def customers(spark, sf_dir):
    k = F.col("c_custkey")
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("top"), F.count(F.lit(1)).alias("n"))
    c = table(spark, sf_dir, "customer").join(o, "c_custkey")
    return c.select("c_custkey", "c_mktsegment", "c_acctbal", "n", "c_nationkey", (F.col("top") > 350000).cast("double").alias("label"), lat(k).alias("lat"), lon(k).alias("lon"), (text.hash_fraction(k) * 3).cast("int").alias("fold"))


@query("x1_preprocess", "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END, 'unknown') AS seg, coalesce(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END, (SELECT quantile_cont(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END, 0.5) FROM customer)) AS bal FROM customer")
def x1_preprocess(spark, sf_dir):
    """Missing categories are their own, missing numbers the exact median."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 5 != 0, F.col("c_mktsegment")).alias("seg"), F.when(k % 7 != 0, F.col("c_acctbal")).alias("bal"))
    mid = metrics.quantiles(c, "bal", [0.5]).select(F.col("value").alias("m"))
    return c.na.fill("unknown", ["seg"]).join(F.broadcast(mid)).select("c_custkey", "seg", F.coalesce("bal", "m").alias("bal"))


@query("x3_balanced_forest")
def x3_balanced_forest(spark, sf_dir):
    """Scores of a forest whose trees see balanced bootstraps (rows only: trees are not SQL)."""
    d = customers(spark, sf_dir)
    m = models.train_balanced(d.where("fold <> 0"), ["c_mktsegment"], ["c_acctbal", "n"], "label", "c_custkey", trees=3)
    return models.score_balanced(m, d.where("fold = 0")).select("c_custkey", F.round("score", 4).alias("score"))


@query("x3_bootstrap_sizes", "SELECT 0.0::DOUBLE AS label, true AS near UNION ALL SELECT 1.0::DOUBLE, true")
def x3_bootstrap_sizes(spark, sf_dir):
    """Each class of a bootstrap has about as many draws as the smallest class has rows (within four standard deviations and two)."""
    d = customers(spark, sf_dir)
    least = d.groupBy("label").count().agg(F.min("count").alias("least"))
    n = models.undersampled(d, "label", "c_custkey", 1).groupBy("label").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(least))
    return n.select("label", (F.abs(F.col("n") - F.col("least")) <= 4 * F.sqrt("least") + 2).alias("near"))


@query("x4_search")
def x4_search(spark, sf_dir):
    """Forest settings tried at random over given folds, with their mean AUC."""
    _, done = models.search(customers(spark, sf_dir), ["c_mktsegment"], ["c_acctbal", "n"], "label", "fold", tries=2)
    return spark.createDataFrame([(h["trees"], h["depth"], h["leaf"], round(a, 6)) for h, a in done], "trees int, depth int, leaf int, auc double")


@query("x5_spatial_folds")
def x5_spatial_folds(spark, sf_dir):
    return models.spatial_folds(customers(spark, sf_dir).select("c_custkey", "lat", "lon"), "c_custkey")


@query("x6_group_folds")
def x6_group_folds(spark, sf_dir):
    """Every nation's customers are in one fold."""
    return models.group_folds(customers(spark, sf_dir), "c_nationkey", folds=3, blocks=8)


@query("x7_permutation_importance")
def x7_permutation_importance(spark, sf_dir):
    d = customers(spark, sf_dir)
    m = models.train(d.where("fold <> 0"), ["c_mktsegment"], ["c_acctbal", "n"], "label", trees=5)
    return models.permutation_importance(m, d.where("fold = 0"), "label", "c_custkey").select("feature", F.round("drop", 6).alias("drop"))


@query(
    "x8_thresholds",
    f"""WITH g AS (SELECT s, count(*) AS n, sum(y) AS p FROM {_S} GROUP BY 1), c AS (SELECT s, sum(p) OVER w AS tp, sum(n) OVER w AS na, sum(p) OVER () AS pt, sum(n) OVER () AS nt FROM g WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
    j AS (SELECT s, tp / pt - (na - tp) / (nt - pt) AS j, tp / na AS prec FROM c), y AS (SELECT s AS youden FROM j ORDER BY j DESC, s DESC LIMIT 1), b AS (SELECT max(s) AS bad FROM j WHERE prec < 0.2)
    SELECT youden, (SELECT min(s) FROM j, b WHERE bad IS NULL OR s > bad) AS plant, greatest(youden, (SELECT min(s) FROM j, b WHERE bad IS NULL OR s > bad)) AS accept FROM y""",
)
def x8_thresholds(spark, sf_dir):
    return models.thresholds(scored(spark, sf_dir), "s", "y", 0.2)


@query(
    "x10_leak_guard",
    "WITH f AS (SELECT 'copy' AS feature, y::DOUBLE AS v, y FROM (SELECT (l_returnflag = 'R')::INT AS y FROM lineitem) UNION ALL SELECT 'against', -y::DOUBLE, y FROM (SELECT (l_returnflag = 'R')::INT AS y FROM lineitem) UNION ALL SELECT 'size', l_quantity, (l_returnflag = 'R')::INT FROM lineitem), a AS (SELECT feature, (sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) AS auc FROM (SELECT feature, y, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2 AS rk FROM f) GROUP BY 1) SELECT feature, round(greatest(auc, 1 - auc), 9) AS auc, greatest(auc, 1 - auc) >= 0.995 AS leak, false AS empty FROM a UNION ALL SELECT 'nothing', 0.5, false, true",
)
def x10_leak_guard(spark, sf_dir):
    """Single features that tell the label, and those without a value."""
    y = (F.col("l_returnflag") == "R").cast("int")
    d = table(spark, sf_dir, "lineitem").select(y.alias("y"), y.cast("double").alias("copy"), (-y).cast("double").alias("against"), F.col("l_quantity").alias("size"), F.lit(None).cast("double").alias("nothing"))
    return models.leaks(d, ["copy", "against", "size", "nothing"], "y").withColumn("auc", F.round("auc", 9))


@query("x11_dead_features", "SELECT count(*) FILTER (WHERE n = 0) AS dead, sum(w)::BIGINT AS total, round(sum(CASE WHEN n = 0 THEN w ELSE 0 END) / sum(w), 9) AS share FROM (SELECT p_brand AS f, sum(p_size) AS w, count(*) FILTER (WHERE p_size > 49) AS n FROM part GROUP BY 1)")
def x11_dead_features(spark, sf_dir):
    p = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("feature"))
    d = models.dead_share(p.agg(F.sum("p_size").alias("weight")), p.agg(F.count_if(F.col("p_size") > 49).alias("n")))
    return d.select("dead", "total", F.round("share", 9).alias("share"))


@query("k14_model_persist", "SELECT count(*) AS n, true AS same FROM (SELECT DISTINCT o_custkey FROM orders)")
def k14_model_persist(spark, sf_dir):
    """A fitted pipeline is saved, loaded and scores alike."""
    from pyspark.ml import PipelineModel

    d = customers(spark, sf_dir)
    fitted, categories, numbers = models.train(d, ["c_mktsegment"], ["c_acctbal", "n"], "label", trees=3)
    path = new_path(spark, "k14")
    fitted.write().overwrite().save(path)
    again = (PipelineModel.load(path), categories, numbers)
    both = models.score((fitted, categories, numbers), d).select("c_custkey", F.col("score").alias("a")).join(models.score(again, d).select("c_custkey", F.col("score").alias("b")), "c_custkey")
    return both.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("a") == F.col("b")).alias("same"))
