"""Evaluation metrics as aggregates."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.storage import cut


def wilson(hits: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    p, d = hits / n, 1 + z * z / n
    mid, half = (p + z * z / (2 * n)) / d, z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    return mid - half, mid + half


def by_score(df: DataFrame, score: str, label: str) -> DataFrame:
    """(score, n, pos): one row for each distinct score."""
    return df.groupBy(score).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"))


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df with running sums in the given total order, spread over all tasks: range partitions, each summed on its own, and one offset
    for each partition (a row a partition is all that one task sees)."""
    parts = cut(df.repartitionByRange(*order).withColumn("part_", F.spark_partition_id()))
    totals = parts.groupBy("part_").agg(*[F.sum(c).alias(f"{k}_t") for k, c in sums.items()])
    before = W.orderBy("part_").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("part_", *[F.coalesce(F.sum(f"{k}_t").over(before), F.lit(0)).alias(f"{k}_o") for k in sums])
    w = W.partitionBy("part_").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    out = parts.join(F.broadcast(offsets), "part_")
    return out.select(*df.columns, *[(F.sum(c).over(w) + F.col(f"{k}_o")).alias(k) for k, c in sums.items()])


def quantiles(df: DataFrame, value: str, shares: list[float]) -> DataFrame:
    """(share, value): quantiles with linear interpolation over all non-null values, none of them gathered in one task."""
    g = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    upto = running(g, [F.col("v")], {"last": F.col("n")})
    total = upto.agg(F.max("last").alias("total"))
    ranked = upto.join(F.broadcast(total)).withColumn("first", F.col("last") - F.col("n"))  # zero-based positions first .. last - 1
    at = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    near = ranked.select("*", at).withColumn("at", F.col("share") * (F.col("total") - 1))
    hit = lambda p: (F.col("first") <= p) & (p < F.col("last"))
    low, high = F.max(F.when(hit(F.floor("at")), F.col("v"))), F.max(F.when(hit(F.ceil("at")), F.col("v")))
    return near.groupBy("share").agg(low.alias("low"), high.alias("high"), F.max("at").alias("at")).select("share", (F.col("low") + (F.col("high") - F.col("low")) * (F.col("at") - F.floor("at"))).alias("value"))


def roc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Cumulative (score, tp, fp) by descending distinct score, with tpr, fpr and Youden's j."""
    g = by_score(df, score, label)
    total = g.agg(F.sum("pos").alias("p"), (F.sum("n") - F.sum("pos")).alias("f"))
    c = running(g, [F.desc(score)], {"tp": F.col("pos"), "fp": F.col("n") - F.col("pos")}).join(F.broadcast(total))  # one row
    return c.withColumns({"tpr": F.col("tp") / F.col("p"), "fpr": F.col("fp") / F.col("f")}).withColumn("j", F.col("tpr") - F.col("fpr"))


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Rank-sum AUC with average ranks for ties, from distinct scores."""
    g = running(by_score(df, score, label), [F.col(score)], {"upto": F.col("n") - F.col("pos")})
    g = g.withColumn("u", F.col("pos") * (F.col("upto") - (F.col("n") - F.col("pos")) / 2))
    return g.agg((F.sum("u") / (F.sum("pos") * (F.sum("n") - F.sum("pos")))).alias("auc"))


def accept_table(df: DataFrame, score: str, label: str) -> DataFrame:
    """(score, n_accepted, n_right, precision) for each threshold: the last row of each tie in cumulative order."""
    g = running(by_score(df, score, label), [F.desc(score)], {"n_accepted": F.col("n"), "n_right": F.col("pos")})
    return g.select(score, "n_accepted", "n_right", (F.col("n_right") / F.col("n_accepted")).alias("precision"))


def mcnemar(b: Column, c: Column) -> Column:
    """Exact two-sided p of McNemar's test from the two discordant counts: a binomial tail at 1/2, 1 without discordant pairs."""
    n, k = b + c, F.least(b, c)
    # the terms' logarithms are summed up step by step: log C(n, i) = log C(n, i - 1) + log((n - i + 1) / i)
    start = F.struct((-n * math.log(2.0)).cast("double").alias("t"), F.exp(-n * math.log(2.0)).cast("double").alias("s"))
    step = lambda a, i: F.struct((a["t"] + F.log((n - i + 1) / i)).alias("t"), (a["s"] + F.exp(a["t"] + F.log((n - i + 1) / i))).alias("s"))
    tail = F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k.cast("bigint"))).otherwise(F.array().cast("array<bigint>")), start, step)["s"]
    return F.least(F.lit(1.0), 2 * tail)


def recall_at(df: DataFrame, pool: str, rank: str, truth: str, ks: list[int]) -> DataFrame:
    """Share of pools (with a true row, and all) whose true row ranks at most k, and the mean reciprocal rank."""
    first = df.groupBy(pool).agg(F.min(F.when(F.col(truth), F.col(rank))).alias("at"))
    aggs = [F.avg((F.coalesce(F.col("at"), F.lit(1 << 30)) <= k).cast("double")).alias(f"recall_all_{k}") for k in ks]
    aggs += [F.avg(F.when(F.col("at").isNotNull(), (F.col("at") <= k).cast("double"))).alias(f"recall_pool_{k}") for k in ks]
    return first.agg(F.count(F.lit(1)).alias("pools"), F.count("at").alias("with_truth"), *aggs, F.avg(F.when(F.col("at").isNotNull(), 1 / F.col("at"))).alias("mrr"))
