"""Deterministic sampling: order comes from hashes of ids, never from row order."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.functions.text import hash_fraction


def hashed(key: Column, seed: str) -> Column:
    return F.sha1(F.concat_ws(":", F.lit(seed), key.cast("string")).cast("binary"))


def allocate(df: DataFrame, stratum: str, n: int) -> DataFrame:
    """(stratum, size, take): largest-remainder shares of n, at most the stratum's size; ties by name."""
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("size"))
    total = sizes.agg(F.sum("size").alias("total"))
    s = sizes.join(F.broadcast(total)).withColumn("exact", F.lit(n) * F.col("size") / F.col("total"))  # one row
    s = s.withColumns({"base": F.floor("exact"), "rest": F.col("exact") - F.floor("exact")})
    # one row for each stratum from here on
    extra = F.row_number().over(W.orderBy(F.desc("rest"), stratum)) <= F.lit(n) - F.sum("base").over(W.partitionBy())
    return s.select(stratum, "size", F.least("size", F.col("base") + extra.cast("int")).cast("bigint").alias("take"))


def stratified(df: DataFrame, stratum: str, key: str, n: int, seed: str = "s") -> DataFrame:
    """n rows in all, dealt to strata by allocate() and drawn by hash."""
    take = allocate(df, stratum, n)
    r = F.row_number().over(W.partitionBy(stratum).orderBy(hashed(F.col(key), seed), key))
    return df.withColumn("draw", r).join(take, stratum).where(F.col("draw") <= F.col("take")).drop("draw", "size", "take")


def weighted(df: DataFrame, key: str, weight: Column, n: int) -> DataFrame:
    """n rows without replacement with chance by weight: the smallest -ln(u) / weight."""
    u = (hash_fraction(F.col(key)) * 4294967296.0 + 0.5) / 4294967296.0
    return df.withColumn("draw", -F.log(u) / weight).orderBy("draw", key).limit(n).drop("draw")


def at_most(df: DataFrame, cell: list[str], key: str, k: int, seed: str = "c") -> DataFrame:
    """At most k rows of each cell, by hash."""
    r = F.row_number().over(W.partitionBy(*cell).orderBy(hashed(F.col(key), seed), key))
    return df.withColumn("draw", r).where(F.col("draw") <= k).drop("draw")


def negatives(df: DataFrame, key: str, positive: Column, keep: Column, hard: Column, ratio: int, hard_share: float) -> DataFrame:
    """All positives and kept rows; other negatives fill a budget of ratio * positives, hard_share of it from hard ones."""
    counts = df.agg(F.sum(positive.cast("bigint")).alias("p"), F.sum((keep & ~positive).cast("bigint")).alias("k")).first()  # two numbers
    room = max(0, ratio * (counts.p or 0) - (counts.k or 0))
    n_hard = int(room * hard_share)
    rest = df.where(~positive & ~keep)
    h = rest.where(hard).orderBy(hashed(F.col(key), "n"), key).limit(n_hard)
    easy = rest.where(~hard).orderBy(hashed(F.col(key), "n"), key).limit(room - n_hard)
    return df.where(positive | keep).unionByName(h).unionByName(easy)
