"""Ranking, deduplication and competition over any DataFrame; every order ends in a unique tie-break given by the caller."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows of each group; the optimizer limits groups before the exchange."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def latest(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Newest row of each key, as an aggregate: hot keys are combined before the exchange."""
    rest = [c for c in df.columns if c not in by]
    best = F.max(F.struct(*order, F.struct(*[F.col(c).alias(f"v_{c}") for c in rest]).alias("v")))
    return df.groupBy(*by).agg(best.alias("b")).select(*by, *[F.col(f"b.v.v_{c}").alias(c) for c in rest])


def best_row(df: DataFrame, by: list[str], score: str, tie: str, descending: bool = True) -> DataFrame:
    """(by, tie, score) with the best numeric score; null scores come last, ties go to the smallest tie value of any type. An aggregate, so hot keys combine early."""
    s = -F.col(score) if descending else F.col(score)
    best = df.groupBy(*by).agg(F.min(F.struct(s.isNull().alias("none"), s.alias("s"), F.col(tie).alias("t"))).alias("m"))
    return best.select(*by, F.col("m.t").alias(tie), (-F.col("m.s") if descending else F.col("m.s")).alias(score))


def competition(df: DataFrame, place: str, plant: str, score: str) -> DataFrame:
    """Each place to its best plant, then each plant to its best place won."""
    return best_row(best_row(df, [place], score, plant), [plant], score, place)


def pool_features(df: DataFrame, pool: str, score: str) -> DataFrame:
    """Pool maximum, gap to it, how many reach it, share of the pool's sum (0 if the sum is 0), method-min rank."""
    w = W.partitionBy(pool)
    top, total = F.max(score).over(w), F.sum(score).over(w)
    df = df.withColumns({"pool_max": top, "pool_sum": total})
    return df.withColumns(
        {
            "gap": F.col("pool_max") - F.col(score),
            "n_at_max": F.sum((F.col(score) == F.col("pool_max")).cast("int")).over(w),
            "share": F.when(F.col("pool_sum") > 0, F.col(score) / F.col("pool_sum")).otherwise(0.0),
            "rank_min": F.rank().over(w.orderBy(F.desc(score))),
        }
    ).drop("pool_sum")


def near_tie_best(df: DataFrame, pool: str, score: str, band: float, order: list[Column]) -> DataFrame:
    """Best row by `order` among those within `band` of the pool's top score."""
    top = df.groupBy(pool).agg(F.max(score).alias("top"))
    return top_k(df.join(top, pool).where(F.col(score) >= F.col("top") - band), [pool], order, 1).drop("rank", "top")
