"""Similarity of vectors and of texts as weighted character n-grams."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERY_BLOCK, ROW_BLOCK = 512, 4096


def similar(queries: DataFrame, rows: DataFrame, key: str, column: str, least: float) -> DataFrame:
    """(q, v, sim): cosine over `least` of every query against all rows but itself.

    Both sides are packed into blocks of bounded size; each pair of blocks is one matrix product. Nulls and zero vectors match nothing.
    """

    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        d = df.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(F.col(key).alias("k"), F.col(column).alias("e"))

        def pack(batches):
            for b in batches:
                for at in range(0, len(b), size):
                    part = b.iloc[at : at + size]
                    m = np.stack([np.asarray(e, dtype=np.float64) for e in part["e"]])
                    yield pd.DataFrame({f"{name}k": [part["k"].tolist()], f"{name}m": [m.tobytes()], f"{name}n": [len(part)]})

        return d.mapInPandas(pack, f"{name}k array<{dict(df.dtypes)[key]}>, {name}m binary, {name}n int")

    kind = dict(rows.dtypes)[key]

    def product(batches):
        unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        for b in batches:
            for qk, qm, qn, rk, rm, rn in zip(b["qk"], b["qm"], b["qn"], b["rk"], b["rm"], b["rn"]):
                sim = unit(np.frombuffer(qm).reshape(qn, -1)) @ unit(np.frombuffer(rm).reshape(rn, -1)).T
                i, j = np.nonzero(sim > least)
                q, v = np.asarray(qk)[i], np.asarray(rk)[j]
                yield pd.DataFrame({"q": q, "v": v, "sim": sim[i, j]})[q != v]

    # a pair of blocks is a row; a stated query set against all rows
    pairs = blocks(rows, ROW_BLOCK, "r").crossJoin(blocks(queries, QUERY_BLOCK, "q"))
    return pairs.mapInPandas(product, f"q {kind}, v {kind}, sim double")


def ngram_cosine(names: DataFrame, key: str, column: str, sizes: tuple[int, ...] = (3, 4, 5)) -> DataFrame:
    """(a, b, sim), a < b: TF-IDF cosine of the distinct character n-grams of names that share one; pairs of a gram are summed up in Spark."""
    v = F.col(column)


    def of(n: int):
        return F.when(F.length(v) >= n, F.transform(F.sequence(F.lit(1), F.length(v) - n + 1), lambda i: F.substring(v, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    grams = F.array_distinct(F.flatten(F.array(*[of(n) for n in sizes])))
    g = names.select(F.col(key).alias("k"), F.explode(grams).alias("g"))
    total = names.agg(F.count(F.lit(1)).alias("total"))
    w = g.groupBy("g").agg(F.count(F.lit(1)).alias("df")).join(F.broadcast(total)).select("g", (F.log((1.0 + F.col("total")) / (1 + F.col("df"))) + 1).alias("w"))  # one row
    g = g.join(w, "g")
    norm = g.groupBy("k").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("z"))
    dot = g.select(F.col("k").alias("a"), "g", "w").join(g.select(F.col("k").alias("b"), "g"), "g").where("a < b").groupBy("a", "b").agg(F.sum(F.col("w") * F.col("w")).alias("d"))
    z = lambda x: norm.select(F.col("k").alias(x), F.col("z").alias(f"z{x}"))
    return dot.join(z("a"), "a").join(z("b"), "b").select("a", "b", (F.col("d") / F.col("za") / F.col("zb")).alias("sim"))
