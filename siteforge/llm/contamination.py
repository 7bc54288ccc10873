"""Benchmark decontamination by spaced seeds (DataFrame and SQL functions only).

Texts are cut into lower-case words of letters and digits. At every position each mask hashes the tokens it keeps and ignores
the others, in documents and benchmark items alike; equal hashes are hits. A hit fixes how item and document lie against each
other, and is verified there: some window of WINDOW tokens (the whole item if it is shorter) that holds the seed must agree in
at least SIMILARITY of its tokens. Verification happens beside the probe, so only (document, item) pairs that hold are exchanged.

The masks leave no gap: whatever tokens of a window (inside both texts) are substituted within SIMILARITY, some mask at some offset
keeps none of them. Items shorter than the span have masks of their own length: both halves, or the whole where nothing may differ.

Nulls: null texts have no tokens; a null doc_id or item_id is kept as it is. Items without a token match nothing. Repeated rows
each count as themselves; repeated ids share a row of the result, and ties between windows have equal agreement. Empty tables give an
empty result. Seeds carry only the tokens around them, so very long texts and items take memory in proportion. Other columns are not read.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteforge.llm.common import let, read

#: Fixed masks: 1 keeps a token, 0 ignores it.
MASKS = ("11010011", "10011101", "11101010", "01111100")
SPAN = len(MASKS[0])
WINDOW, SIMILARITY = 13, 0.8
#: Tokens on either side of a seed that a window holding it can reach.
AROUND = WINDOW - SPAN
#: Seeds of the benchmark that are broadcast at most (about 250 bytes each with the tokens around); more are exchanged.
MAX_BROADCAST = 200_000
_GAP = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Hashes of a text's tokens."""
    return F.transform(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _GAP), lambda w: w != ""), lambda w: F.xxhash64(w))


def masks(n: int) -> tuple[str, ...]:
    """The masks of items of n tokens."""
    if n >= SPAN:
        return MASKS
    half = n // 2
    return ("1" * half + "0" * (n - half), "0" * half + "1" * (n - half)) if n - math.ceil(n * SIMILARITY) else ("1" * n,)


def _seeds(df: DataFrame, h: str, at: str, keep: list[str], lengths: list[int], around: int = 0) -> DataFrame:
    """One row for each position and mask of the token hashes in column h: keep, at, seed, and (around > 0) near.

    lengths: the items' lengths to seed for, SPAN for all from there on. near: the tokens from `around` before the position to
    `around` beyond the seed's span. The whole array is not carried on.
    """
    n = F.size(h) - min(lengths, default=SPAN)
    # outer, as an inner explode would filter on the sequence first and cut the text into tokens twice
    df = df.withColumn(at, F.explode_outer(F.when(n >= 0, F.sequence(F.lit(0), n))))
    seeds = {}
    for size in lengths:
        for k, mask in enumerate(masks(size)):
            seed = F.xxhash64(F.lit(k if size == SPAN else 100 * size + k), *[F.get(F.col(h), F.col(at) + x) for x, c in enumerate(mask) if c == "1"])
            seeds[f"s{size}_{k}"] = seed if size == min(lengths) else F.when(F.col(at) + size <= F.col("size_"), seed)
    near = [F.slice(h, F.greatest(F.lit(1), F.col(at) + 1 - around), F.lit(SPAN + around) + F.least(F.lit(around), F.col(at))).alias("near")] if around else []
    df = df.withColumn("size_", F.size(h)).select(*keep, at, *near, *[c.alias(k) for k, c in seeds.items()])
    return df.select(*keep, at, *(["near"] if around else []), F.explode(F.array(*seeds)).alias("seed")).where(F.col(at).isNotNull() & F.col("seed").isNotNull())


def agreement(near: Column, before: Column, item: Column, j: Column, n: Column) -> Column:
    """Share of agreeing tokens in the best window of the item (n tokens) that holds the seed at j.

    near[before] lies against the seed's first token; item: the item's tokens from max(0, j - AROUND) on, as far as windows reach.
    """
    width = F.least(F.lit(WINDOW), n)
    low, high = F.greatest(F.lit(0), j + F.least(F.lit(SPAN), n) - width), F.least(j, n - width)
    first = F.greatest(F.lit(0), j - AROUND)
    part = F.slice(item, low - first + 1, high - low + width)
    same = F.transform(part, lambda v, t: F.when(F.get(near, t + low - j + before) == v, 1).otherwise(0))
    best = lambda s: F.array_max(F.transform(F.sequence(F.lit(0), high - low), lambda k: F.aggregate(F.slice(s, k + 1, width), F.lit(0), lambda a, x: a + x)))
    return let(same, best) / width


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, n_hits, agreement): documents that hold part of an item."""
    items = benchmark.select("item_id", tokens(F.col("text")).alias("ih")).where(F.size("ih") > 0).withColumn("n_", F.size("ih"))
    size = F.least(F.lit(SPAN), F.col("n_"))
    lengths = sorted(r[0] for r in items.select(size).distinct().collect())  # at most SPAN numbers
    if not lengths:
        lengths = [SPAN]
    # an item is seeded for its own length only
    parts = [_seeds(items.where(size == n), "ih", "j", ["item_id", "n_"], [n], AROUND).withColumnRenamed("near", "ih") for n in lengths]
    seeds = reduce(DataFrame.unionByName, parts)
    count = items.agg(F.sum(F.col("n_") * len(MASKS))).first()[0] or 0  # one number: the size check of the broadcast
    if count <= MAX_BROADCAST:
        seeds = F.broadcast(seeds)
    d = _seeds(docs.select("doc_id", tokens(F.col("text")).alias("h")), "h", "i", ["doc_id"], lengths, AROUND)
    hits = d.join(seeds, "seed").select("doc_id", "item_id", agreement(F.col("near"), F.least(F.lit(AROUND), F.col("i")), F.col("ih"), F.col("j"), F.col("n_")).alias("a"))
    # verified while aggregating: as a filter it would move into the join and take it out of code generation
    found = hits.groupBy("doc_id", "item_id").agg(F.count_if(F.col("a") >= similarity).alias("n_hits"), F.max("a").alias("agreement"))
    return found.where(F.col("agreement") >= similarity)


def op7_decontamination(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = contaminated(d, read(spark, sf_dir, "benchmark").select("item_id", "text"))
    return out.select("doc_id", "item_id", "n_hits", F.round("agreement", 6).alias("agreement"))
