"""Near-duplicates by five-word shingles at Jaccard similarity 0.8 or more, decided on the shingle sets themselves.

A text's set holds the 64-bit hashes of its 5-word shingles (all its words if it has fewer). Equal sets are merged to one node. Pairs
are proposed in two ways, verified alike:

- ball hashing of the sets' SimHash fingerprints, as in simhash: texts within RADIUS bits meet on a common variant;
- keys of joined minima, for the pairs that ball hashing can't reach: at similarity 0.8 two 64-bit fingerprints differ in about
  10 bits, and a ball of 5 bits around each has 8 million variants. Each of BANDS keys joins ROWS minima; two texts at similarity s
  share a key with probability 1 - (1 - s^ROWS)^BANDS: 0.99995 at 0.8.

All pairs of a key of at most ALL_PAIRS nodes are verified. In a larger one (a group of many near copies) each node is verified
against the key's leader, so that the work grows with the nodes: the one that meets most others over all its keys (the original of
edited copies, which need not be alike among themselves). The leaders only merge what is alike early; then every large key whose nodes
no chain of edges joins yet is settled without comparing all its pairs:

- in any one order of all shingles, two alike sets share one of the first |x| - 0.8 |x| + 1 of each. These are the keys of the first
  round; the order puts shingles that few sets have first, as far as at most SAMPLE sets tell (it decides the work, not the result).
  The first such shingle, at places i and j of the two orders, leaves at most min(|x| - i, |y| - j) to share.
- keys of one node, or of one component, end; where at most ALL_PAIRS pairs a node lie between components, these are verified. Else the
  smallest set L is compared with all others. Sets x and y are alike if they share at least 4/9 (|x| + |y|) shingles. An x that is not alike to L shares less than
  4/9 (|x| + |L|) with it, so what it shares with any y of the key can't all lie in L: at least t = 4/9 (|x| + max(|L|, 0.8 |x|)) -
  |x and L| shingles outside L are needed, of which one is among the first |x less L| - t + 1 of each: the keys of the next round.

Sets are made again from texts where pairs need them. Texts that a chain of pairs joins are sent to one task as long as they have at most
TOGETHER shingles; the pairs of longer chains are joined with their sets.

In the last of ROUNDS rounds all pairs between components of what keys are left are verified, so no link is lost; that round is
quadratic in such a key.

Nulls: null and empty texts have the empty set and are copies of one another. Repeated rows share a node, ties among leaders go to the
smallest node, an empty table has no nodes, and a very long text takes memory in proportion to its words.
"""
from __future__ import annotations

import math
import re
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from siteforge.llm import simhash
from siteforge.llm.common import cut, frugal, possibly, widened
from siteforge.operators.cluster import components

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
ALL_PAIRS, ROUNDS = 32, 6
TOGETHER = 1 << 20  # shingles: 8 MB
SAMPLE, LONGEST, COMMON = 1000, 4096, 50_000  # sets, shingles of each, shingles whose counts order all
_WORD = re.compile(rb"[^ \t-\r]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(42)
_XOR, _TIMES = (_RNG.integers(1 << 64, size=(BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(i) for i in (0, 1))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles."""
    h = np.array([xxhash.xxh64_intdigest(w, simhash.SEED) for w in _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())], dtype=np.uint64)
    if not len(h):
        return h
    n = max(1, len(h) - WORDS + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(min(WORDS, len(h))):
        out = (out ^ h[k : k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def bands(s: np.ndarray) -> np.ndarray:
    """BANDS keys of a set; none of the empty one, which only equals itself."""
    if not len(s):
        return np.zeros(0, dtype=np.int64)
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(s), 1024):
        np.minimum(low, ((s[None, i : i + 1024] ^ _XOR) * _TIMES).min(axis=1), out=low)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(low.reshape(BANDS, ROWS))], dtype=np.uint64).view(np.int64)


def sets(df: DataFrame, whole: bool = False) -> DataFrame:
    """df less its column text, with node (128-bit hash of the set), keys, print (fingerprint) and size (of the set); with `whole`, set_ (the set's bytes) only."""
    rest, schema = widened(df.drop("text"), [("node", "binary"), *([("set_", "binary")] if whole else [("keys", "array<bigint>"), ("print", "bigint"), ("size", "int")])])

    def run(batches):
        for b in batches:
            for at in range(0, len(b), 1000):
                part = b.iloc[at : at + 1000]
                made = [shingles(t) for t in part["text"]]
                out = part.drop(columns="text")
                out["node"] = pd.Series([xxhash.xxh3_128_digest(s.tobytes()) for s in made], index=out.index, dtype=object)
                if whole:
                    out["set_"] = pd.Series([s.tobytes() for s in made], index=out.index, dtype=object)
                else:
                    out["keys"] = pd.Series([bands(s) for s in made], index=out.index, dtype=object)
                    out["print"] = pd.Series(np.array([simhash.majority(s) for s in made], dtype=np.uint64).view(np.int64), index=out.index)
                    out["size"] = pd.Series([len(s) for s in made], index=out.index, dtype=np.int32)
                yield out

    return df.select(*rest.columns, "text").mapInPandas(frugal(run), schema)


def meetings(nodes: DataFrame) -> DataFrame:
    """(node, size, key, n, score) of nodes (node, size, keys) in keys of n > 1 nodes; score: how many others the node meets over all its keys."""
    met = nodes.select("node", "size", F.explode("keys").alias("key"))
    counts = cut(met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = cut(possibly(met, counts, "key").where("_hit").drop("_hit").join(counts, "key"))
    hot = met.where(F.col("n") > ALL_PAIRS).select("node").distinct()
    score = met.join(hot, "node", "left_semi").groupBy("node").agg(F.sum("n").alias("score"))
    return cut(met.join(score, "node", "left"))


def neighbours(fps: DataFrame) -> DataFrame:
    """The distinct fingerprints (fp) that may have another within 2 bits: of five blocks of bits those two have three in common."""
    edges = [0, 13, 26, 39, 52, 64]
    block = [sum(1 << i for i in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(block[i] for i in three) for three in combinations(range(5), 3)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("bigint"))) for i, m in enumerate(signed)])
    dealt = fps.select("fp", F.explode(keys).alias("key"))
    shared = cut(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    return possibly(dealt, shared, "key").where("_hit").join(shared, "key", "left_semi").select("fp").distinct()


def close(x, y, similarity: float):
    """Whether sets of sizes x and y can be alike."""
    return F.least(x, y) >= similarity * F.greatest(x, y)


def small_groups(met: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b), a < b, of the keys of at most ALL_PAIRS nodes in met (node, size, key, n), where sizes allow a link."""
    few = met.where(F.col("n") <= ALL_PAIRS).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "size"))).alias("f"))
    later = F.filter(F.slice("f", F.col("i") + 2, ALL_PAIRS), lambda y: close(F.col("x.size"), y["size"], similarity))
    return few.select("f", F.posexplode("f").alias("i", "x")).select(F.col("x.node").alias("a"), F.explode(later).alias("y")).select("a", F.col("y.node").alias("b"))


def led(hot: DataFrame) -> DataFrame:
    """(node, size, leader, lsize): each node of hot (node, size, key, score) with the leaders of its keys, each once."""
    top = F.min(F.struct((-F.col("score")).alias("s"), F.struct("node", "size").alias("l")))["l"]
    leaders = hot.groupBy("key").agg(top.alias("l"))
    return hot.join(leaders, "key").select("node", "size", F.col("l.node").alias("leader"), F.col("l.size").alias("lsize")).distinct()


def overlap(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard similarity of two sets, not both empty."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


@F.pandas_udf(DoubleType())
def jaccard(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([overlap(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b)], dtype=float)


def common(held: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, their counts) of those that at least two of some sets in held (set_) have."""
    some = held.where(F.length("set_") <= 8 * LONGEST).limit(SAMPLE).collect()
    h, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(r.set_, np.uint64) for r in some]]), return_counts=True)
    often = np.sort(np.argsort(-n, kind="stable")[: min(COMMON, int((n > 1).sum()))])
    return h[often], n[often]


def rarest(x: np.ndarray, counts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """x in the order of the counts (0: none), then of the hashes."""
    h, n = counts
    if not len(h):
        return np.sort(x)
    at = np.minimum(np.searchsorted(h, x), len(h) - 1)
    return x[np.lexsort((x, np.where(h[at] == x, n[at], 0)))]


def ahead(x: np.ndarray, similarity: float, counts) -> np.ndarray:
    """The shingles of x of which any alike set has one among its own."""
    return rarest(x, counts)[: max(0, len(x) - math.ceil(similarity * len(x) - 1e-6) + 1)]


def outside(x: np.ndarray, leader: np.ndarray, similarity: float, counts) -> tuple[bool, np.ndarray]:
    """(whether x is alike to the leader, its shingles outside it, of which any alike set, no smaller than the leader, has one among its own)."""
    rest = np.setdiff1d(x, leader, assume_unique=True)
    both = len(x) - len(rest)
    share = similarity / (1 + similarity)
    least = max(1, math.ceil(share * (len(x) + max(len(leader), similarity * len(x))) - both - 1e-6))
    return both / (len(x) + len(leader) - both) >= similarity, rarest(rest, counts)[: max(0, len(rest) - least + 1)]


def aheads(similarity: float, counts):
    """The shingles ahead, in order."""

    @F.pandas_udf("array<bigint>")
    def of(x: pd.Series) -> pd.Series:
        return pd.Series([ahead(np.frombuffer(a, np.uint64), similarity, counts).view(np.int64) for a in x], dtype=object)

    return of


def outsides(similarity: float, counts):
    @F.pandas_udf("alike boolean, keys array<bigint>")
    def of(x: pd.Series, leader: pd.Series) -> pd.DataFrame:
        made = [outside(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), similarity, counts) for a, b in zip(x, leader)]
        return pd.DataFrame({"alike": [m[0] for m in made], "keys": pd.Series([m[1].view(np.int64) for m in made], dtype=object)})

    return of


def texts_of(needed: DataFrame, docs: DataFrame) -> DataFrame:
    """needed (th, ...) with the text of docs (th, text), each once."""
    texts = possibly(docs, needed, "th").where("_hit").select("th", "text").join(needed.select("th").distinct(), "th", "left_semi").dropDuplicates(["th"])
    return needed.join(texts, "th")


def sets_of(needed: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, set_) of the distinct nodes in needed (node), made again from docs (th, text); nodes (node, th)."""
    needed = cut(nodes.join(needed, "node", "left_semi").select("th"))
    return cut(sets(texts_of(needed, docs), whole=True).select("node", "set_"))


def with_sets(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """pairs (a, b, ...) with their sets sa and sb of held (node, set_)."""
    side = lambda x: held.select(F.col("node").alias(x), F.col("set_").alias(f"s{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def alike(pairs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets in held are at the similarity or more."""
    both = with_sets(pairs, held).where(close(F.length("sa"), F.length("sb"), similarity))  # else their Jaccard is less
    return cut(both.withColumn("j", jaccard("sa", "sb")).where(F.col("j") >= similarity).select("a", "b"))


def together(held: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) at the similarity or more of held (label, node, others, text): node with each of the others, which have its label."""

    def run(batches):
        label, sets_, pairs = None, {}, []

        def found():
            good = [(a, b) for a, b in pairs if overlap(sets_[a], sets_[b]) >= similarity]
            return pd.DataFrame({x: pd.Series([p[i] for p in good], dtype=object) for i, x in enumerate("ab")})

        for batch in batches:
            for at, node, others, text in zip(batch["label"], batch["node"], batch["others"], batch["text"]):
                if at != label:
                    if pairs:
                        yield found()
                    label, sets_, pairs = at, {}, []
                sets_[node] = shingles(text)
                pairs += [(node, o) for o in (others if others is not None else ())]
        if pairs:
            yield found()

    dealt = held.select("label", "node", "others", "text").repartition("label").sortWithinPartitions("label")
    return dealt.mapInPandas(frugal(run), "a binary, b binary")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes at the similarity or more; sets are made where a pair needs them."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chains = cut(components(ends, pairs).join(nodes.select("node", "th", "size"), "node"))
    size = chains.groupBy("label").agg(F.sum("size").alias("all_"))
    others = pairs.groupBy(F.col("a").alias("node")).agg(F.collect_list("b").alias("others"))
    chains = cut(chains.join(size, "label").join(others, "node", "left"))
    few = chains.where(F.col("all_") <= TOGETHER).select("th", "label", "node", "others")
    many = chains.where(F.col("all_") > TOGETHER).select("node", "others")
    out = cut(together(texts_of(few, docs), similarity))
    if many.isEmpty():
        return out
    long = many.select(F.col("node").alias("a"), F.explode("others").alias("b"))
    return out.unionByName(alike(long, sets_of(many.select("node"), nodes, docs), similarity))


def settled(hot: DataFrame, edges: DataFrame, nodes: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """edges and those that join nodes of one key of hot (node, size, key) which no chain of edges joins. pos: the key's place in the set's order, 0 if not known."""
    names = cut(components(hot.select("node").distinct(), edges))

    def mixed(at: DataFrame) -> DataFrame:
        at = cut(at.join(names, "node"))
        least = F.min(F.struct("size", "node", "label"))
        parts = at.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), least.alias("l"))
        top = F.max(F.struct("c", "label"))["label"].alias("top")
        keys = parts.groupBy("key").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.min("l").alias("l"), top, F.count(F.lit(1)).alias("labels"))
        return cut(at.join(keys.where("labels > 1").select("key", "n", "l", "top", (F.expr("n * n - squares") / 2).alias("crossing")), "key"))

    def crossing(at: DataFrame) -> DataFrame:
        a = at.where("label <> top").select("key", F.col("node").alias("a"), F.col("label").alias("la"), F.col("size").alias("za"), F.col("pos").alias("pa"))
        b = at.select("key", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("size").alias("zb"), F.col("pos").alias("pb"))
        enough = F.least(F.expr("za - pa"), F.expr("zb - pb")) >= similarity / (1 + similarity) * F.expr("za + zb") - 1e-6  # shared at most, at least
        return a.join(b, "key").where(F.expr("la <> lb") & close("za", "zb", similarity) & enough).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    those = mixed(hot).select("node", "size").distinct()
    held = sets_of(those.select("node"), nodes, docs)
    counts = common(held)
    at = those.join(held.select("node", F.posexplode(aheads(similarity, counts)("set_")).alias("pos", "key")), "node")
    for left in reversed(range(ROUNDS)):
        at = mixed(at)
        direct = F.expr(f"crossing <= {ALL_PAIRS} * n") if left else F.lit(True)
        pairs = cut(crossing(at.where(direct)).distinct())
        new = [] if pairs.isEmpty() else [alike(pairs, held, similarity)]
        large = at.where(~direct).select(F.col("node").alias("a"), F.col("l.node").alias("b"), "size", F.expr("label <> l.label").alias("apart"))
        large = cut(large.where("a <> b").distinct())
        more = not large.isEmpty()
        if more:
            met = cut(with_sets(large, held).withColumn("o", outsides(similarity, counts)("sa", "sb")).select("a", "b", "size", "apart", "o.*"))
            new.append(met.where("alike and apart").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        for e in new:
            edges = edges.unionByName(e)
        if not more:
            return edges
        if not all(e.isEmpty() for e in new):
            names = cut(components(names.select("node"), edges))
        at = met.select(F.col("a").alias("node"), "size", F.explode("keys").alias("key"), F.lit(0).alias("pos")).distinct()
    return edges


def linked(nodes: DataFrame, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Edges (a, b) of nodes (node, th, keys, print, size) at the similarity or more, whose texts are in docs (th, text)."""
    printed = nodes.where("size > 0").select("node", "print")
    first = printed.groupBy("print").agg(F.min("node").alias("first"))
    balls = simhash.linked(neighbours(first.select(F.col("print").alias("fp"))))
    of = lambda x: first.select(F.col("print").alias(x), F.col("first").alias(f"n{x}"))
    ordered = lambda df, x, y: df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    near = ordered(balls.join(of("a"), "a").join(of("b"), "b"), "na", "nb")
    same = ordered(printed.join(first, "print").where("node <> first"), "node", "first")  # different sets of one print
    met = meetings(nodes.select("node", "size", "keys"))
    large = met.where(F.col("n") > ALL_PAIRS).select("node", "size", "key", "score")
    fit = led(large).where((F.col("node") != F.col("leader")) & close("size", "lsize", similarity))
    pairs = cut(small_groups(met, similarity).unionByName(near).unionByName(same).unionByName(ordered(fit, "node", "leader")).distinct())
    edges = verified(pairs, nodes, docs, similarity)
    return edges if large.isEmpty() else settled(large, edges, nodes, docs, similarity)


def labels(made: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, label) of the distinct nodes in made (th, node, keys, print, size), whose texts are in docs (th, text)."""
    nodes = cut(made.groupBy("node").agg(F.min(F.struct("th", "keys", "print", "size")).alias("m")).select("node", "m.*"))
    return components(nodes.select("node"), linked(nodes, docs))
