"""Strings of words that several documents have, whatever blanks stand between the words.

1. Every string of n words gets an anchor: the position, among those it holds, whose gram of a quarter of n words has the least hash.
   Equal strings have equal anchors. A run of starts with one anchor is a row (key, hash of all the words its starts cover).
2. Rows whose key one document alone has go. Rows are counted by (key, hash); those of two documents are shared as a whole.
3. Where a key has several different rows, the strings of those that one document has, and of one of each other kind, are counted.

Words are what stands between blanks (space, tab to carriage return); words, strings and rows are known by 64-bit hashes. Documents are
the rows of the table, so a repeated row shares all its strings; what a document repeats alone isn't shared.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteforge.llm.common import frugal, possibly
from siteforge.llm.rolling import mixed, powers, window_min
from siteforge.storage import stored

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_sums(text: str | None) -> np.ndarray:
    """Sums of the hashes of a text's words, each times a power of its place; one more than words."""
    b = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    edge = np.diff(~_BLANK[b], prepend=False, append=False)
    at = np.flatnonzero(edge)
    s, e = at[::2], at[1::2]
    r, inv = powers(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * r[: len(b)], out=total[1:])
    out = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mixed((total[e] - total[s]) * inv[s]) * r[: len(s)], out=out[1:])
    return out


def string_hashes(sums: np.ndarray, s: np.ndarray, n) -> np.ndarray:
    """Hashes of the strings of n words from s."""
    return mixed((sums[s + n] - sums[s]) * powers(len(sums))[1][s])


def word_anchors(text: str | None, n: int, k: int) -> tuple[np.ndarray, ...]:
    """(key, whole, place, new_key): runs of c starts from lo with one anchor; place: lo << 24, c << 1, and whether it is the text's first such run."""
    sums = word_sums(text)
    if len(sums) <= n:
        return *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, bool)
    h = string_hashes(sums, np.arange(len(sums) - k), k)
    ranked = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)  # ties: the first
    at = (window_min(ranked, n - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lo = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    c = np.diff(lo, append=len(at))
    key, off = h[at[lo]], at[lo] - lo
    whole = mixed(string_hashes(sums, lo, c - 1 + n) + (off * n + c).astype(np.uint64))  # c <= n - k + 1
    firsts = []
    for v in (key, whole):
        new = np.zeros(len(v), bool)
        new[np.unique(v, return_index=True)[1]] = True
        firsts.append(new)
    return key.view(np.int64), whole.view(np.int64), lo << 24 | c << 1 | firsts[1], firsts[0]


def _rows(docs: DataFrame, n: int, k: int) -> DataFrame:
    names = ("key", "whole", "place", "new_key")

    def run(batches):
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at : at + 512]
                made = [word_anchors(t, n, k) for t in part["text"]]
                sizes = [len(m[0]) for m in made]
                out = {u: np.repeat(part[u].to_numpy(), sizes) for u in ("u1", "u2")}
                yield pd.DataFrame(out | {c: np.concatenate([m[i] for m in made]) for i, c in enumerate(names)})

    return docs.select("u1", "u2", "text").mapInPandas(frugal(run), "u1 bigint, u2 bigint, key bigint, whole bigint, place bigint, new_key boolean")


def _strings(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(u1, u2, h, s, several): the strings of the wanted rows (u1, u2, place, whose last bit is now several)."""
    lists = wanted.groupBy("u1", "u2").agg(F.collect_list("place").alias("want"))  # at most a document's rows
    joined = possibly(docs, wanted, "u1").where("_hit").join(lists, ["u1", "u2"]).select("u1", "u2", "text", "want")

    def run(batches):
        for b in batches:
            for at in range(0, len(b), 512):
                made = []
                for u1, u2, t, want in b.iloc[at : at + 512][["u1", "u2", "text", "want"]].itertuples(index=False):
                    want = np.asarray(want)
                    lo, c, several = want >> 24, (want & 0xFFFFFF) >> 1, (want & 1).astype(bool)
                    s = np.repeat(lo - np.cumsum(c) + c, c) + np.arange(c.sum())
                    made.append((np.full(len(s), u1), np.full(len(s), u2), string_hashes(word_sums(t), s, n).view(np.int64), s, np.repeat(several, c)))
                if made:
                    yield pd.DataFrame({x: np.concatenate([m[i] for m in made]) for i, x in enumerate(("u1", "u2", "h", "s", "several"))})

    # a copy of a row (doc_id, text) brings the same strings again
    return joined.dropDuplicates(["u1", "u2"]).mapInPandas(frugal(run), "u1 bigint, u2 bigint, h bigint, s int, several boolean")


def shared_windows(docs: DataFrame, n: int, k: int | None = None) -> DataFrame:
    """(u1, u2, w): runs of starts of strings of n words of docs (u1, u2, text) that another document has; w: first start << 32, plus their number."""
    rows = stored(_rows(docs, n, k or max(1, n // 4)))  # tables of columns: a row's hashes stand many times in u1 and u2
    again = rows.where("new_key").groupBy("key").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1").select("key")
    rows = stored(rows.join(again, "key", "left_semi").drop("new_key"))
    # a repeated row (doc_id, text) is counted twice, as a document of its own; any row of a kind stands for it
    kinds = stored(rows.groupBy("key", "whole").agg((F.sum(F.col("place").bitwiseAND(1)) > 1).alias("several"), *[F.first(x).alias(x) for x in ("u1", "u2", "place")]))
    keys = stored(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("different")).where("different > 1").select("key"))
    left = kinds.join(keys, "key", "left_semi")
    known = kinds.where("several").select("key", "whole", "several").unionByName(left.where("not several").select("key", "whole", "several"))
    found = stored(rows.join(known, ["key", "whole"]).select("u1", "u2", "place", "several"))  # a row of one document also where that repeats it
    even = F.col("place").bitwiseAND(-2)
    wanted = found.where("not several").select("u1", "u2", even.alias("place")).unionByName(left.where("several").select("u1", "u2", (even + 1).alias("place")))
    strings = stored(_strings(docs, stored(wanted), n))
    shared = strings.groupBy("h").agg(F.min("u1").alias("a"), F.max("u1").alias("b"), F.max("several").alias("several")).where("a != b or several").select("h")
    single = strings.where("not several").join(shared, "h", "left_semi").select("u1", "u2", (F.shiftleft(F.col("s").cast("bigint"), 32) + 1).alias("w"))
    run = F.shiftleft(F.shiftright("place", 24), 32) + F.shiftright(F.col("place").bitwiseAND(0xFFFFFF), 1)
    return found.where("several").select("u1", "u2", run.alias("w")).unionByName(single)


def covered(windows: np.ndarray | None, n: int) -> int:
    """Words that the strings of n words of shared_windows() cover in a document."""
    if windows is None or not len(windows):
        return 0
    w = np.sort(np.asarray(windows, dtype=np.int64))
    s = w >> 32
    end = np.maximum.accumulate(s + (w & 0xFFFFFFFF) - 1 + n)
    return int((end - np.maximum(s, np.concatenate([[0], end[:-1]]))).clip(0).sum())
