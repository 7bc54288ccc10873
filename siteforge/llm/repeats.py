"""Removal of repeated byte strings by longest-previous-factor arrays over sparse suffix arrays.

Every string of LENGTH bytes that starts at two places of the corpus is repeated; the bytes it covers are removed, at all places
(the default) or at all but the first (keep_first). Matches never cross documents. Exact, whatever the number of copies:

1. Every start gets an anchor: the position, among those its string holds, whose gram of a quarter of LENGTH has the least hash.
   Equal strings have equal anchors, so only starts with the same anchor hash (key) need be compared. Neighbouring starts share
   anchors; a run of starts with one anchor is a row (key, hash of all the bytes its starts cover). Rows of keys seen once go.
2. Rows are counted by (key, hash). Rows found twice are repeated as a whole.
3. For keys with several different rows, one representative of each is fetched, and the suffixes at their starts are sorted: a
   sparse suffix array. Where neighbours in suffix order have LENGTH common bytes, the one ahead gives the other's longest previous
   factor and the one behind its longest next factor (cut at LENGTH), which mark a repeated start. Tasks take whole keys
   in chunks of bounded size. A key of more than MAX_ROWS different rows (a passage in very many surroundings) is dealt out first:
   its rows are cut into runs of WIDTH starts whose key is what they share, and step 2 is taken again; what still differs is cut
   into single strings, whose equals count as one another's factors. No task gathers such a key.

Every join takes the same way at every size. Documents are exchanged only where a bitmap of fixed size says that they may have
rows. Nulls: a null text is empty; ids may be null. Rows are known by two 64-bit hashes of (doc_id, text); repeated rows are copies of
one another, and with keep_first the second loses every byte that a string covers. Ties (equal hashes of grams in one window) go to
the first; among copies the one with the least hash is the first. Texts under LENGTH bytes are kept whole, an empty table gives an
empty result, and very long texts take memory in proportion in one worker. Columns of the operator's names are replaced.

Beside the bytes, n_shared_words (siteforge/llm/passages.py) counts the words in strings of WORDS words that another document also has;
many of these are shorter than LENGTH bytes. Nothing is removed for them.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.llm.common import cut, frugal, possibly, read, widened
from siteforge.llm.passages import covered, shared_windows
from siteforge.llm.rolling import gram_hashes, window_min

LENGTH, WORDS = 400, 51
MAX_ROWS, CHUNK, WIDTH = 1000, 60_000, 16


def anchors(data: bytes, length: int, k: int) -> tuple[np.ndarray, ...]:
    """(key, whole, lo, n, off): runs of n starts from lo with one anchor, off bytes behind lo; its hash and that of the bytes they cover."""
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    h = gram_hashes(np.frombuffer(data, dtype=np.uint8), k)
    ranked = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)  # ties: the first
    at = (window_min(ranked, length - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lo = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    n = np.diff(lo, append=len(at))
    a, view, digest = at[lo], memoryview(data), xxhash.xxh3_64_intdigest
    whole = np.array([digest(view[s : s + c - 1 + length], int(x - s)) for s, c, x in zip(lo.tolist(), n.tolist(), a.tolist())], dtype=np.uint64).view(np.int64)
    return h[a].view(np.int64), whole, lo, n, a - lo


def factors(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and next factor (at most `length` bytes) of each start among the starts, which ascend.

    The suffixes are sorted by `length` bytes, ties by position. Factors are told only where they reach `length`, else they are 0: there
    neighbours in suffix order with `length` common bytes ascend by position, so the one ahead is a previous factor and the one behind a
    next factor.
    """
    rows = np.lib.stride_tricks.sliding_window_view(data, length)[starts]
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{length}").ravel(), kind="stable")
    ordered = rows[order]
    if length % 8 == 0:
        ordered = ordered.view(np.uint64)
    full = np.flatnonzero((ordered[1:] == ordered[:-1]).all(axis=1))
    lpf, lnf = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    lpf[order[full + 1]] = length
    lnf[order[full]] = length
    return lpf, lnf


ROW = [("u1", "bigint"), ("u2", "bigint"), ("key", "bigint"), ("whole", "bigint"), ("lo", "int"), ("n", "int"), ("off", "int")]


def _schema(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"{c} {t}" for c, t in columns)


def _encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _anchor_rows(docs: DataFrame, length: int, k: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at : at + 512]
                made = [anchors(_encoded(t), length, k) for t in part["text"]]
                sizes = [len(m[0]) for m in made]
                out = {"u1": np.repeat(part["u1"].to_numpy(), sizes), "u2": np.repeat(part["u2"].to_numpy(), sizes)}
                yield pd.DataFrame(out | {c: np.concatenate([m[i] for m in made]) for i, (c, _) in enumerate(ROW[2:])})

    return docs.select("u1", "u2", "text").mapInPandas(frugal(run), _schema(ROW))


def _fetch(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """wanted (ROW, big) with data, the bytes that a row's starts cover."""
    names = [c for c, _ in ROW[2:]] + ["big"]
    lists = wanted.groupBy("u1", "u2").agg(F.collect_list(F.struct(*names)).alias("want"))  # at most a document's rows
    joined = possibly(docs, wanted, "u1").where("_hit").join(lists, ["u1", "u2"]).select("u1", "u2", "text", "want")

    def run(batches):
        for b in batches:
            out, size = [], 0
            for u1, u2, t, want in zip(b["u1"], b["u2"], b["text"], b["want"]):
                data = _encoded(t)
                out += [(u1, u2, *(w[c] for c in names), data[w["lo"] : w["lo"] + w["n"] - 1 + length]) for w in want]
                size += sum(w["n"] - 1 + length for w in want)
                if size > 2_000_000:
                    yield pd.DataFrame(out, columns=["u1", "u2", *names, "data"])
                    out, size = [], 0
            yield pd.DataFrame(out, columns=["u1", "u2", *names, "data"])

    # a copy of a row (doc_id, text) brings the same rows again
    return joined.dropDuplicates(["u1", "u2"]).mapInPandas(run, _schema([*ROW, ("big", "boolean"), ("data", "binary")]))


def _by_factors(rows: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """Repeated starts (u1, u2, s, e) of fetched rows, keys kept together."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["u1", "u2", "lo"], kind="stable")
        data = np.frombuffer(b"".join(pdf["data"]), dtype=np.uint8)
        n = pdf["n"].to_numpy()
        begin = np.cumsum(n + length - 1) - (n + length - 1)
        starts = np.concatenate([np.arange(b, b + c) for b, c in zip(begin, n)])
        lpf, lnf = factors(data, starts, length)
        flags = lpf >= length if keep_first else (lpf >= length) | (lnf >= length)
        row = np.repeat(np.arange(len(n)), n)
        on = np.flatnonzero(flags)
        apart = (np.diff(on) > 1) | (np.diff(row[on]) > 0)  # a run ends with its row
        first, last = on[np.concatenate([[True], apart])[: len(on)]], on[np.concatenate([apart, [True]])[: len(on)]]
        at = row[first]
        moved = pdf["lo"].to_numpy()[at] - (np.cumsum(n) - n)[at]
        return pd.DataFrame({"u1": pdf["u1"].to_numpy()[at], "u2": pdf["u2"].to_numpy()[at], "s": first + moved, "e": last + moved})

    def run(batches):
        held = None
        for b in batches:
            held = b if held is None else pd.concat([held, b], ignore_index=True)
            if held["n"].sum() < CHUNK:
                continue
            open_ = held["key"] == held["key"].iloc[-1]  # its rows may go on in the next batch
            if not open_.all():
                yield from pieces(held[~open_])
                held = held[open_]
        if held is not None and len(held):
            yield from pieces(held)

    def pieces(pdf: pd.DataFrame):
        first = np.flatnonzero(np.concatenate([[True], np.diff(pdf["key"].to_numpy()) != 0]))
        total = np.concatenate([[0], np.cumsum(pdf["n"].to_numpy())])
        begin = 0
        for a, b in zip(first, [*first[1:], len(pdf)]):
            if total[b] - total[begin] >= CHUNK or b == len(pdf):
                yield solve(pdf.iloc[begin:b])
                begin = b

    return rows.repartition("key").sortWithinPartitions("key").mapInPandas(run, "u1 bigint, u2 bigint, s int, e int")


def _dealt(rows: DataFrame, length: int, width: int) -> DataFrame:
    """Fetched rows cut into rows of at most `width` starts, aligned by their distance from the anchor.

    The new key is the hash of the bytes that all starts of such a row share, so equal strings still have equal keys. plo: the start
    of the row it comes from.
    """

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            out = []
            for u1, u2, lo, n, off, data in zip(b["u1"], b["u2"], b["lo"], b["n"], b["off"], b["data"]):
                view, s = memoryview(data), 0
                while s < n:
                    d = off - s  # the anchor is so many bytes behind this start
                    c = min(n - s, d % width + 1)
                    core = s + d % width  # where the last start of this band of distances is, whether the row holds it or not
                    key = digest(view[core : core + length - width + 1], d // width)
                    out.append((u1, u2, key - (1 << 63), digest(view[s : s + c - 1 + length], d) - (1 << 63), lo + s, c, d, lo))
                    s += c
            yield pd.DataFrame(out, columns=[*(c for c, _ in ROW), "plo"])

    return rows.mapInPandas(run, _schema([*ROW, ("plo", "int")]))


def _classes(rows: DataFrame, keep_first: bool) -> tuple[DataFrame, DataFrame]:
    """Runs (u1, u2, s, e) of rows found twice or more as a whole, and a representative of each class of a key that has several."""
    rest = [c for c in rows.columns if c not in ("key", "whole")]
    classes = rows.groupBy("key", "whole").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("u1", "u2", "lo", *[c for c in rest if c not in ("u1", "u2", "lo")])).alias("r"))
    classes = cut(classes)
    several = classes.where("c > 1").select("key", "whole", F.struct("r.u1", "r.u2", "r.lo").alias("first"))
    whole = rows.join(several, ["key", "whole"])
    if keep_first:
        whole = whole.where(F.struct("u1", "u2", "lo") != F.col("first"))
    # a table of its own, so that both sides of the join below are plain exchanges, which Spark splits where a key is hot
    keys = cut(classes.groupBy("key").agg(F.count(F.lit(1)).alias("different")).where("different > 1"))
    reps = classes.join(keys, "key").select("key", "whole", "different", "r.*")
    return whole.select("u1", "u2", F.col("lo").alias("s"), (F.col("lo") + F.col("n") - 1).alias("e")), reps


def _hot(rows: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """The same as _by_factors for keys of too many rows for one task: dealt out by what their starts share, to single strings at last."""
    sub = cut(_dealt(rows, length, WIDTH))
    found, reps = _classes(sub, keep_first)
    left = rows.join(reps.select("u1", "u2", F.col("plo").alias("lo"), F.col("lo").alias("s0"), F.col("n").alias("n0")), ["u1", "u2", "lo"])
    part = F.expr(f"substring(data, s0 - lo + 1, n0 - 1 + {length})")
    left = left.select("u1", "u2", "key", "whole", F.col("s0").alias("lo"), F.col("n0").alias("n"), (F.col("off") - F.col("s0") + F.col("lo")).alias("off"), part.alias("data"))
    single, _ = _classes(cut(_dealt(left, length, 1).drop("plo")), keep_first)
    return found.unionByName(single)


def repeated_starts(docs: DataFrame, length: int = LENGTH, k: int | None = None, keep_first: bool = False, max_rows: int = MAX_ROWS) -> DataFrame:
    """(u1, u2, s, e): runs of repeated starts in docs (u1, u2, text)."""
    rows = _anchor_rows(docs, length, k or max(1, length // 4))
    again = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    rows = cut(rows.join(again, "key", "left_semi"))  # a key seen once is not repeated at all
    found, reps = _classes(rows, keep_first)
    fetched = cut(_fetch(docs, reps.withColumn("big", F.col("different") > max_rows), length))
    return found.unionByName(_by_factors(fetched.where("not big"), length, keep_first)).unionByName(_hot(fetched.where("big").drop("big"), length, keep_first))


def remove_repeats(df: DataFrame, length: int = LENGTH, keep_first: bool = False, words: int = WORDS, **how) -> DataFrame:
    """df (doc_id, text, ...) with n_bytes, n_removed, n_spans, kept_sha256, n_shared_words and kept (the remaining bytes)."""
    new = [("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string"), ("n_shared_words", "bigint"), ("kept", "binary")]
    own = ["u1", "u2", "runs", "windows", "copy_", "_hit", "_b", "_p", "_m"]
    df, _ = widened(df, [*new, *((c, "string") for c in own)])
    keyed = df.withColumns({"u1": F.xxhash64("doc_id", "text"), "u2": F.xxhash64(F.lit(1), "text", "doc_id")})
    starts = repeated_starts(keyed.select("u1", "u2", "text"), length, keep_first=keep_first, **how)
    shared = shared_windows(keyed.select("u1", "u2", "text"), words)
    both = starts.select("u1", "u2", F.struct("s", "e").alias("r")).unionByName(shared, allowMissingColumns=True)
    runs = cut(both.groupBy("u1", "u2").agg(F.collect_list("r").alias("runs"), F.collect_list("w").alias("windows")))  # at most a document's starts
    if keep_first:  # a second row of the same id and text is a later copy as a whole
        joined = keyed.withColumn("copy_", F.row_number().over(W.partitionBy("u1", "u2").orderBy(F.lit(0)))).join(runs, ["u1", "u2"], "left")
    else:
        held = possibly(keyed.withColumn("copy_", F.lit(1)), runs, "u1")
        none = [F.lit(None).cast("array<struct<s:int,e:int>>").alias("runs"), F.lit(None).cast("array<bigint>").alias("windows")]
        joined = held.where("_hit").join(runs, ["u1", "u2"], "left").unionByName(held.where("not _hit").select("*", *none)).drop("_hit")
    joined = joined.drop("u1", "u2")
    base, schema = widened(joined.drop("runs", "windows", "copy_"), new)

    def run(batches):
        for b in batches:
            cols: dict[str, list] = {c: [] for c, _ in new}
            for text, found, windows, copy in zip(b["text"], b["runs"], b["windows"], b["copy_"]):
                data = _encoded(text)
                spans: list[list[int]] = []
                some = [(r["s"], r["e"] + length) for r in (found if found is not None else ())] if copy == 1 else [(0, len(data))] if len(data) >= length else []
                for s, e in sorted(some):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], e)
                    else:
                        spans.append([s, e])
                at, kept = 0, []
                for s, e in spans:
                    kept.append(data[at:s])
                    at = e
                rest = b"".join([*kept, data[at:]])
                for c, v in zip(cols, (len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), covered(windows, words), rest)):
                    cols[c].append(v)
            b = b.drop(columns=["runs", "windows", "copy_"])
            for c, t in new:
                b[c] = pd.Series(cols[c], index=b.index, dtype="int64" if t == "bigint" else object)
            yield b

    return joined.mapInPandas(frugal(run), schema)


def op9_repeats(spark, sf_dir):
    d = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared_words")
