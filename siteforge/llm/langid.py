"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over a bounded sample of labelled text. A text is parsed greedily into the
longest matches that the automaton allows; log2(sample length) bits a phrase, and log2(letters) more for a letter the sample lacks,
are the text's bits, and the language needing least wins. A short sample thus pays for what it does not hold. Whole texts are parsed,
in one pass for each language. Samples are drawn from distinct whole texts.

Where a bound is given, a text that needs more bits a letter in every language is `und` too. It comes from labelled texts outside the
samples: twice their median, and three phrases for short texts.

Nulls: a null text, or one without a letter, gives `und` and score 0. With no labelled text at all everything is `und`.
Ties go to the first language in alphabetical order. Repeated rows each get their row, and an empty table gives an empty result. A very
long text is parsed as a whole, in memory in proportion to it. Columns of the operator's names are replaced.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.llm.common import frugal, held, read, widened

#: The sample: at most so many distinct texts a language, the first by hash, of which those are taken, whole, that fit into so many
#: characters in all (one longer text where none fits).
SAMPLE_DOCS, SAMPLE_CHARS = 48, 24_000
#: Every fourth text is kept out of the sample for the bound: so many more are drawn, so many characters a language taken, and so many texts needed.
HELD_DOCS, HELD_CHARS, HELD_LEAST = 16, 12_000, 8
_NOT_LETTERS = regex.compile(r"\P{L}+")


def letters(text: str) -> str:
    """Lower-case words of letters, one space before, between and after them; '' if there is no letter."""
    s = _NOT_LETTERS.sub(" ", _lower(text)).strip()
    return f" {s} " if s else ""


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] for c in text)


def automaton(text: str) -> list[dict]:
    """Transitions of text's suffix automaton, by state (0: root): every substring is a path from the root."""
    nxt: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return nxt


class CrossParser:
    """All languages' automata in one table, to parse many texts side by side.

    An entry is (row of the next state) * 2, plus 1 if it begins a phrase: where the automaton has no transition, the phrase
    ends and the next begins in a copy of the root's successor. Memory: two states a sample character times the letters seen in
    the samples, 4 or 8 bytes each: with the default sample about 15 MB a language of an alphabet, 20 times that for large scripts.
    """

    def __init__(self, texts: tuple):
        self.langs = [lang for lang, _ in texts]
        self.bits = np.array([math.log2(len(t) + 1) for _, t in texts])
        alphabet = sorted({c for _, t in texts for c in t} | {" "})
        self.alphabet = alphabet
        code = {c: i for i, c in enumerate(alphabet)}
        unknown, width = len(alphabet), len(alphabet) + 1
        # code of every code point: a letter's lower case, or a space; unknown letters share one
        self.table = np.zeros(0x110000, dtype=np.uint16)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                self.table[cp] = code.get(c.lower()[0], unknown)
        parts, self.first, base = [], [], 0
        self.absent = np.ones((len(texts), width), dtype=np.int64)
        self.literal = math.log2(width)
        most = sum(2 * len(t) + 1 + width for _, t in texts) * width * 2
        for k, (_, text) in enumerate(texts):
            nxt = automaton(text)
            self.absent[k, [code[c] for c in nxt[0]]] = 0
            t = np.tile(((base + np.arange(width, dtype=np.int64)) * width * 2 + 1).astype(np.int32 if most < 2**31 else np.int64), (width + len(nxt), 1))
            for i, d in enumerate(nxt):
                for c, j in d.items():
                    t[width + i, code[c]] = (base + width + j) * width * 2
            for c, j in nxt[0].items():
                t[code[c]] = t[width + j]
            parts.append(t)
            self.first.append((base + unknown) * width * 2)
            base += len(t)
        self.next = np.concatenate(parts).ravel() if parts else np.zeros(0, dtype=np.int64)
        if base * width * 2 < 2**31:
            self.next = self.next.astype(np.int32)

    def codes(self, text: str) -> np.ndarray:
        """As letters(), in codes."""
        c = self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        letter = c != 0
        if not letter.any():
            return c[:0]
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # of a run of other characters the first stays
        c = c[keep]
        return np.concatenate([c[:0] if c[0] == 0 else np.zeros(1, c.dtype), c, np.zeros(int(c[-1] != 0), c.dtype)])

    def phrases(self, coded: list[np.ndarray]) -> np.ndarray:
        """Phrases (languages x texts) of the greedy longest-match parse; a letter the samples lack is a phrase."""
        order = np.argsort([-len(c) for c in coded], kind="stable")
        sizes = np.array([len(coded[i]) for i in order])
        flat = np.concatenate([coded[i] for i in order]) if len(coded) else np.zeros(0, np.uint16)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
        state = np.repeat(np.array(self.first, dtype=self.next.dtype)[:, None], len(coded), axis=1)
        count = np.zeros(state.shape, dtype=np.int64)
        left = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")  # texts longer than t
        for t, n in enumerate(left):
            s = self.next[(state[:, :n] >> 1) + flat[starts[:n] + t]]
            state[:, :n] = s
            count[:, :n] += s & 1
        out = np.empty_like(count)
        out[:, order] = count
        return out

    def cost(self, coded: list[np.ndarray]) -> np.ndarray:
        """Bits (languages x texts)."""
        width = self.absent.shape[1]
        lacking = [self.absent @ np.bincount(c, minlength=width) for c in coded]
        return self.phrases(coded) * self.bits[:, None] + self.literal * np.array(lacking, dtype=float).reshape(-1, len(self.langs)).T

    def predict(self, texts: list, bound: float = math.inf) -> tuple[list[str], list[float]]:
        coded = [self.codes(t) if t else np.zeros(0, np.uint16) for t in texts]
        if not self.langs:
            return ["und"] * len(coded), [0.0] * len(coded)
        bits = self.cost(coded)
        best = bits.argmin(axis=0)
        low = bits[best, np.arange(len(coded))]
        fits = [len(c) > 0 and a <= bound * len(c) + 3 * self.bits.max() for a, c in zip(low, coded)]
        bits[best, np.arange(len(coded))] = np.inf
        second = bits.min(axis=0) if len(self.langs) > 1 else np.array([5.0 * len(c) for c in coded])
        score = [float(min(1.0, max(0.0, (b - a) / b))) if b and f else 0.0 for a, b, f in zip(low, second, fits)]
        return [self.langs[i] if f else "und" for i, f in zip(best, fits)], score


def _drawn(labelled: DataFrame, docs: int) -> dict[str, list[tuple[int, int, int]]]:
    """(length, order, hash) of at most docs distinct labelled texts a language, the first by hash."""
    usable = labelled.where("lang is not null and text rlike '\\\\p{L}'").select("lang", F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    order = F.row_number().over(W.partitionBy("lang").orderBy("h"))
    by: dict[str, list] = {}
    for r in usable.distinct().withColumn("r", order).where(F.col("r") <= docs).collect():  # bounded
        by.setdefault(r.lang, []).append((r.n + 2, r.r, r.h))
    return {k: sorted(by[k], key=lambda x: x[1]) for k in sorted(by)}


def _fitting(drawn: list[tuple[int, int, int]], budget: int) -> list[int]:
    """Hashes of the texts that fit into the budget whole, in their order; the shortest if none does."""
    left, out = budget, []
    for n, _, h in drawn:
        if n <= left:
            left -= n
            out.append(h)
    return out or [min(drawn)[2]]


def _texts(labelled: DataFrame, wanted: list[tuple[str, int]]) -> dict[tuple[str, int], str]:
    """The letters of the wanted (lang, hash): whole texts."""
    if not wanted:
        return {}
    keys = labelled.sparkSession.createDataFrame(wanted, "lang string, h long")
    rows = labelled.select("lang", "text", F.xxhash64("text").alias("h")).join(F.broadcast(keys), ["lang", "h"])  # bounded by the sample
    return {(r.lang, r.h): letters(r.t) for r in rows.groupBy("lang", "h").agg(F.min("text").alias("t")).collect()}


def sample(labelled: DataFrame, docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """(language, text) sample of labelled (doc_id, text, lang): at most docs distinct texts a language, whole, and chars in all (one text may have more)."""
    chosen = {k: _fitting(v, chars) for k, v in _drawn(labelled, docs).items()}
    got = _texts(labelled, [(k, h) for k, v in chosen.items() for h in v])
    return [(k, "".join(got[k, h] for h in v)) for k, v in chosen.items()]


def sample_and_bound(labelled: DataFrame) -> tuple[list[tuple[str, str]], float]:
    """The sample, and the bits a letter beyond which no language fits (infinite with too few labelled texts)."""
    drawn = _drawn(labelled, SAMPLE_DOCS + HELD_DOCS)
    kept = {k: [x for i, x in enumerate(v) if i % 4 != 3] for k, v in drawn.items()}
    chosen = {k: _fitting(v, SAMPLE_CHARS) for k, v in kept.items()}
    held = {k: _fitting(v[3::4], HELD_CHARS) for k, v in drawn.items() if len(v) > 3}
    got = _texts(labelled, [(k, h) for part in (chosen, held) for k, v in part.items() for h in v])
    texts = [(k, "".join(got[k, h] for h in v)) for k, v in chosen.items()]
    known = [got[k, h] for k, v in held.items() for h in v]
    if len(known) < HELD_LEAST:
        return texts, math.inf
    parse = CrossParser(tuple(texts))
    coded = [parse.codes(t) for t in known]
    rate = (parse.cost(coded).min(axis=0) - 3 * parse.bits.max()).clip(0) / np.array([len(c) for c in coded])
    return texts, float(2 * np.median(rate))


def identify(df: DataFrame, texts: list[tuple[str, str]], bound: float = math.inf) -> DataFrame:
    """df with lang_pred and score (0 to 1: how much worse the second language parses it)."""
    df, schema = widened(df, [("lang_pred", "string"), ("score", "double")])
    frozen = tuple(texts)

    def run(batches):
        parse = held(("langid", frozen), lambda: CrossParser(frozen))
        for b in batches:
            lang, score = parse.predict(list(b["text"]), bound)
            b["lang_pred"] = pd.Series(lang, index=b.index, dtype=object)
            b["score"] = pd.Series(score, index=b.index, dtype=float)
            yield b

    return df.mapInPandas(frugal(run), schema)


def fold(modulus: int):
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")), F.lit(modulus))


def op8_language_id(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    texts = sample(d.where(fold(3) != 1).select("doc_id", "text", "lang"))
    return identify(d.select("doc_id", "text", (fold(3) == 1).alias("held_out")), texts).select("doc_id", "held_out", "lang_pred", "score")
