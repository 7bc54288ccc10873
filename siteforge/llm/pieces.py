"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces come from a model file (a parameter; read once on the driver, a fixed size). Their log scores are the file's own if
it holds a unigram model; a file of ranked pieces (merges) holds no probabilities, so piece number r gets Zipf's law,
-ln((r + 2) * H), as tokenizers are not trained here. Characters no piece covers become bytes. Where pieces hold the space marker only
at their start, a text is cut before each run of markers and the best path of each cut is its own; cuts are cached, as words repeat.
The new cuts of some texts walk the trie and take their best paths together, in arrays; a cut of LONG characters or more goes by itself.
With a piece that crosses a word's start the text is one cut.

Nulls: a null text has null ids, no tokens and score 0; the empty text has no tokens. Ties: the longest last piece wins. Repeated rows
each get their row, an empty table gives an empty result, columns of the operator's names are replaced, and a very long text takes
memory in proportion to its longest cut and its ids.
"""
from __future__ import annotations

import math
import re
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteforge.llm.common import frugal, held, read, widened

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: What a byte of an unknown character adds to the score below the worst piece.
BYTE_PENALTY = 10.0
#: Cuts that are kept, in each of two generations: what the older one is asked for again moves to the younger.
CACHE = 50_000
#: Characters from which a cut is neither kept nor taken with others; characters of the texts whose cuts are taken together.
LONG, TOGETHER = 64, 200_000
_CUT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def load_pieces(path: str = MODEL) -> list[tuple[str, float, int]]:
    """(piece, score, type) by id; types as in the file: 1 normal, 2 unknown, 3 control, 6 byte."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    pieces = [(p.piece, p.score, p.type) for p in model.pieces]
    if model.trainer_spec.model_type == 1:
        return pieces
    normal = sum(t == 1 for _, _, t in pieces)
    h, rank, out = sum(1 / (r + 2) for r in range(normal)), -1, []
    for p, s, t in pieces:
        rank += t == 1
        out.append((p, -math.log((rank + 2) * h) if t == 1 else 0.0, t))
    return out


class DoubleArray:
    """Trie over UTF-8 bytes: from state s by byte c to base[s] + c + 1, if check there is s; value: piece id or -1."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        tree: dict = {}
        for key, value in keys:
            node = tree
            for c in key:
                node = node.setdefault(c, {})
            node[-1] = value
        self.base, self.check, self.value = array("i", [0]), array("i", [-1]), array("i", [-1])
        self._grow(512)
        self.check[0] = 0
        free, wide, stack = 257, 0, [(0, tree)]  # free: the first free place beyond the first bytes; wide: where the last branching state went
        while stack:
            state, node = stack.pop()
            self.value[state] = node.pop(-1, -1)
            codes = sorted(node)
            if not codes:
                continue
            at = max((free if len(codes) == 1 else max(free, wide)) - codes[0] - 1, 0)
            while True:
                self._grow(at + 258)
                if all(self.check[at + c + 1] < 0 for c in codes):
                    break
                at += 1
            self.base[state] = at
            if len(codes) > 1:
                wide = max(wide, at)
            for c in codes:
                self.check[at + c + 1] = state
                stack.append((at + c + 1, node[c]))
            while self.check[free] >= 0:
                free += 1
                self._grow(free + 1)

    def _grow(self, n: int) -> None:
        for a in (self.base, self.check, self.value):
            if len(a) < n:
                a.extend([0 if a is self.base else -1] * (max(n, 2 * len(a)) - len(a)))


def build(model: str = MODEL) -> tuple:
    """(pieces, double array, bytes of the longest piece) of a model file: made once on the driver, of the file's size."""
    pieces = load_pieces(model)
    usable = [(p.encode(), i) for i, (p, _, t) in enumerate(pieces) if t == 1 and p]
    trie = DoubleArray(usable)
    return pieces, (trie.base, trie.check, trie.value), max((len(k) for k, _ in usable), default=1)


class Encoder:
    def __init__(self, pieces: list[tuple[str, float, int]], trie=None, longest: int | None = None):
        self.pieces = pieces
        if trie is None:
            usable = [(p.encode(), i) for i, (p, _, t) in enumerate(pieces) if t == 1 and p]
            made = DoubleArray(usable)
            trie, longest = (made.base, made.check, made.value), max((len(k) for k, _ in usable), default=1)
        base, check, value = trie
        # plain lists are the fastest to read one by one; room beyond the last base for any byte
        self.base, self.check, self.value = list(base), list(check) + [-1] * 257, list(value)
        self.scores, self.longest = [s for _, s, _ in pieces], longest
        self.arrays = [np.array(x, dtype=np.int32) for x in (self.base, self.check, self.value)] + [np.array(self.scores)]
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == 6}
        self.byte_ids = np.array([self.bytes.get(b, -1) for b in range(256)], dtype=np.int32)
        byte_id = {i: b for b, i in self.bytes.items()}
        self.decoded = [bytes([byte_id[i]]) if i in byte_id else p.encode() for i, (p, _, _) in enumerate(pieces)]
        self.unknown = next((i for i, (_, _, t) in enumerate(pieces) if t == 2), 0)
        self.penalty = min((s for _, s, t in pieces if t == 1), default=0.0) - BYTE_PENALTY
        self.crosses = any(MARK in p.lstrip(MARK) for p, _, t in pieces if t == 1)
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def viterbi(self, cut: str) -> tuple[tuple[int, ...], float, int]:
        """Ids, score and byte tokens of the best path through one cut."""
        b = cut.encode()
        base, check, value, scores, n = self.base, self.check, self.value, self.scores, len(b)
        best, come, piece = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if here == -math.inf:  # inside a character
                continue
            state, j, first = 0, i, 0
            for c in b[i : i + self.longest]:
                to = base[state] + c + 1
                if check[to] != state:
                    break
                state = to
                j += 1
                v = value[to]
                if v >= 0:
                    first = first or j
                    s = here + scores[v]
                    if s > best[j]:
                        best[j], come[j], piece[j] = s, i, v
            whole = i + (1 if b[i] < 0x80 else 2 if b[i] < 0xE0 else 3 if b[i] < 0xF0 else 4)
            if first != whole and here + self.penalty > best[whole]:
                best[whole], come[whole], piece[whole] = here + self.penalty, i, -1
        ids, at, n_bytes = [], n, 0
        while at:
            i, v = come[at], piece[at]
            if v >= 0:
                ids.append(v)
            elif self.bytes:
                ids.extend(self.bytes[x] for x in reversed(b[i:at]))
                n_bytes += at - i
            else:
                ids.append(self.unknown)
            at = i
        return tuple(reversed(ids)), best[n], n_bytes

    def _paths(self, cuts: list[str]) -> list[tuple[bytes, float, int]]:
        """What viterbi() gives for each of many short cuts (ids as bytes of int32), in arrays over all their bytes."""
        base, check, value, scores = self.arrays
        coded = [c.encode() for c in cuts]
        size = np.array([len(c) for c in coded])
        # a place for each byte and one for the end of each cut
        end = (np.cumsum(size + 1) - 1).astype(np.int32)
        text = np.frombuffer(b"\0".join(coded) + b"\0", dtype=np.uint8).astype(np.int32)
        last = np.repeat(end, size + 1)
        begins = (text & 0xC0) != 0x80
        begins[end] = False
        origin = np.flatnonzero(begins).astype(np.int32)
        width = 1 + (text[origin] >= 0xC0) + (text[origin] >= 0xE0) + (text[origin] >= 0xF0)
        # every piece that starts anywhere: all places walk the trie at once, a byte a round
        alone = np.zeros(len(text), dtype=bool)  # a piece is just the character
        starts, stops, ids = [], [], []
        at, state, depth, wide = origin, np.zeros(len(origin), dtype=np.int32), 0, width
        while len(at):
            to = base[state] + text[at + depth] + 1
            on = check[to] == state
            at, state, wide = at[on], to[on], wide[on]
            depth += 1
            hit = value[state] >= 0
            starts.append(at[hit])
            stops.append(at[hit] + depth)
            ids.append(value[state[hit]])
            alone[at[hit & (wide == depth)]] = True
            on = at + depth < last[at]
            at, state, wide = at[on], state[on], wide[on]
        lone = ~alone[origin]
        starts.append(origin[lone])
        stops.append(origin[lone] + width[lone])
        ids.append(np.full(int(lone.sum()), -1, dtype=np.int32))
        starts, stops, ids = np.concatenate(starts), np.concatenate(stops), np.concatenate(ids)
        # paths grow by the distance from the cut's start: at one distance no two pieces of a cut end at one place
        begin = end - size.astype(np.int32)
        rank = (starts - np.repeat(begin, size + 1)[starts]).astype(np.int16)  # under 4 * LONG; of such numbers sorting is linear
        order = np.argsort(rank, kind="stable")
        starts, stops, ids = starts[order], stops[order], ids[order]
        gain = np.where(ids >= 0, scores[ids], self.penalty)
        best, come, piece = np.full(len(text), -np.inf), np.zeros(len(text), dtype=np.int32), np.full(len(text), -1, dtype=np.int32)
        best[begin] = 0.0
        bounds = np.concatenate([[0], np.cumsum(np.bincount(rank))])
        for a, b in zip(bounds[:-1], bounds[1:]):
            s, stop = best[starts[a:b]] + gain[a:b], stops[a:b]
            up = s > best[stop]
            stop = stop[up]
            best[stop], come[stop], piece[stop] = s[up], starts[a:b][up], ids[a:b][up]
        # back along the paths of all cuts, a piece a round; bytes of unknown characters one by one
        token = np.full(len(text), -2, dtype=np.int32)
        at, start = end[size > 0], begin[size > 0]
        n_bytes = np.zeros(len(text), dtype=np.int32)
        while len(at):
            back, v = come[at], piece[at]
            known = v >= 0
            token[back[known]] = v[known]
            if not known.all():
                lo, hi = back[~known], at[~known]
                if self.bytes:
                    for k in range(4):
                        some = lo + k < hi
                        token[lo[some] + k] = self.byte_ids[text[lo[some] + k]]
                    n_bytes[lo] = hi - lo
                else:
                    token[lo] = self.unknown
            on = back > start
            at, start = back[on], start[on]
        used = token != -2
        flat, upto = token[used].tobytes(), np.concatenate([[0], np.cumsum(used)]) * 4
        counted = np.add.reduceat(n_bytes, begin).tolist() if len(begin) else []
        return [(flat[i:j], s, k) for i, j, s, k in zip(upto[begin].tolist(), upto[end].tolist(), best[end].tolist(), counted)]

    def clear(self) -> None:
        """Forget the kept cuts: idle workers hold memory that busy ones need."""
        self.young, self.old = {}, {}

    def encode_all(self, texts: list[str]):
        """(ids as an array, score, byte tokens) of each text."""
        at = 0
        while at < len(texts):
            to, much = at, 0
            while to < len(texts) and much < TOGETHER:
                much += len(texts[to])
                to += 1
            split = []
            for t in texts[at:to]:
                marked = MARK + t.replace(" ", MARK) if t else ""
                split.append(([marked] if marked else []) if self.crosses else _CUT.findall(marked))
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            young, old, got, missing = self.young, self.old, {}, []
            for c in set().union(*split):
                found = young.get(c)
                if found is None:
                    found = old.get(c)
                    if found is not None:
                        young[c] = found
                    elif len(c) < LONG:
                        missing.append(c)
                    else:
                        ids, score, n = self.viterbi(c)
                        found = (np.array(ids, dtype=np.int32).tobytes(), score, n)
                got[c] = found
            if missing:
                made = dict(zip(missing, self._paths(missing)))
                got.update(made)
                if len(young) < CACHE:
                    young.update(made)
            for cuts in split:
                ids, score, n_bytes = zip(*map(got.__getitem__, cuts)) if cuts else ((), (), ())
                yield np.frombuffer(b"".join(ids), dtype=np.int32), sum(score, 0.0), sum(n_bytes)
            at = to

    def encode(self, text: str) -> tuple[list[int], float, int]:
        ids, score, n_bytes = next(self.encode_all([text]))
        return ids.tolist(), score, n_bytes

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces and bytes joined, markers back to spaces, the leading one dropped."""
        text = b"".join(map(self.decoded.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def encode(df: DataFrame, model: str = MODEL, column: str = "text") -> DataFrame:
    """df with ids, n_tokens, n_byte_tokens, token_score and round_trip (decoding gives the text back).

    A text that itself holds the marker character decodes to spaces there; its round_trip is false.
    """
    new = [("ids", "array<int>"), ("n_tokens", "bigint"), ("n_byte_tokens", "bigint"), ("token_score", "double"), ("round_trip", "boolean")]
    df, schema = widened(df, new)
    pieces = df.sparkSession.sparkContext.broadcast(build(model))  # fixed size: the model file and its trie

    def run(batches):
        e = held(("pieces", model), lambda: Encoder(*pieces.value))
        try:
            for b in batches:
                cols: dict[str, list] = {c: [] for c, _ in new}
                texts = [t for t in b[column] if t is not None]
                made = e.encode_all(texts)
                for t in b[column]:
                    ids, score, n_bytes = next(made) if t is not None else (None, 0.0, 0)
                    # numbers in place of objects: a batch of ids stays as small as its texts
                    for c, v in zip(cols, (ids, 0 if ids is None else len(ids), n_bytes, score, ids is None or e.decode(ids.tolist()) == t)):
                        cols[c].append(v)
                for (c, _), kind in zip(new, (object, "int64", "int64", float, bool)):
                    b[c] = pd.Series(cols[c], index=b.index, dtype=kind)
                yield b
        finally:
            e.clear()

    return df.mapInPandas(frugal(run), schema)


def decode(df: DataFrame, model: str = MODEL, column: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the text of its ids (null for null)."""
    df, schema = widened(df, [(out, "string")])
    pieces = df.sparkSession.sparkContext.broadcast(load_pieces(model))

    def run(batches):
        e = held(("pieces", model), lambda: Encoder(*pieces.value))
        for b in batches:
            b[out] = pd.Series([None if i is None else e.decode(list(i)) for i in b[column]], index=b.index, dtype=object)
            yield b

    return df.mapInPandas(frugal(run), schema)


def op4_sentencepiece(spark, sf_dir):
    d = encode(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_tokens", "n_byte_tokens", F.round("token_score", 6).alias("token_score"), "round_trip", "ids")
