"""Katz back-off language model of order 2 and its scores.

Training counts n-grams over all training documents. Good-Turing discounts (Katz: counts up to K) give the seen n-grams' share;
what a history leaves is spread over the words never seen after it in proportion to the lower order, so that every history's
probabilities sum to one over the vocabulary and one unknown word:

    P(w | v) = d(c(v,w)) c(v,w) / c(v)   if the pair was seen, else   alpha(v) P(w),
    P(w) = d(c(w)) c(w) / N              if the word was seen, else   what is left (the unknown word).

A history whose counts all lie above K would leave nothing; it is scaled to leave 1 / (c(v) + 1).

The model is stored in tables partitioned by bucket: words (their hashes and counts, packed, by falling count), offsets (the
number of a bucket's first word of each count) and pairs (history, word and count, packed). Words are numbered by falling count over
all buckets, so frequent words have small numbers and the count of a number follows from the table of count classes (at most
sqrt(2N) rows, the only table of the model that tasks get whole). Discounts are K numbers; alpha and the lower-order mass of
a history are summed up from its pairs. Any documents can be scored against the tables.

Every exchange carries packed requests and answers instead of a row for each token:

1. Tasks cut documents into chunks of about CHUNK tokens: a chunk has its own vocabulary and its tokens as numbers in it. Longer
   texts go on in the next chunk with their last token as context.
2. Each chunk asks for its words, one sorted and packed request for each bucket of hashes; a bucket adds up the training counts
   and answers with its words' places.
3. Each chunk asks for its different pairs, one request for each bucket of histories. A bucket adds up the counts and answers
   every chunk in the order of its request: pair counts, and for each history how many of its pairs have which count and the
   lower-order mass below it.
4. Chunks compute the discounts' shares, alpha and the tokens' probabilities from the answers, falling back token by token.

Asking a stored model is the same with the model's table as one more request, the only one with counts. Histories with over 1 / HOT
of all tokens (at most HOT, and the start) are spread over all buckets by the word that follows; their sums are added up in Spark.
Words are known by 64-bit hashes, rows by two of (doc_id, text). Tables that nothing needs any more are deleted.

Nulls: a null text is empty and has its end token only; ids may be null. Repeated rows get the same scores. Words of equal count are
numbered by their hashes. An empty training set gives every token the unknown word's probability, 1; an empty table gives an empty
result. Other columns are not read.
"""
from __future__ import annotations

import gc
import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.llm.common import checkpoint_dir, frugal, read, trim
from siteforge.llm.langid import fold

K = 5
CHUNK, BUCKET, HOT = 1_000_000, 2_000_000, 1024
#: Hash of the end token.
END = -2


def discounts(counts: dict[int, int], k: int = K) -> list[float]:
    """d(0..k): Katz's Good-Turing discounts from the counts of counts; 1 where they do not exist."""
    n1, top = counts.get(1, 0), (k + 1) * counts.get(k + 1, 0)
    out = [0.0]
    for c in range(1, k + 1):
        n, up = counts.get(c, 0), counts.get(c + 1, 0)
        d = 1.0
        if n and up and n1 and n1 > top:
            r = (c + 1) * up / (n * c)
            d = (r - top / n1) / (1 - top / n1)
        out.append(d if 0 < d <= 1 else 1.0)
    return out


def _discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(c < len(d), d[np.minimum(c, len(d) - 1)], 1.0) * c


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 8-byte numbers, their bytes by place so that leading zeros vanish, compressed."""
    head = np.array([len(arrays), *map(len, arrays)], dtype=np.int64).tobytes()
    planes = b"".join(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + planes)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    at, out = 8 * (n + 1), []
    for size in raw[8:at].view(np.int64).tolist():
        out.append(np.ascontiguousarray(raw[at : at + 8 * size].reshape(8, size).T).reshape(-1).view(np.int64))
        at += 8 * size
    return out


class Stored:
    """A table in the cluster's shared checkpoint folder."""

    def __init__(self, df: DataFrame, by: str | None = None):
        self.spark, self.path = df.sparkSession, f"{checkpoint_dir(df.sparkSession)}/katz-{uuid.uuid4().hex}"
        out = df.write.option("compression", "zstd")
        (out.partitionBy(by) if by else out).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete it, and let Spark delete the exchanges that nothing refers to any more."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        released(self.spark)


def released(spark) -> None:
    gc.collect()
    spark._jvm.System.gc()


def occurrences(docs: DataFrame, buckets: int, chunk: int = CHUNK) -> DataFrame:
    """Chunks of docs (u1, u2, train, text) as rows (chunk, bucket, blob).

    Bucket -1: the body (ids, lengths, whether the first token is only context, training flags, tokens as numbers in the chunk). Other
    buckets: hashes in order, training counts and numbers in the chunk of the words that fall into it.
    """

    def run(batches):
        def flush():
            seq = np.concatenate(parts)
            hashes = np.array([END if w is None else xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in vocabulary], dtype=np.int64)
            lengths, flags, cont = (np.array(x, dtype=np.int64) for x in (map_len(parts), train, context))
            weight = np.repeat(flags, lengths)
            weight[(np.cumsum(lengths) - lengths)[cont > 0]] = 0
            counts = np.bincount(seq, weights=weight, minlength=len(hashes)).astype(np.int64)
            order = np.argsort(-np.bincount(seq, minlength=len(hashes)), kind="stable")  # frequent words get small numbers
            number = np.empty(len(order), dtype=np.int64)
            number[order] = np.arange(len(order))
            rows = [(-1, pack(np.array(u1, dtype=np.int64), np.array(u2, dtype=np.int64), lengths, cont, flags, number[seq]))]
            place = (hashes.view(np.uint64) >> np.uint64(20)) % np.uint64(buckets)
            by = np.lexsort((hashes, place))
            at = _starts(place[by])
            for a, z in zip(at.tolist(), [*at[1:].tolist(), len(by)]):
                part = by[a:z]
                rows.append((int(place[part[0]]), pack(np.diff(hashes[part], prepend=0), counts[part], number[part])))
            name = (TaskContext.get().partitionId() << 32) + made
            return pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["chunk", "bucket", "blob"])

        map_len = lambda xs: [len(x) for x in xs]
        vocabulary, u1, u2, train, context, parts, held, made = {}, [], [], [], [], [], 0, 0
        for b in batches:
            for a, c, t, text in zip(*b.columns):  # one text at a time leaves the batch
                tokens = _lowered(text.as_py()).split()  # bytes: the six ASCII spaces only
                tokens.append(None)
                for at in range(0, len(tokens), chunk):
                    piece = tokens[max(0, at - 1) : at + chunk]
                    u1.append(a.as_py())
                    u2.append(c.as_py())
                    train.append(t.as_py())
                    context.append(at > 0)
                    parts.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in piece], dtype=np.int32))
                    held += len(piece)
                    if held >= chunk:
                        yield flush()
                        vocabulary, u1, u2, train, context, parts, held, made = {}, [], [], [], [], [], 0, made + 1
        if held:
            yield flush()
        trim()

    return docs.select("u1", "u2", "train", "text").mapInArrow(run, "chunk bigint, bucket bigint, blob binary")


def _lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _mixed(a: np.ndarray) -> np.ndarray:
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _count_words(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket's requests: its words (chunk null), with the sizes of its count classes, and each chunk's places in them."""
    asked = [unpack(b) for b in pdf["blob"]]
    hashes = np.concatenate([np.cumsum(a[0]) for a in asked])
    found, inverse = np.unique(hashes, return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate([a[1] for a in asked])).astype(np.int64)
    order = np.lexsort((found, -total))
    known = order[: int((total > 0).sum())]
    place = np.full(len(found), -1, dtype=np.int64)
    place[known] = np.arange(len(known))
    back, at, rows, bucket = place[inverse], 0, [], int(pdf["bucket"].iloc[0])
    for chunk, a in zip(pdf["chunk"], asked):
        if not pd.isna(chunk):
            rows.append((bucket, chunk, pack(back[at : at + len(a[0])], a[2]), None, None))
        at += len(a[0])
    by_hash = np.sort(known)
    first = _starts(total[known])
    rows.append((bucket, None, pack(np.diff(found[by_hash], prepend=0), total[by_hash], by_hash * 0), total[known][first], np.diff(first, append=len(known))))
    return pd.DataFrame(rows, columns=["bucket", "chunk", "blob", "c", "n"]).astype({"chunk": "Int64"})


def _numbers(answers: pd.DataFrame, offsets: pd.DataFrame) -> pd.DataFrame:
    """Places in a bucket become numbers: (chunk, blob) with the numbers in the chunk and in the model."""
    rows = []
    n, base = (np.asarray(offsets[c].iloc[0], dtype=np.int64) if len(offsets) else np.zeros(0, np.int64) for c in ("n", "base"))
    first = np.cumsum(n) - n
    for chunk, blob in zip(answers["chunk"], answers["blob"]):
        place, number = unpack(blob)
        at = np.searchsorted(first, place, side="right") - 1
        ids = np.where(place >= 0, np.append(base - first, 0)[at] + place, -1) if len(first) else place
        rows.append((chunk, pack(number, ids)))
    return pd.DataFrame(rows, columns=["chunk", "blob"])


class _Pairs:
    """A chunk's tokens and its different pairs of known words, ordered by bucket, history and word.

    Numbers: 0 the start, words from 1 by falling count, -1 words that training lacks.
    """

    def __init__(self, body: bytes, words: list[bytes], hot: int, buckets: int):
        self.u1, self.u2, self.lengths, cont, train, seq = unpack(body)
        size = int(seq.max()) + 1
        number = np.full(size + 1, -1, dtype=np.int64)
        for blob in words:
            local, ids = unpack(blob)
            number[local] = ids
        number[size] = 0
        before = np.empty_like(seq)
        before[1:] = seq[:-1]
        self.first = np.cumsum(self.lengths) - self.lengths
        before[self.first] = size
        before *= size + 1
        before += seq
        self.own = np.ones(len(seq), dtype=np.int64)  # context tokens count nowhere
        self.own[self.first[cont > 0]] = 0
        keys, inverse = np.unique(before, return_inverse=True)
        del before, seq
        counts = np.bincount(inverse, weights=np.repeat(train, self.lengths) * self.own, minlength=len(keys)).astype(np.int64)
        v, w = number[keys // (size + 1)], number[keys % (size + 1)]
        known = np.flatnonzero((v >= 0) & (w > 0))
        kv, kw = v[known], w[known]
        bucket = np.where(kv <= hot, _mixed(kv * 1_000_003 + kw), _mixed(kv)) % np.uint64(buckets)
        order = np.lexsort((kw, kv, bucket))
        self.v, self.w, self.bucket, self.counts = kv[order], kw[order], bucket[order].astype(np.int64), counts[known[order]]
        self.all_v, self.all_w, self.inverse, self.known = v, w, inverse, known[order]

    def ranges(self):
        """(bucket, begin, end)"""
        begin = np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1]])) if len(self.bucket) else np.zeros(0, np.int64)
        return zip(self.bucket[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(self.bucket)])


def _starts(a: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)


def _request(v: np.ndarray, w: np.ndarray, counts: np.ndarray) -> bytes:
    at = _starts(v)
    step = np.diff(w, prepend=0)
    step[at] = w[at]
    return pack(np.diff(v[at], prepend=0), np.diff(at, append=len(v)), step, counts)


def _asked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    dv, n, step, counts = unpack(blob)
    total = np.cumsum(step)
    at = np.cumsum(n) - n
    return np.repeat(np.cumsum(dv), n), total - np.repeat(total[at] - step[at], n), counts


class Lower:
    """The lower order from the classes of equal counts: tokens, vocabulary, unknown's p, and c and p of word numbers."""

    def __init__(self, classes: list[tuple[int, int]], k: int):
        """classes (count, words with it)"""
        classes = sorted(classes, reverse=True)
        self.c = np.array([c for c, _ in classes], dtype=np.int64)
        size = np.array([n for _, n in classes], dtype=np.int64)
        self.top = np.cumsum(size)  # last number of each class
        self.tokens, self.vocabulary = int((self.c * size).sum()), int(size.sum())
        n = max(1, self.tokens)
        mass = _discounted(self.c, np.array(discounts(dict(classes), k)))
        used = float((mass * size).sum())
        self.unknown = max(1 - used / n, 1 / (n + 1)) if self.tokens else 1.0
        self.p = (1 - self.unknown) / used * mass if used else mass
        self.hot = int(size[self.c * HOT > n].sum())

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and probabilities; -1 is the unknown word."""
        at = np.searchsorted(self.top, ids)
        return np.where(ids > 0, np.append(self.c, 0)[at], 0), np.where(ids > 0, np.append(self.p, 0.0)[at], self.unknown)


def _names(k: int) -> list[str]:
    """Sums of a history: pairs counted 1..k times, tokens of pairs counted oftener, and the lower-order mass of its pairs."""
    return [*[f"n{i}" for i in range(1, k + 1)], "more", "below"]


def _count_pairs(pdf: pd.DataFrame, lower: Lower, k: int) -> pd.DataFrame:
    """One bucket's requests: answers to chunks, the bucket's pairs (kind pairs) and the sums of hot histories (kind sums; v -1: counts of counts)."""
    hot, bucket = lower.hot, int(pdf["bucket"].iloc[0])
    asked = [_asked(b) for b in pdf["blob"]]
    v, w, n = (np.concatenate([a[i] for a in asked]) for i in range(3))
    order = np.lexsort((w, v))
    v, w, n = v[order], w[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1])]))
    c = np.add.reduceat(n, at)
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.repeat(c, np.diff(at, append=len(v)))
    v, w = v[at], w[at]
    hv = _starts(v)
    columns = [*[c == i for i in range(1, k + 1)], c * (c > k), lower.of(w)[1] * (c > 0)]
    sums = [np.add.reduceat(x.astype(np.float64), hv) for x in columns]
    heads, rows, begin, empty = v[hv], [], 0, [None] * (k + 2)
    for chunk, (av, _, _) in zip(pdf["chunk"], asked):
        if not pd.isna(chunk):
            cold = np.searchsorted(heads, (u := av[_starts(av)])[u > hot])
            exact = [s[cold].astype(np.int64) for s in sums[:-1]]
            rows.append(("answer", bucket, chunk, pack(back[begin : begin + len(av)], *exact, np.ascontiguousarray(sums[-1][cold]).view(np.int64)), None, *empty))
        begin += len(av)
    seen = c > 0
    if seen.any():
        rows.append(("pairs", bucket, None, _request(v[seen], w[seen], c[seen]), None, *empty))
    rows += [("sums", bucket, None, None, int(h), *[float(s[i]) for s in sums]) for i, h in enumerate(heads) if h <= hot]
    of_counts = np.bincount(np.minimum(c, k + 2), minlength=k + 3)
    rows.append(("sums", bucket, None, None, -1, *[float(x) for x in of_counts[1 : k + 2]], 0.0))
    return pd.DataFrame(rows, columns=["kind", "bucket", "chunk", "blob", "v", *_names(k)]).astype({"chunk": "Int64", "v": "Int64"})


class Katz:
    """Model of docs (u1, u2, train, text), of which those with train are learnt from.

    Tables: words (bucket, blob), offsets (bucket, n, base) and pairs (bucket, blob); lower: the order below.
    """

    def __init__(self, docs: DataFrame, k: int = K, chunk: int = CHUNK):
        spark = self.spark = docs.sparkSession
        self.k, self.chunk, self.word_buckets = k, chunk, int(spark.conf.get("spark.sql.shuffle.partitions"))
        cut = self._cut(docs)
        words = self._ask_words(cut)
        self.words = words.df.where("chunk is null").select("bucket", "blob")
        classes = words.df.where("chunk is null").select("bucket", F.explode(F.arrays_zip("c", "n")).alias("x")).select("bucket", "x.c", "x.n")
        of_c = [(r.c, r.n) for r in classes.groupBy("c").agg(F.sum("n").alias("n")).collect()]  # at most sqrt(2 N) rows
        self.lower = lower = Lower(of_c, k)
        self.tokens, self.vocabulary, self.unknown, self.hot = lower.tokens, lower.vocabulary, lower.unknown, lower.hot
        self.buckets = max(self.word_buckets, lower.tokens // BUCKET)
        # numbers: words of larger counts come first, within a count by bucket
        starts = spark.createDataFrame(list(zip(lower.c.tolist(), [1, *(lower.top[:-1] + 1).tolist()])), "c bigint, start bigint")
        before = F.sum("n").over(W.partitionBy("c").orderBy("bucket")) - F.col("n")
        based = classes.withColumn("before", before).join(starts, "c")
        sorted_ = F.sort_array(F.collect_list(F.struct((-F.col("c")).alias("m"), "n", (F.col("start") + F.col("before")).alias("base"))))  # a bucket's counts
        self.offsets = Stored(based.groupBy("bucket").agg(sorted_.alias("s")).select("bucket", F.col("s.n").alias("n"), F.col("s.base").alias("base"))).df
        chunks = self._numbered(cut, words.df)
        pairs = self._ask_pairs(chunks.df)
        self.pairs = pairs.df.where("kind = 'pairs'").select("bucket", "blob")
        # hot histories, the start and the counts of counts: at most HOT + 2 rows
        sums = pairs.df.where("kind = 'sums'").groupBy("v").agg(*[F.sum(x).alias(x) for x in _names(k)]).collect()
        total = {r.v: [r[x] for x in _names(k)] for r in sums}
        of_counts = total.pop(-1, [0.0] * (k + 2))
        self.d = np.array(discounts({i + 1: int(x) for i, x in enumerate(of_counts[: k + 1])}, k))
        self.hot_sums = np.zeros((self.hot + 1, k + 2))
        for v, x in total.items():
            self.hot_sums[v] = x
        self._own = (chunks, pairs)

    def _cut(self, docs: DataFrame) -> Stored:
        made = occurrences(docs, self.word_buckets, self.chunk)
        return Stored(made.withColumn("body", F.col("bucket") < 0), "body")

    def _ask_words(self, cut: Stored, model: DataFrame | None = None) -> Stored:
        asked = cut.df.where("not body").select("bucket", "chunk", "blob")
        if model is not None:
            asked = asked.unionByName(model.select("bucket", F.lit(None).cast("bigint").alias("chunk"), "blob"))
        return Stored(asked.groupBy("bucket").applyInPandas(_count_words, "bucket bigint, chunk bigint, blob binary, c array<bigint>, n array<bigint>"))

    def _numbered(self, cut: Stored, answers: DataFrame) -> Stored:
        """(chunk, body, words): what remains of the chunks when their words have numbers; cut is deleted."""
        places = answers.where("chunk is not null").select("bucket", "chunk", "blob")
        numbers = places.groupBy("bucket").cogroup(self.offsets.groupBy("bucket")).applyInPandas(_numbers, "chunk bigint, blob binary")
        words = numbers.groupBy("chunk").agg(F.collect_list("blob").alias("words"))  # one a bucket, a chunk's vocabulary
        body = cut.df.where("body").select("chunk", F.col("blob").alias("body"))
        out = Stored(body.join(words, "chunk"))
        cut.drop()
        return out

    def _ask_pairs(self, chunks: DataFrame, model: DataFrame | None = None) -> Stored:
        k, hot, buckets, lower = self.k, self.hot, self.buckets, self.lower

        def ask(batches):
            for b in batches:
                for chunk, body, words in zip(b["chunk"], b["body"], b["words"]):
                    p = _Pairs(body, words, hot, buckets)
                    rows = [(bucket, chunk, _request(p.v[a:z], p.w[a:z], p.counts[a:z])) for bucket, a, z in p.ranges()]
                    yield pd.DataFrame(rows, columns=["bucket", "chunk", "blob"])

        asked = chunks.mapInPandas(frugal(ask), "bucket bigint, chunk bigint, blob binary")
        if model is not None:
            asked = asked.unionByName(model.select("bucket", F.lit(None).cast("bigint").alias("chunk"), "blob"))
        schema = "kind string, bucket bigint, chunk bigint, blob binary, v bigint, " + ", ".join(f"{x} double" for x in _names(k))
        out = Stored(asked.groupBy("bucket").applyInPandas(lambda pdf: _count_pairs(pdf, lower, k), schema), "kind")
        released(self.spark)  # the requests
        return out

    def score(self, docs: DataFrame | None = None) -> DataFrame:
        """(u1, u2, n, known, base, score) of docs (u1, u2, text), summed over rows with one id; without docs, of those given to the model."""
        if docs is None:
            chunks, pairs = self._own
        else:
            cut = self._cut(docs.withColumn("train", F.lit(False)))
            chunks = self._numbered(cut, self._ask_words(cut, self.words).df)
            pairs = self._ask_pairs(chunks.df, self.pairs)
        lower, d, hot_sums, hot, buckets, zero = self.lower, self.d, self.hot_sums, self.hot, self.buckets, self.tokens + 1.0 * (self.vocabulary + 1)
        k = self.k
        replies = pairs.df.where("kind = 'answer'").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "blob")).alias("s"))  # one a bucket, a chunk's pairs
        replies = replies.select("chunk", F.col("s.bucket").alias("bucket"), F.col("s.blob").alias("blob"))

        def run(batches):
            for b in batches:
                for body, words, bucket, blobs in zip(b["body"], b["words"], b["bucket"], b["blob"]):
                    p = _Pairs(body, words, hot, buckets)
                    c = np.zeros(len(p.all_v), dtype=np.int64)
                    heads, sums = [], []
                    by_bucket = dict(zip(bucket, blobs)) if bucket is not None else {}
                    for name, a, z in p.ranges():
                        n, *rest = unpack(by_bucket[name])
                        c[p.known[a:z]] = n
                        u = p.v[a:z][_starts(p.v[a:z])]
                        heads.append(u[u > hot])
                        sums.append(np.stack([*[x.astype(np.float64) for x in rest[:-1]], rest[-1].view(np.float64)], axis=1))
                    hv = np.concatenate([np.arange(hot + 1), *heads])
                    s = np.concatenate([hot_sums, *sums])
                    order = np.argsort(hv)
                    hv, s = hv[order], s[order]
                    times = np.arange(1, k + 1)
                    total, used = s[:, :k] @ times + s[:, k], s[:, :k] @ (times * d[1:]) + s[:, k]
                    trained = total > 0
                    keep = np.minimum(used / np.maximum(total, 1), total / (total + 1))
                    share = np.where(trained, keep / np.where(trained, used, 1), 0)
                    alpha = np.where(trained, (1 - keep) / np.maximum(1 - s[:, k + 1], 1e-300), 1.0)
                    at = np.minimum(np.searchsorted(hv, p.all_v), len(hv) - 1)
                    there = hv[at] == p.all_v
                    c1, p1 = lower.of(p.all_w)
                    prob = np.where(c > 0, share[at] * _discounted(c, d), np.where(there, alpha[at], 1.0) * p1)
                    add = lambda x: np.add.reduceat(x[p.inverse] * p.own, p.first)  # noqa: B023, E731
                    one = np.ones(len(c), dtype=np.int64)
                    yield pd.DataFrame({"u1": p.u1, "u2": p.u2, "n": add(one), "known": add((c1 > 0).astype(np.int64)), "base": add(np.log10((c1 + 1.0) / zero)), "score": add(np.log10(prob))})

        rows = chunks.df.join(replies, "chunk", "left").mapInPandas(frugal(run), "u1 bigint, u2 bigint, n bigint, known bigint, base double, score double")
        return rows.groupBy("u1", "u2").agg(*[F.sum(x).alias(x) for x in ("n", "known", "base", "score")])


def keyed(df: DataFrame) -> DataFrame:
    """df (doc_id, text, ...) with u1 and u2, by which rows are known."""
    return df.withColumns({"u1": F.xxhash64("doc_id", "text"), "u2": F.xxhash64(F.lit(1), "text", "doc_id")})


def op5_language_model(spark, sf_dir):
    d = keyed(read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (fold(7) == 2).alias("held_out")))
    model = Katz(d.withColumn("train", ~F.col("held_out")))
    copies = d.groupBy("u1", "u2").agg(F.count(F.lit(1)).alias("m"), F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"))
    out = copies.join(model.score(), ["u1", "u2"]).select(
        "doc_id", "held_out", (F.col("n") / F.col("m")).cast("bigint").alias("n_tokens"), (F.col("known") / F.col("m")).cast("bigint").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), (F.col("base") / F.col("m")).alias("base_score"), (F.col("score") / F.col("m")).alias("score"), F.explode(F.array_repeat(F.lit(0), F.col("m").cast("int"))).alias("copy"),
    )
    return out.drop("copy")
