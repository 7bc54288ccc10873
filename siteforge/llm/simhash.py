"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 hashes of its 3-word shingles. Fingerprints link at
RADIUS = 2 or fewer differing bits. Equal fingerprints are first merged to one; every distinct fingerprint emits itself and all
its one-bit variants (half the radius), so two linked ones meet on a common variant. A variant is met by at most 65 distinct
fingerprints: within that ball each is paired with the smallest (all of a ball are within 2 bits of one another, so links give
the same components), pairs are deduplicated and verified. Components follow by label propagation with pointer jumping.

Nulls: a null or empty text has fingerprint zero and links like any other. A null doc_id is in its fingerprint's component,
whose id is the smallest non-null doc_id (null if it has none). Repeated rows each get their row. A bit set in exactly half of the
hashes is 0. An empty table gives an empty result, very long texts are hashed in blocks, and other columns are not read.
"""
from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from siteforge.llm.common import cut, read
from siteforge.operators.cluster import components

_WORD = re.compile(rb"[^ \t-\r]+")
SEED = 42


def shingles(text: str | None) -> list[bytes]:
    w = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    return [b" ".join(x) for x in zip(w, w[1:], w[2:])] if len(w) > 2 else [b" ".join(w)] if w else []


def fingerprint(text: str | None) -> int:
    """Unsigned 64 bits: a bit is 1 if set in over half of the shingles' hashes."""
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(s, SEED) for s in shingles(text)], dtype=np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the unsigned 64-bit hashes; 0 without any."""
    h = hashes.astype(">u8")
    if not len(h):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


@F.pandas_udf(LongType())
def fingerprint_udf(text: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in text], dtype=np.uint64).view(np.int64))


def linked(fps: DataFrame) -> DataFrame:
    """Edges (a, b), a < b, of distinct fingerprints (fp): a star in each ball, deduplicated and verified."""
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("bigint") for i in range(64)])
    variants = fps.select("fp", F.explode(flips).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("v"))
    balls = variants.groupBy("v").agg(F.collect_list("fp").alias("f")).where(F.size("f") > 1)  # at most 65: distinct, one bit from v
    pairs = balls.select(F.array_min("f").alias("a"), F.explode("f").alias("b")).where("a <> b")
    return pairs.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)


def classes(prints: DataFrame) -> DataFrame:
    """(fp, label, component_id) of the distinct fingerprints in prints (doc_id, fp)."""
    fps = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    comp = components(fps.select(F.col("fp").alias("node")), linked(fps.select("fp")))
    named = comp.join(fps, comp["node"] == fps["fp"]).select("fp", "label", "first")
    ids = named.groupBy("label").agg(F.min("first").alias("component_id"))
    return named.join(ids, "label").select("fp", "label", "component_id")


def near_duplicates(df: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for df (doc_id, text)."""
    prints = cut(df.select("doc_id", fingerprint_udf("text").alias("fp")))
    return prints.join(classes(prints), "fp").select("doc_id", "fp", "component_id")


def op6_simhash(spark, sf_dir):
    d = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
