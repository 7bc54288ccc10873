"""The corpus pipeline: language ID, near-duplicates, decontamination, personal data, encoding.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor kept; all but the last return documents' columns.
Rows with a null text have no letter, so the first stage rejects them. Rows are known by their id and their text's hash: a null id, or
one that several texts share, is treated like any other. Repeated rows are copies: the second stage keeps one. Ties between copies go
to the smallest id. Empty tables pass through all stages, other columns are left out, and a very long text takes memory in
proportion in one worker.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteforge.llm import contamination, langid, neardup, pieces, pii
from siteforge.llm.common import cut, possibly, read, ready

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Batches to Python workers, where the user has not set their size: executors hold them beside a heap that five stages have filled.
BATCH = "2m"


def _without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """docs (with th) less the rows whose (doc_id, th) are in removed; null equals null. Only documents that may be removed are exchanged."""
    removed = cut(removed.select("doc_id", "th").distinct())
    held = possibly(docs, removed, "th")
    right = removed.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"))
    left = held.where("_hit").join(right, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left_anti")
    return left.unionByName(held.where("not _hit"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or that no learned language fits, go; a null lang becomes the predicted one."""
    ready(spark, BATCH)
    docs = docs.select(*COLUMNS)
    texts, bound = langid.sample_and_bound(docs.where(langid.fold(3) != 1).select("doc_id", "text", "lang"))
    kept = langid.identify(docs, texts, bound).where("lang_pred <> 'und'")
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts at five-word Jaccard similarity 0.8 or more stays: the smallest doc_id."""
    docs = docs.select(*COLUMNS)
    key = F.xxhash64("text")
    hashed = docs.select("doc_id", key.alias("th"), "text")
    made = cut(neardup.sets(hashed))
    placed = made.select("doc_id", "th", "node").join(neardup.labels(made, hashed.select("th", "text")), "node")
    first = placed.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "th")).alias("f"))
    gone = placed.join(first, "label").where(~(F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("th") == F.col("f.th"))))
    left = _without(docs.withColumn("th", key), gone)
    again = cut(made.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("th"))  # the very same row again
    held = possibly(left, again, "th")
    left = held.where("_hit").dropDuplicates(["doc_id", "th"]).unionByName(held.where("not _hit"))
    return left.select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold part of a benchmark item go."""
    docs = docs.select(*COLUMNS)
    row = F.struct("doc_id", F.xxhash64("text").alias("th"))
    bad = contamination.contaminated(docs.select(row.alias("doc_id"), "text"), read(spark, sf_dir, "benchmark").select("item_id", "text"))
    return _without(docs.withColumn("th", F.xxhash64("text")), bad.select("doc_id.*")).select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans are replaced by their kinds; n_chars follows the text."""
    docs = docs.select(*COLUMNS)
    found = pii.find(docs, pii.fit(docs))
    return found.select("doc_id", F.col("masked").alias("text"), "lang", "source", F.length("masked").cast("bigint").alias("n_chars"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return pieces.encode(docs.select(*COLUMNS)).select("doc_id", "lang", "source", "n_chars", "n_tokens", "n_byte_tokens", "round_trip", "ids")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("pii", mask_personal_data),
    ("encoding", encode_pieces),
]
#: The stages parse, hash and infer beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark, BATCH)
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = cut(docs) if i < len(STAGES) - 1 else docs
    return docs
