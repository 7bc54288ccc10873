"""Helpers shared by the text operators."""
from __future__ import annotations

import ctypes
import gc
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteforge.storage import checkpoint_dir, cut  # noqa: F401

_ROOT = str(Path(__file__).resolve().parents[2])
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Word separators of every contract: space, tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
#: Bounds what a Python worker holds at once; set for the session where the user has not.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ready(spark: SparkSession, batch: str = "8m") -> None:
    """Python workers on the same file system find this package also beside its installed place, and hold small batches."""
    if spark.conf.get(BATCH_BYTES, None) is None:  # else 10,000 long texts make one batch
        spark.conf.set(BATCH_BYTES, batch)
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", ""):
        env["PYTHONPATH"] = ":".join(filter(None, [_ROOT, env.get("PYTHONPATH", "")]))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table, by Spark's reader."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def words(c: Column) -> Column:
    """Words of a text as an array; null text has none."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE), lambda w: w != "")


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, also where the body's lambdas use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


_HELD: list[tuple] = []


def held(key, make):
    """make() for the key, kept for the worker's next tasks; only the newest key is kept, as workers outlive stages."""
    if not _HELD or _HELD[0][0] != key:
        _HELD.clear()
        _HELD.append((key, make()))
    return _HELD[0][1]


def forget() -> None:
    """Drop what held() keeps."""
    _HELD.clear()


def frugal(run):
    """run (of mapInPandas) that gives its memory back to the system at the end of a task, as workers outlive stages."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return task


def trim() -> None:
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to trim
        pass


#: Bits of the bitmap that possibly() broadcasts: 4 MB at any size of the input.
BITMAP_BITS = 25


def possibly(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """df with _hit: whether its key (a 64-bit hash in both) may be among ids, by a bitmap of 2^BITMAP_BITS bits.

    It only spares the exchange of rows that are surely not among them; a full bitmap spares nothing and loses nothing.
    """
    bit = F.shiftrightunsigned(key, 64 - BITMAP_BITS)
    place = F.bitmap_bit_position(bit)
    maps = ids.select(F.bitmap_bucket_number(bit).alias("_b"), place.alias("_p")).groupBy("_b").agg(F.bitmap_construct_agg("_p").alias("_m"))
    held = df.withColumns({"_b": F.bitmap_bucket_number(bit), "_p": place}).join(F.broadcast(maps), "_b", "left")
    byte = F.conv(F.hex(F.substring("_m", F.floor(F.col("_p") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), F.col("_p") % 8)), F.lit(2)) == 1, F.lit(False))
    return held.withColumn("_hit", hit).drop("_b", "_p", "_m")


TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(), "binary": T.BinaryType(), "array<int>": T.ArrayType(T.IntegerType()), "array<bigint>": T.ArrayType(T.LongType())}


def widened(df: DataFrame, new: list[tuple[str, str]]) -> tuple[DataFrame, T.StructType]:
    """df less columns that clash with the new ones, and its schema with them."""
    ready(df.sparkSession)
    taken = {c for c, _ in new}
    df = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])
    return df, T.StructType([*df.schema.fields, *[T.StructField(c, TYPES[t]) for c, t in new]])
