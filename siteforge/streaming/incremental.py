"""Incremental processing: resume by done-set, late rows by newest write, windows over event time."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteforge.operators.ranking import latest
from siteforge.sources.writers import upsert


def pending(work: DataFrame, done: DataFrame, keys: list[str], ok: str | None = None) -> DataFrame:
    """Work that isn't done; with `ok`, rows whose run failed count as not done."""
    finished = done if ok is None else done.where(F.coalesce(F.col(ok), F.lit(False)))
    return work.join(finished.select(*keys).distinct(), keys, "left_anti")


def stream_parts(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def windowed(events: DataFrame, delay: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Counts and sums by event-time window and type; rows later than the watermark are left out."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return e.groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def upsert_stream(events: DataFrame, out: str, keys: list[str], order: list[str], checkpoint: str):
    """Newest row of each key, kept in versions out/v=N: a batch reads the last one and writes the next, so a rerun is safe."""

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        new = latest(batch, keys, order)
        if epoch > 0:
            new = upsert(spark.read.parquet(f"{out}/v={epoch - 1}"), new, keys)
        new.write.mode("overwrite").parquet(f"{out}/v={epoch}")

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
