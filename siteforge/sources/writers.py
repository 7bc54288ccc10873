"""Sinks: appended parts, partition overwrite, validated merge, upsert, packed payloads."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteforge.operators.joins import assert_unique
from siteforge.operators.ranking import latest
from siteforge.storage import exists, remove, rename


def append_parts(df: DataFrame, path: str, by: str = "state") -> None:
    df.write.mode("append").partitionBy(by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: str = "state") -> None:
    """Only the partitions that df holds are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def merge_shards(shards: dict[str, list[DataFrame]], keys: dict[str, list[str]], out: str, expected: int, newer_than: dict[str, tuple] | None = None) -> None:
    """All tables are checked (number of shards, unique keys, no shard older than what it is made from) and written beside the old ones
    before any old one is replaced: a failure leaves all old ones in place.

    newer_than: for a table, (oldest time of its shards, newest time of their sources).
    """
    merged = {}
    for name, parts in shards.items():
        if len(parts) != expected:
            raise ValueError(f"{name}: {len(parts)} of {expected} shards")
        made, source = (newer_than or {}).get(name, (None, None))
        if made is not None and source is not None and made < source:
            raise ValueError(f"{name}: a shard is older than its source")
        df = parts[0]
        for p in parts[1:]:
            df = df.unionByName(p, allowMissingColumns=True)
        merged[name] = assert_unique(df, keys[name])
    spark = next(iter(merged.values())).sparkSession
    for name, df in merged.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}.new")
    for name in merged:
        swap(spark, f"{out}/{name}.new", f"{out}/{name}")


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished table in the place of another: two renames, and the old one goes last."""
    old = f"{path}.old"
    remove(spark, old)
    if exists(spark, path):
        rename(spark, path, old)
    rename(spark, new, path)
    remove(spark, old)


def replace_table(df: DataFrame, path: str, rows: int) -> None:
    """Replace a table as a whole once what was written holds the expected number of rows; else the old one stays and it raises."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}.new")
    n = spark.read.parquet(f"{path}.new").count()
    if n != rows:
        remove(spark, f"{path}.new")
        raise ValueError(f"{n} rows written, {rows} expected")
    swap(spark, f"{path}.new", path)


def schema_sidecar(df: DataFrame) -> str:
    """Lines that type every column as text of its width (longest value and 20, 10 to 255), so that readers don't guess."""
    widths = df.agg(*[F.coalesce(F.max(F.length(F.col(c).cast("string"))), F.lit(0)).alias(c) for c in df.columns]).first()  # one row
    lines = ["ColNameHeader=True", "Format=CSVDelimited", "CharacterSet=65001"]
    return "\r\n".join(lines + [f"Col{i}={c} Text Width {min(255, max(10, widths[c] + 20))}" for i, c in enumerate(df.columns, 1)])


def csv_table(df: DataFrame, path: str) -> None:
    """CSV with a header, nulls as empty fields."""
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def payload(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """One row (json): the columns' names once and the rows as arrays of text, in order; for tables a page shows (bounded by its rows)."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.array(*[F.col(c).cast("string") for c in columns]).alias("r_"))))
    return df.agg(F.to_json(F.struct(F.array(*[F.lit(c) for c in columns]).alias("cols"), F.transform(rows, lambda x: x["r_"]).alias("rows"))).alias("json"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with new's rows in place of those of equal keys."""
    both = old.withColumn("_p", F.lit(0)).unionByName(new.withColumn("_p", F.lit(1)), allowMissingColumns=True)
    return latest(both, keys, ["_p"]).drop("_p")


def compact(df: DataFrame, path: str, exact: tuple[str, ...] = ("lat", "lon")) -> None:
    """zstd parquet with doubles narrowed, coordinates excepted."""
    cols = [F.col(c).cast("float").alias(c) if t == "double" and c not in exact else F.col(c) for c, t in df.dtypes]
    df.select(*cols).write.mode("overwrite").option("compression", "zstd").parquet(path)


def geojson(lon: Column, lat: Column, *properties: Column, digits: int = 6) -> Column:
    """A point feature as JSON text."""
    g = F.struct(F.lit("Point").alias("type"), F.array(F.round(lon, digits), F.round(lat, digits)).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), g.alias("geometry"), F.struct(*properties).alias("properties")))
