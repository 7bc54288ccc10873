"""Text and versioned sources: explicit schemas, id columns as text, newest layers."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siteforge.functions import geo
from siteforge.operators.ranking import latest
from siteforge.storage import children


def csv_text(spark: SparkSession, path: str, schema: StructType | str, encoding: str = "ISO-8859-1") -> DataFrame:
    """CSV with a header and a given schema: nothing is inferred, so ids keep their leading zeros."""
    return spark.read.schema(schema).option("header", True).option("encoding", encoding).csv(path)


def csv_strings(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Every column as text, blanks as ''."""
    df = spark.read.option("header", True).option("encoding", encoding).option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def csv_renamed(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The file's header is dropped for the given names."""
    return spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path).toDF(*names)


def newer_than(spark: SparkSession, path: str, moment: str) -> DataFrame:
    """Parquet rows of files modified after a moment (a deployed model's), with the file's time as mtime."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    return df.withColumn("mtime", F.col("_metadata.file_modification_time")).where(F.col("mtime") > F.lit(moment).cast("timestamp"))


def hive_partition(spark: SparkSession, path: str, state: str) -> DataFrame:
    """One partition of a store laid out as state=XX; the filter prunes directories."""
    return spark.read.parquet(path).where(F.col("state") == state)


def csv_decoded(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV in UTF-8 if the whole file decodes, else in latin1."""
    broken = spark.read.text(path).where(~F.is_valid_utf8("value"))
    return csv_text(spark, path, schema, "UTF-8" if broken.isEmpty() else "ISO-8859-1")


def parts_in_order(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Part files of any columns as one table; of rows with equal keys the one of the newest file stays, ties to the later name. Dictionary
    types come as text."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    return latest(df.withColumns({"_m": F.col("_metadata.file_modification_time"), "_f": F.col("_metadata.file_name")}), keys, ["_m", "_f"]).drop("_m", "_f")


def by_priority(roots: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of several roots; of equal keys the later root's wins."""
    out = None
    for i, d in enumerate(roots):
        d = d.withColumn("_p", F.lit(i))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return latest(out, keys, ["_p"]).drop("_p")


def footer(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Row count (from the files' footers alone) and column names of a parquet table."""
    df = spark.read.parquet(path)
    return df.select().count(), df.columns


def partitions(spark: SparkSession, path: str, by: str = "state") -> list[str]:
    """Values of the partitions that a store holds, from the folders' names."""
    return [n[len(by) + 1 :] for n in children(spark, path) if n.startswith(f"{by}=")]


def partition_of(spark: SparkSession, path: str, **values) -> DataFrame:
    """The rows of given partition values; the filters prune folders."""
    df = spark.read.parquet(path)
    for k, v in values.items():
        df = df.where(F.col(k) == v)
    return df


def box_labels(spark: SparkSession, path: str) -> DataFrame:
    """(file, class, x, y, w, h) of text label files: a class number and four shares a line; other lines are left out."""
    v = F.split(F.trim("value"), r"\s+")
    d = spark.read.text(path).withColumn("file", F.regexp_extract(F.input_file_name(), r"([^/]+)\.txt$", 1)).where(F.size(v) >= 5)
    num = lambda i: F.element_at(v, i).try_cast("double")
    return d.select("file", F.element_at(v, 1).try_cast("int").alias("class"), *[num(i).alias(c) for i, c in ((2, "x"), (3, "y"), (4, "w"), (5, "h"))]).where("class is not null and h is not null")


def query_table(spark: SparkSession, url: str, query: str, driver: str | None = None) -> DataFrame:
    """A database's query result through JDBC: the database runs the filters and subqueries."""
    read = spark.read.format("jdbc").option("url", url).option("query", query)
    return (read.option("driver", driver) if driver else read).load()


def state_query(spark: SparkSession, connection, query: str, schema: str) -> DataFrame:
    """The rows of a query over a small state database (DB-API, such as sqlite3: a review's verdicts, bounded by its reviewers), read on the driver."""
    rows, cursor = [], connection.execute(query)
    while part := cursor.fetchmany(10_000):
        rows += part
    return spark.createDataFrame(rows, schema)


def vector_layer(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """A layer (a folder of parquet with the geometry as well-known binary) by name, with the largest ring of each shape."""
    from siteforge.sources.shapes import wkb_rings

    df = spark.read.parquet(f"{path}/{layer}").withColumn("rings_", wkb_rings("wkb_geometry"))
    area = F.transform("rings_", lambda r: F.struct(geo.ring_area(r).alias("a"), r.alias("r")))
    return df.withColumn("ring", F.array_max(area)["r"]).drop("rings_")


def newest_with(layers: dict[str, list[str]], required: list[str]) -> str | None:
    """The newest dated layer (name: columns) that has all required columns."""
    return newest_layer([n for n, cols in layers.items() if set(required) <= set(cols)])


def newest_layer(names: list[str]) -> str | None:
    """Newest dated layer name: YYYYMMDD or MMDDYYYY, then the _vN tail; None if no name has a date."""
    best = None
    for name in names:
        m = re.search(r"(?<!\d)(\d{8})(?!\d)", name)
        if m:
            d = m[1]
            day = d if d.startswith(("19", "20")) and 1 <= int(d[4:6]) <= 12 and 1 <= int(d[6:]) <= 31 else d[4:] + d[:4]
            v = re.search(r"_v(\d+)$", name)
            best = max(best or ("", 0, ""), (day, int(v[1]) if v else 0, name))
    return best[2] if best else None
