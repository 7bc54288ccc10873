"""Materialised intermediate results: in the cluster's shared checkpoint folder, never on one machine of a cluster."""
from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the one already set, or the one that spark.checkpoint.dir names.

    With neither, a local master (one process, as in tests) gets a temporary folder that goes with the process; a cluster raises,
    as no machine's own folder is shared.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="siteforge-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the checkpoint folder: lineage is cut and survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder and read again, for loops: its size is estimated from its files.

    A checkpoint keeps the estimate of the plan it cuts. Where a loop joins its last results, the product grows to a number of millions
    of digits, which fills the driver's memory before any row does.
    """
    path = new_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the checkpoint folder that nothing has used."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path of any store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = file_system(spark, old)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{old} could not become {new}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order."""
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p))
