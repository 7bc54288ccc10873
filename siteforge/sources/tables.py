"""Table readers: explicit paths through Spark's own readers, so that any file system works."""
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir`` (columns and filters are pushed to the scan)."""
    env = spark.sparkContext.environment  # Python workers find the package where the driver did
    if _ROOT not in env.get("PYTHONPATH", ""):
        env["PYTHONPATH"] = ":".join(filter(None, [_ROOT, env.get("PYTHONPATH", "")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
