"""Reports and gates: priorities, bundles, attrition, coverage, freshness, paired runs."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siteforge.operators.joins import assert_unique
from siteforge.operators.sampling import hashed


def label_priorities(df: DataFrame, n: int, seed: str = "p") -> DataFrame:
    """n of the unlabelled plants (plant, state, pop, fired, labelled), small misses first, then misses, then small ones; spread over
    states within each priority. Plants of at most 100 people are out of scope, unknown ones are not small."""
    small = F.coalesce((F.col("pop") > 100) & (F.col("pop") <= 1000), F.lit(False))
    p = F.when(small & ~F.col("fired"), 1).when(~F.col("fired"), 2).when(small, 3)
    d = df.where("not labelled and (pop is null or pop > 100)").withColumn("priority", p).where("priority is not null")
    k = F.row_number().over(W.partitionBy("priority", "state").orderBy(hashed(F.col("plant"), seed), "plant"))
    return d.withColumn("k", k).orderBy("priority", "k", hashed(F.col("plant"), seed), "plant").limit(n).select("plant", "state", "priority")


def targeted_sites(truth: DataFrame, false_positives: DataFrame, done: DataFrame) -> DataFrame:
    """(plant, ll_uuid, role): true locations and false positives that are not done; a place with both roles is a true location."""
    both = truth.select("plant", "ll_uuid", F.lit("a_truth").alias("role")).unionByName(false_positives.select("plant", "ll_uuid", F.lit("b_false_positive").alias("role")))
    one = both.groupBy("plant", "ll_uuid").agg(F.substring(F.min("role"), 3, 99).alias("role"))
    return one.join(done.select("plant", "ll_uuid"), ["plant", "ll_uuid"], "left_anti")


def bundle(df: DataFrame, n_places: int, n_plants: int, seed: str = "b") -> DataFrame:
    """Plants (plant, place, correction, labelled, held) of the best places (10 a correction, 2 a label, 1 a plant): all marked ones, topped
    up with others to n_plants."""
    score = F.sum(F.col("correction").cast("int")) * 10 + F.sum(F.col("labelled").cast("int")) * 2 + F.count(F.lit(1))
    top = df.groupBy("place").agg(score.alias("score")).orderBy(F.desc("score"), "place").limit(n_places)
    pool = df.join(F.broadcast(top.select("place")), "place", "left_semi")  # a row a place
    marked = F.col("correction") | F.col("labelled") | F.col("held")
    n = pool.where(marked).count()
    rest = pool.where(~marked).orderBy(hashed(F.col("plant"), seed), "plant").limit(max(0, n_plants - n))
    return pool.where(marked).unionByName(rest)


def attrition(source: DataFrame, steps: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """source (key, class) with lost_at: the first step (name, keys that pass it) that a row does not pass, null if it passes all."""
    out = source
    for i, (_, passed) in enumerate(steps):
        out = out.join(passed.select(key).distinct().withColumn(f"ok{i}", F.lit(True)), key, "left")
    lost = F.coalesce(*[F.when(F.col(f"ok{i}").isNull(), F.lit(name)) for i, (name, _) in enumerate(steps)])
    return out.withColumn("lost_at", lost).drop(*[f"ok{i}" for i in range(len(steps))])


def gates(df: DataFrame, checks: dict[str, tuple[Column, float]]) -> DataFrame:
    """(gate, share, least, ok): the share of rows that pass each check against the least share; no rows pass nothing."""
    one = df.agg(*[F.coalesce(F.avg(c.cast("double")), F.lit(0.0)).alias(k) for k, (c, _) in checks.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("gate"), F.col(k).alias("share"), F.lit(float(least)).alias("least"), (F.col(k) >= least).alias("ok")) for k, (_, least) in checks.items()])
    return one.select(F.explode(rows).alias("g")).select("g.*")


def require(gates_: DataFrame) -> None:
    """Raise with the names of the gates that failed."""
    bad = [r.gate for r in gates_.where("not ok").orderBy("gate").collect()]  # a row a gate
    if bad:
        raise ValueError(f"gates failed: {bad}")


def report(sections: dict[str, Callable[[], DataFrame]]) -> DataFrame | None:
    """(section, line): each section's rows as JSON; one that fails gives its error and the others still run."""
    out = None
    for name, make in sections.items():
        try:
            d = make()
            part = d.select(F.lit(name).alias("section"), F.to_json(F.struct(*d.columns)).alias("line"))
            part.schema  # fails here rather than in the union
        except Exception as e:  # noqa: BLE001  a section's failure is a line of the report
            failed = (name, f"failed: {type(e).__name__}")
            spark = out.sparkSession if out is not None else None
            if spark is None:
                from pyspark.sql import SparkSession

                spark = SparkSession.getActiveSession()
            part = spark.createDataFrame([failed], "section string, line string")
        out = part if out is None else out.unionByName(part)
    return out


def paired(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Two runs side by side with suffixes _a and _b; a key that one of them lacks, or repeats, raises."""
    a, b = assert_unique(a, [key]), assert_unique(b, [key])
    if not a.join(b, key, "left_anti").isEmpty() or not b.join(a, key, "left_anti").isEmpty():
        raise ValueError("the runs do not hold the same rows")
    side = lambda d, s: d.select(key, *[F.col(c).alias(f"{c}_{s}") for c in d.columns if c != key])
    return side(a, "a").join(side(b, "b"), key)


def candidate_tables(parts: dict[str, DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """(long, wide) of points by source (key, lat, lon): a row for each point with its source, and a row for each key with every source's first point and count."""
    long = None
    for name, d in parts.items():
        p = d.select(key, F.lit(name).alias("source"), "lat", "lon")
        long = p if long is None else long.unionByName(p)
    one = F.min(F.struct("lat", "lon"))
    wide = long.groupBy(key).pivot("source", list(parts)).agg(one["lat"].alias("lat"), one["lon"].alias("lon"), F.count(F.lit(1)).alias("n"))
    return long, wide.na.fill(0, [f"{s}_n" for s in parts])
