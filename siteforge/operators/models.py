"""Feature preprocessing, forests and folds with Spark ML."""
from __future__ import annotations

import random

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteforge.functions.text import hash_fraction
from siteforge.operators import metrics
from siteforge.operators.metrics import running


def train(df: DataFrame, categories: list[str], numbers: list[str], label: str, trees: int = 100, seed: int = 7, depth: int = 5, leaf: int = 1):
    """Unknown categories kept as their own, medians for missing numbers, classes weighted inversely to their size."""
    sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}  # a row a class
    total = sum(sizes.values())
    weight = F.lit(1.0)
    for v, n in sizes.items():
        weight = F.when(F.col(label) == v, total / (len(sizes) * n)).otherwise(weight)
    d = df.na.fill("unknown", categories).withColumn("weight", weight)
    for c in numbers:
        d = d.withColumn(c, F.col(c).cast("double"))
    stages = [
        StringIndexer(inputCols=categories, outputCols=[f"{c}_i" for c in categories], handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=[f"{c}_i" for c in categories], outputCols=[f"{c}_v" for c in categories], handleInvalid="keep"),
        Imputer(inputCols=numbers, outputCols=[f"{c}_f" for c in numbers], strategy="median"),
        VectorAssembler(inputCols=[f"{c}_v" for c in categories] + [f"{c}_f" for c in numbers], outputCol="features"),
        RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=trees, seed=seed, maxDepth=depth, minInstancesPerNode=leaf),
    ]
    return Pipeline(stages=stages).fit(d), categories, numbers


def score(model, df: DataFrame) -> DataFrame:
    """df with score, the second class's probability; columns that the model needs must be there."""
    fitted, categories, numbers = model
    missing = [c for c in [*categories, *numbers] if c not in df.columns]
    if missing:
        raise ValueError(f"columns are absent: {missing}")
    d = df.na.fill("unknown", categories)
    for c in numbers:
        d = d.withColumn(c, F.col(c).cast("double"))
    return fitted.transform(d).withColumn("score", vector_to_array("probability")[1]).select(*df.columns, "score")


def undersampled(df: DataFrame, label: str, key: str, tree: int) -> DataFrame:
    """A balanced bootstrap for one tree: from each class as many draws, with replacement by Poisson(1)-like hashes, as the smallest has rows."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("size_"))
    least = sizes.agg(F.min("size_").alias("least_"))
    u = hash_fraction(F.concat_ws(":", F.lit(f"tree{tree}"), F.col(key).cast("string")))
    # the Poisson law's steps at the class's own rate: how often a row is drawn
    rate = F.col("least_") / F.col("size_")
    draws, term, total = F.lit(0), F.exp(-rate), F.exp(-rate)
    for i in range(1, 6):
        draws = draws + (u >= total).cast("int")
        term = term * rate / i
        total = total + term
    d = df.join(F.broadcast(sizes), label).join(F.broadcast(least)).withColumn("draws_", draws)  # a row a class, one row
    return d.where("draws_ > 0").withColumn("draw_", F.explode(F.sequence(F.lit(1), F.col("draws_")))).drop("size_", "least_", "draws_", "draw_")


def train_balanced(df: DataFrame, categories: list[str], numbers: list[str], label: str, key: str, trees: int = 10, seed: int = 7) -> list:
    """A forest of which every tree sees its own balanced bootstrap."""
    return [train(undersampled(df, label, key, t), categories, numbers, label, trees=1, seed=seed + t) for t in range(trees)]


def score_balanced(models: list, df: DataFrame) -> DataFrame:
    """df with score: the mean of the trees'."""
    total = None
    out = df
    for i, m in enumerate(models):
        out = score(m, out).withColumnRenamed("score", f"s{i}_")
        total = F.col(f"s{i}_") if total is None else total + F.col(f"s{i}_")
    return out.withColumn("score", total / len(models)).drop(*[f"s{i}_" for i in range(len(models))])


def auc_of(model, df: DataFrame, label: str) -> float:
    """A fitted model's AUC on df."""
    return float(metrics.auc(score(model, df).select("score", F.col(label).cast("int").alias("y")), "score", "y").first().auc or 0.0)


def search(df: DataFrame, categories: list[str], numbers: list[str], label: str, fold: str, tries: int = 4, seed: int = 7) -> tuple[dict, list[tuple[dict, float]]]:
    """(best, all): forest settings drawn at random and their mean AUC over the given folds."""
    rng = random.Random(seed)
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())  # a row a fold
    done = []
    for _ in range(tries):
        how = {"trees": rng.choice([5, 10, 20]), "depth": rng.choice([3, 5, 8]), "leaf": rng.choice([1, 5, 10])}
        got = [auc_of(train(df.where(F.col(fold) != f), categories, numbers, label, seed=seed, **how), df.where(F.col(fold) == f), label) for f in folds]
        done.append((how, sum(got) / len(got)))
    return max(done, key=lambda x: x[1])[0], done


def permutation_importance(model, df: DataFrame, label: str, key: str) -> DataFrame:
    """(feature, drop): by how much the AUC falls when a feature's values are dealt to other rows (in the order of a hash)."""
    _, categories, numbers = model
    base = auc_of(model, df, label)
    rows = []
    for c in [*categories, *numbers]:
        ordered = running(df.withColumn("h_", F.sha1(F.concat_ws(":", F.lit(c), F.col(key).cast("string")).cast("binary"))), [F.col("h_"), F.col(key)], {"i_": F.lit(1)})
        given = running(df.select(F.col(key).alias("k_"), F.col(c).alias("v_")), [F.col("k_")], {"i_": F.lit(1)}).select("i_", "v_")
        rows.append((c, base - auc_of(model, ordered.drop("h_").join(given, "i_").withColumn(c, F.col("v_")).drop("i_", "v_"), label)))
    return df.sparkSession.createDataFrame(rows, "feature string, drop double")


def thresholds(df: DataFrame, score_: str, label: str, target: float) -> DataFrame:
    """(youden, plant, accept): the score of the best Youden index, the lowest score from which on all precisions reach the target, and the higher of the two."""
    r = metrics.roc(df, score_, label)
    youden = r.agg(F.max(F.struct("j", F.col(score_).alias("s")))["s"].alias("youden"))
    t = metrics.accept_table(df, score_, label)
    last = t.agg(F.max(F.when(F.col("precision") < target, F.col(score_))).alias("bad"))
    plant = t.join(F.broadcast(last)).where("bad is null or " + f"{score_} > bad").agg(F.min(score_).alias("plant"))
    return youden.join(F.broadcast(plant)).withColumn("accept", F.greatest("youden", "plant"))


def leaks(df: DataFrame, features: list[str], label: str, least: float = 0.995) -> DataFrame:
    """(feature, auc, leak, empty): features that alone tell the label, either way round, and those without a value."""
    out = None
    for c in features:
        d = df.where(F.col(c).isNotNull())
        a = metrics.auc(d.select(F.col(c).cast("double").alias("s_"), F.col(label).cast("int").alias("y_")), "s_", "y_").select(F.lit(c).alias("feature"), F.coalesce(F.greatest("auc", 1 - F.col("auc")), F.lit(0.5)).alias("auc"))
        n = d.agg((F.count(F.lit(1)) == 0).alias("empty"))
        part = a.join(F.broadcast(n)).select("feature", "auc", (F.col("auc") >= least).alias("leak"), "empty")
        out = part if out is None else out.unionByName(part)
    return out


def refuse_leaks(found: DataFrame) -> None:
    bad = [r.feature for r in found.where("leak").orderBy("feature").collect()]  # a row a feature
    if bad:
        raise ValueError(f"features tell the label: {bad}")


def dead_share(importance: DataFrame, live: DataFrame) -> DataFrame:
    """(dead, total, share): how much importance (feature, weight) lies on features that no live row (feature, n) has."""
    d = importance.join(live, "feature", "left").withColumn("gone", F.coalesce("n", F.lit(0)) == 0)
    return d.agg(F.count_if("gone").alias("dead"), F.sum("weight").alias("total"), (F.sum(F.when(F.col("gone"), F.col("weight")).otherwise(0.0)) / F.sum("weight")).alias("share"))


def group_folds(points: DataFrame, group: str, folds: int = 5, blocks: int = 30, seed: int = 7) -> DataFrame:
    """(group, fold): spatial folds of the groups' mean points, so that a group is in one fold."""
    return spatial_folds(points.groupBy(group).agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon")), group, folds, blocks, seed)


def spatial_folds(points: DataFrame, key: str, folds: int = 5, blocks: int = 30, seed: int = 7) -> DataFrame:
    """(key, fold) of points (key, lat, lon): k-means blocks, packed from the largest into the smallest fold."""
    v = VectorAssembler(inputCols=["lat", "lon"], outputCol="features").transform(points)
    block = KMeans(k=blocks, seed=seed, predictionCol="block").fit(v).transform(v).select(key, "block")
    load, fold_of = [0] * folds, {}
    for r in sorted(block.groupBy("block").count().collect(), key=lambda r: (-r["count"], r["block"])):  # a row a block
        f = load.index(min(load))
        fold_of[r["block"]] = f
        load[f] += r["count"]
    table = points.sparkSession.createDataFrame(list(fold_of.items()), "block int, fold int")
    return block.join(F.broadcast(table), "block").select(key, "fold")
