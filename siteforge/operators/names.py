"""Rarity-weighted name matching and exact fuzzy token joins; no cross product and no blocking that loses pairs."""
from __future__ import annotations

import math
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteforge.functions import text

CUTOFF = 88.0


def idf_table(names: DataFrame, name: str = "name") -> tuple[DataFrame, float]:
    """(tok, idf) of all names' distinctive tokens, and the weight of unknown tokens: ln((1 + N) / (1 + df)) + 1."""
    n = names.count()
    tok = names.select(F.explode(text.distinctive(F.col(name))).alias("tok")).where("tok <> ''")
    df = tok.groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    return df.select("tok", (F.log((1.0 + n) / (1 + F.col("df"))) + 1).alias("idf")), math.log(1.0 + n) + 1


def name_scores(df: DataFrame, name: str, owner: str, idf: DataFrame, default: float, ratio: float = CUTOFF) -> DataFrame:
    """df with name_match_score (0 to 1) and name_match_available.

    Of a row's name each distinctive token, and each acronym that abbreviations would write out, weighs its idf. It counts as
    much as its best Indel ratio of at least `ratio` with a token of the row's owner, or fully if it is an acronym of the owner's
    initials; the score is the weighted share. An owner token that is an acronym of the name's initials gives 1. Distinct (name, owner)
    pairs are scored once, token pairs only within them, so no key gathers more than a row's tokens.
    """
    pairs = df.select(F.col(name).alias("a_"), F.col(owner).alias("b_")).where("a_ is not null and trim(b_) <> ''").distinct()
    acronyms = lambda c: F.filter(text.raw_tokens(c), lambda t: text.acronym_like(t) & ~t.isin(*text.GENERIC))
    made = pairs.select("a_", "b_", text.norm_name(F.col("a_")).alias("na"), text.norm_name(F.col("b_")).alias("nb"))
    own = F.filter(acronyms(F.col("a_")), lambda t: ~t.isin(*text.ABBREVIATIONS))
    made = made.select(
        "a_", "b_", F.array_distinct(F.concat(F.filter(text.distinctive_of(F.col("na")), lambda t: t != ""), own)).alias("ta"),
        F.filter(F.array_distinct(F.split("nb", " ")), lambda t: t != "").alias("tb"), text.initials_of(F.col("na")).alias("ia"), text.initials_of(F.col("nb")).alias("ib"), acronyms(F.col("b_")).alias("rb"),
    )
    reverse = (F.length("ia") >= 3) & F.exists("rb", lambda t: F.col("ia").startswith(t) | F.col("ia").endswith(t))
    made = made.withColumn("reverse", reverse)
    tok = made.select("a_", "b_", "tb", "ib", F.explode("ta").alias("tok"))
    tok = tok.join(idf, "tok", "left").withColumn("w", F.coalesce("idf", F.lit(default)))
    full = F.array_contains("tb", F.col("tok")) | text.acronym_hit(F.col("tok"), F.col("ib"))
    tok = tok.withColumn("full", full)
    # only what lengths allow to reach the ratio is compared
    fuzzy = tok.where(~F.col("full")).select("a_", "b_", "tok", F.explode("tb").alias("u"))
    near = 200.0 * F.least(F.length("tok"), F.length("u")) / (F.length("tok") + F.length("u")) >= ratio
    fuzzy = fuzzy.where(near).withColumn("r", text.indel_ratio("tok", "u")).where(F.col("r") >= ratio).groupBy("a_", "b_", "tok").agg(F.max("r").alias("r"))
    got = tok.join(fuzzy, ["a_", "b_", "tok"], "left").groupBy("a_", "b_").agg((F.sum(F.col("w") * F.when(F.col("full"), 1.0).otherwise(F.coalesce(F.col("r") / 100, F.lit(0.0)))) / F.sum("w")).alias("s"))
    scored = made.select("a_", "b_", "reverse", (F.size("ta") > 0).alias("any")).join(got, ["a_", "b_"], "left")
    value = F.when(F.col("any") & F.col("reverse"), 1.0).otherwise(F.coalesce("s", F.lit(0.0)))
    scored = scored.select("a_", "b_", F.least(F.lit(1.0), value).alias("name_match_score"))
    out = df.join(scored, (df[name] == scored["a_"]) & (df[owner] == scored["b_"]), "left").drop("a_", "b_")
    there = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    available = there(name) & there(owner)
    return out.withColumn("name_match_available", available).withColumn("name_match_score", F.when(available, F.coalesce("name_match_score", F.lit(0.0))).otherwise(0.0))


def _deleted(df: DataFrame, column: str, ratio: float) -> DataFrame:
    """(column, v): every text that remains of a token when as many letters go as a partner of the ratio can lack."""
    share = ratio / 200.0

    def run(batches):
        for b in batches:
            rows = []
            for t in b[column]:
                most = int(len(t) * (1 - share / (1 - share)) + 1e-9)  # 2L / (n + m) >= ratio and L <= m bound n - L
                seen = {t}
                for k in range(1, most + 1):
                    seen.update("".join(c for i, c in enumerate(t) if i not in gone) for gone in map(set, combinations(range(len(t)), k)))
                rows += [(t, v) for v in seen]
            yield pd.DataFrame(rows, columns=[column, "v"])

    return df.select(column).mapInPandas(run, f"{column} string, v string")


def similar_tokens(left: DataFrame, right: DataFrame, ratio: float = CUTOFF) -> DataFrame:
    """(tok, u, r): all pairs of left (tok) and right (u) with an Indel ratio of at least `ratio`, exactly.

    A pair of that ratio has a common subsequence which both reach by deleting letters; distinct tokens meet on such remains and
    are verified. Tokens are single words: the remains grow with their length, not with the tables.
    """
    a, b = left.select("tok").where("tok <> ''").distinct(), right.select("u").where("u <> ''").distinct()
    met = _deleted(a, "tok", ratio).join(_deleted(b, "u", ratio), "v").select("tok", "u").distinct()
    return met.withColumn("r", text.indel_ratio("tok", "u")).where(F.col("r") >= ratio)
