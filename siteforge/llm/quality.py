"""Line-first quality rules (DataFrame and SQL functions only).

Every line with a word is judged alone:

- boilerplate: a stock phrase;
- navigation: separators such as | between short parts, or 6 to 40 words of which at most half differ (menus, repeated labels);
- punctuation: fewer than 10 words without an end mark (headings, buttons), or 20 or more characters of which over a tenth are
  symbols or over three tenths are neither letters, digits nor blanks (rulers, dotted lines).

Failing lines are removed; a document that loses more than half of its words that way is rejected. Documents also fail by base rules
on the whole text.

Nulls: a null text is treated as empty: no words, so base_failed. Repeated rows each get their row, there are no ties, an empty table
gives an empty result, columns of the operator's names are replaced, and a very long text is worked on as a whole within its row.
5-word windows are compared by two levels of 64-bit hashes within one document. All work is within the row: no exchange at all.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteforge.llm.common import let, read, words

MIN_WORDS, MAX_REPEAT_PERCENT, MAX_LOST = 10, 20, 0.5
SYMBOLS = "[#*$%&|<>]"
_WS = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = "[|»›·>]"
#: What ends a sentence, with closing marks after it.
END_MARK = r"[.!?:;,\x22\x27)\]…»”’。！？][\x20\x09-\x0D]*\z"
NOT_TEXT = r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D]"
#: Stock phrases of boilerplate lines, matched without regard to case.
BOILERPLATE = [
    "all rights reserved",
    "licensed under the",
    "terms of service",
    "terms of use",
    "privacy policy",
    "cookie policy",
    "we use cookies",
    "enable javascript",
    "subscribe to our newsletter",
    "click here to",
    "lorem ipsum",
]


def repeated_words(hashes: Column) -> Column:
    """Words inside 5-word windows found twice or more, from the array of the words' hashes."""

    def covered(w: Column) -> Column:
        # windows as (hash, position) in hash order: equal ones are neighbours
        sorted_ = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        hits = let(sorted_, lambda s: F.transform(F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))), lambda x: x["i"]))
        at = F.sort_array(hits)
        steps = F.aggregate(at, F.struct(F.lit(-5).alias("p"), F.lit(0).alias("n")), lambda a, p: F.struct(p.alias("p"), (a["n"] + F.least(F.lit(5), p - a["p"])).alias("n")))
        return steps["n"].cast("bigint")  # each start covers what lies beyond the one before

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - 5), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2), F.get(h, i + 3), F.get(h, i + 4)))

    dup = lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(covered(w))
    return F.when(F.size(hashes) < 6, F.lit(0).cast("bigint")).otherwise(let(hashes, lambda h: let(windows(h), dup)))


def bad_line(line: Column) -> Column:
    low = F.lower(line)
    stock = F.lit(False)
    for p in BOILERPLATE:
        stock = stock | low.contains(p)
    length = F.length(line)
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    n = count(_WORD)
    # the words of a line are looked at where it is short only
    few = n.between(6, 40) & (F.size(F.array_distinct(words(line))) * 2 <= n)
    navigation = (line.rlike(SEPARATORS) & (count(SEPARATORS) * 4 >= count(_WS + "+") + 1)) | few
    punctuation = ((n < 10) & ~line.rlike(END_MARK)) | ((length >= 20) & ((count(SYMBOLS) * 10 > length) | (count(NOT_TEXT) * 10 > 3 * length)))
    return stock | navigation | punctuation


def clean(df: DataFrame) -> DataFrame:
    """df (doc_id, text, ...) with the base counts, clean_text, lost_words, base_failed and kept."""
    text = F.coalesce("text", F.lit(""))
    made = ["text_", "w_", "lines_", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "good_", "clean_text", "kept_words", "lost_words", "base_failed", "kept"]
    names = [c for c in df.columns if c.lower() not in made]
    d = df.select(*[f"`{c}`" for c in names], text.alias("text_"))
    hashes = F.transform(words(F.col("text_")), lambda w: F.xxhash64(w))
    lines = F.filter(F.split("text_", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.select(*[f"`{c}`" for c in names], "text_", let(hashes, lambda h: F.struct(F.size(h).cast("bigint").alias("n"), repeated_words(h).alias("r"))).alias("w_"), lines.alias("lines_"))
    good = F.filter("lines_", lambda x: ~bad_line(x))
    d = d.withColumns({"n_words": F.col("w_.n"), "n_repeat_words": F.col("w_.r"), "good_": good})
    kept_words = F.aggregate("good_", F.lit(0).cast("bigint"), lambda a, x: a + F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    counts = {
        "word_chars": (F.length("text_") - F.regexp_count("text_", F.lit(_WS))).cast("bigint"),
        "n_symbols": F.regexp_count("text_", F.lit(SYMBOLS)).cast("bigint"),
        "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("bigint"),
        "clean_text": F.array_join("good_", "\n"),
        "base_failed": failed,
        # every line good: nothing lost, and nothing to count
        "lost_words": F.when(F.size("good_") == F.size("lines_"), F.lit(0).cast("bigint")).otherwise(F.col("n_words") - kept_words),
    }
    d = d.withColumns(counts)
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("lost_words") <= MAX_LOST * F.col("n_words"))).drop("text_", "w_", "lines_", "good_")


def op3_line_quality(spark, sf_dir):
    d = clean(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words")
