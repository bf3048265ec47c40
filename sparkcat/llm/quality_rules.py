"""Quality rules: counts per document and a hashed n-gram log-likelihood ratio, all in built-in functions.

Base rules fail a document with fewer than 50 words, or with more than half of its words inside repeated 3-word windows.
The verdict on the rest: words and word pairs are hashed into BUCKETS features; two multinomials (add-one) are counted
over them, one of trusted documents (labelled quality 1) and one of the whole raw corpus. A document's score is the mean
log ratio of its features. It is kept if its score reaches a threshold, fixed per model: the lowest LOW quantile of the
trusted documents' scores, each by a model from whose trusted count the document's own fold (one of FOLDS, by a hash of
doc_id) is left out. Only those that pass the base rules are taken.
Word and pair counts of the raw corpus cover every document.

All trusted documents count, and all their scores stand behind the threshold. Their ids grow with the input, so they are
never broadcast: at any size the documents that pass a Bloom filter of them are shuffled once, not as texts but as two bytes
a feature, and those of trusted documents are kept in a table until the model is made. The model is one array of BUCKETS
numbers; the threshold is found by counting scores in CLASSES ranges, then in ranges of the one it is in, so that no more
than that many rows reach the driver.

Null, empty and blank texts have no words and fail; very long ones are counted whole. Repeated rows are judged alike, each
by itself; a null doc_id has no label. A score equal to the threshold is kept. An empty table gives an empty result. With
no trusted documents the ratio is 0 and the base rules alone decide. Extra columns pass through untouched; the operator's own
columns replace columns of the same names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP_SQL, forget, runtime_bloom, stored

BUCKETS, LOW, FOLDS, CLASSES = 16384, 0.002, 5, 1000
SYMBOLS = "#*$%&|<>"
HAS_WORD = "[^\\x20\\x09-\\x0D]"


def hashed(docs: DataFrame) -> DataFrame:
    """Add _h, the hashes of the words, and _two, those of pairs of neighbours. Each is a column of its own, so that no
    later lambda computes it anew for every element."""
    text = F.trim(F.coalesce(F.col("text"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, GAP_SQL))
    out = docs.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    return out.withColumn("_two", _joined("_h", "_h", 1))


def _joined(left: str, right: str, skip: int) -> Column:
    """Hashes of each element of left with the element of right that lies `skip` further, as far as both have one."""
    n = F.greatest(F.size(right) - skip, F.lit(0))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(skip + 1), n), lambda a, b: F.xxhash64(a, b))


def counts(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed to hashed() documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(HAS_WORD))
    near = lambda i, d: F.get(F.col("_sorted"), i + d)["h"]
    same = lambda x, i, d: F.coalesce(x["h"] == near(i, d), F.lit(False))
    twice = F.filter("_sorted", lambda x, i: same(x, i, -1) | same(x, i, 1))
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)))))
    out = docs.withColumn("_three", _joined("_two", "_h", 2))
    # Sorted only where some window occurs twice.
    some = F.size(F.array_distinct("_three")) < F.size("_three")
    out = out.withColumn("_sorted", F.when(some, F.sort_array(F.transform("_three", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    out = out.withColumns({
        "n_words": F.size("_h").cast("long"),
        "word_chars": F.char_length(F.regexp_replace(text, GAP_SQL, "")).cast("long"),
        "n_symbols": (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.when(F.col("_sorted").isNotNull(), covered).otherwise(0).cast("long"),
    })
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_sorted", "_three")


def model(docs: DataFrame, labels: DataFrame) -> tuple[str, float]:
    """The log ratios of all buckets as text (one number each, a bounded size), and the threshold."""
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    ids = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    ids = stored(ids.withColumn("_fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")), "quality-ids")
    small = lambda c: F.transform(c, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("short")).alias(c)
    with runtime_bloom(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        trusted = counts(hashed(docs)).select("doc_id", "base_failed", small("_h"), small("_two")).join(ids.where("_fold >= 0"), "doc_id")
        trusted = stored(trusted, "quality-trusted")
    grams = lambda d, *by: d.select(*by, F.explode(F.concat("_h", "_two")).alias("h")).groupBy(*by, F.pmod("h", F.lit(BUCKETS)).cast("int").alias("b")).count().collect()
    raw, good = [1.0] * BUCKETS, [[0.0] * BUCKETS for _ in range(FOLDS)]
    for r in grams(hashed(docs)):  # BUCKETS rows at most, and FOLDS times as many
        raw[r["b"]] += r["count"]
    for r in grams(trusted, "_fold"):
        good[r["_fold"]][r["b"]] = r["count"]
    every = [1.0 + sum(x) for x in zip(*good, strict=True)]
    if sum(every) == BUCKETS:
        forget(spark, ids, trusted)
        return ",".join(["0"] * BUCKETS), float("-inf")
    without = [_ratios([x - y for x, y in zip(every, g, strict=True)], raw) for g in good]
    past = F.when(~F.col("base_failed") & (F.col("_fixed") >= 0), F.col("score"))
    scores = scored(trusted, *without).groupBy("doc_id").agg(F.min(past).alias("q")).where("q is not null")
    scores = stored(scores.select("q"), "quality-scores")
    low = lowest(scores, LOW)
    forget(spark, ids, trusted, scores)
    return _ratios(every, raw), low if low is not None else float("-inf")


def lowest(values: DataFrame, share: float) -> float | None:
    """The value of q at place int(share * rows) of the rows in order, from 0: the same in every run. None without rows."""
    low, high, n = values.agg(F.min("q"), F.max("q"), F.count("q")).first()
    at = int(share * n)
    while n and low < high:
        # Places in the range never fall as q grows, and its ends lie in different classes: each round's range is narrower.
        place = F.floor((F.col("q") - low) / F.lit(high - low) * CLASSES).alias("k")
        classes = values.where(F.col("q").between(low, high)).groupBy(place).agg(F.count("q").alias("n"), F.min("q").alias("low"), F.max("q").alias("high"))
        for r in sorted(classes.collect(), key=lambda r: r["k"]):  # CLASSES + 1 rows at most
            if at < r["n"]:
                low, high = r["low"], r["high"]
                break
            at -= r["n"]
    return low


def _ratios(good: list[float], raw: list[float]) -> str:
    a, b = math.log(sum(good)), math.log(sum(raw))
    return ",".join(f"{math.log(g) - a - math.log(r) + b:.5f}" for g, r in zip(good, raw, strict=True))


def scored(docs: DataFrame, *ratios: str) -> DataFrame:
    """Add score, the mean log ratio over words and pairs, to hashed() documents; of several models by that of _fold."""
    tables = [F.split(F.lit(r), ",").cast("array<double>") for r in ratios]  # folded to one literal array
    table = tables[0] if len(tables) == 1 else F.get(F.array(*tables), F.col("_fold"))
    add = lambda acc, h: acc + F.get(table, F.pmod(h, F.lit(BUCKETS)).cast("int"))
    total = F.aggregate("_h", F.lit(0.0), add) + F.aggregate("_two", F.lit(0.0), add)
    # A row number beside the score keeps a filter on the verdict above this step: pushed below, it would repeat the
    # array expressions inside each other's lambdas.
    return docs.withColumns({"score": total / F.greatest(F.size("_h") + F.size("_two"), F.lit(1)), "_fixed": F.monotonically_increasing_id()})


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with the counts, base_failed, score and kept."""
    ratios, threshold = model(docs.select("doc_id", "text"), labels)
    out = scored(counts(hashed(docs)), ratios)
    kept = ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)) & (F.col("_fixed") >= 0)
    return out.withColumn("kept", kept).drop("_h", "_two", "_fixed")
