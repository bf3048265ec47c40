"""Reason chains, gates, contract checks and lookups: all are single projections, so they fuse with the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def reason_chain(*rules: tuple[Column, Column | str]) -> Column:
    """The reason of the first rule whose condition holds, else null. Later conditions are not evaluated."""
    out = F.lit(None).cast("string")
    for hit, reason in reversed(rules):
        out = F.when(F.coalesce(hit, F.lit(False)), reason if isinstance(reason, Column) else F.lit(reason)).otherwise(out)
    return out


def first_word(text: Column, words: Sequence[str]) -> Column:
    """The first of the words (longest first) that the text contains, else null."""
    ordered = sorted(set(words), key=lambda w: (-len(w), w))
    return F.coalesce(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in ordered]) if ordered else F.lit(None).cast("string")


def split_by_reason(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and the others with their reason."""
    tagged = df.withColumn("reason", reason)
    return tagged.where("reason is null").drop("reason"), tagged.where("reason is not null")


def reason_counts(df: DataFrame, reason: Column) -> DataFrame:
    return df.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def rule_table(*lists: DataFrame) -> DataFrame:
    """Union of rule lists without repeats, longest first; rank is the order of trial."""
    from functools import reduce

    from pyspark.sql import Window

    every = reduce(DataFrame.unionByName, lists).select("word").where("trim(word) <> ''").distinct()
    return every.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(F.length("word")), "word")))


def gate(cover: Column, overview: Column, matched: Column, confidence: Column, low: int = 55) -> Column:
    """no_cover, no_overview, all_sources_miss or low_confidence, in this order; '' passes. Null confidence counts as low."""
    return F.coalesce(
        reason_chain(
            (F.coalesce(F.trim(cover), F.lit("")) == "", "no_cover"), (F.coalesce(F.trim(overview), F.lit("")) == "", "no_overview"),
            (~F.coalesce(matched, F.lit(False)), "all_sources_miss"), (F.coalesce(confidence, F.lit(low)) < low, "low_confidence"),
        ), F.lit(""))


def band(score: Column) -> Column:
    return F.when(score >= 80, "high").when(score >= 55, "medium").when(score >= 40, "low").otherwise("miss")


def messages(*checks: tuple[Column, str]) -> Column:
    """An array with the message of each check that fails."""
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(m)) for bad, m in checks]))


def map_lookup(tokens: Column, table: Mapping[str, str]) -> Column:
    """The value of the first token that the table maps; the table is a fixed rule set in the plan."""
    m = F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv])
    return F.get(F.filter(F.transform(tokens, lambda t: F.element_at(m, t)), lambda v: v.isNotNull()), 0)


def lookup_frame(spark: SparkSession, table: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame(sorted(table.items()), "key string, value string")


def surrogate_id(prefix: Column, external: Column, season: Column, title: Column, url: Column) -> Column:
    """prefix_id, with _sN for later seasons; rows without an external id get v_ and md5 of title and URL."""
    known = F.concat(prefix, F.lit("_"), external, F.when(season > 1, F.concat(F.lit("_s"), season.cast("string"))).otherwise(""))
    nothing = F.concat(F.lit("v_"), F.md5(F.concat(F.coalesce(title, F.lit("")), F.lit("|"), F.coalesce(url, F.lit("")))))
    return F.when(F.coalesce(external, F.lit("")) != "", known).otherwise(nothing)


def merge_key(category: Column, title: Column, seq: Column, year: Column | None = None) -> Column:
    """Key parts joined by '|'; a missing sequence number is 1, a missing text an empty part."""
    one = lambda c: F.when(c.isNull() | c.cast("string").isin("", "0"), "1").otherwise(c.cast("string"))
    parts = [F.coalesce(category, F.lit("")), F.coalesce(title, F.lit("")), one(seq)]
    return F.concat_ws("|", *parts, *([one(year)] if year is not None else []))
