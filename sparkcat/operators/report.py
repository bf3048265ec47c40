"""Reports of a run as frames: phases, outcomes, progress, events; and their text and HTML forms."""

from __future__ import annotations

import html
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def progress(log: DataFrame, status: str, seconds: Column, total: Column, *by: str, errors: int = 20) -> DataFrame:
    """done, ok, failed, skipped, percent, rate (a second), eta (seconds), and a sample of at most `errors` error texts, the
    smallest ones. log: status, message."""
    n = F.count("*")
    small = F.slice(F.sort_array(F.collect_set(F.when(F.col(status) == "failed", F.col("message")))), 1, errors)
    out = log.groupBy(*by).agg(n.alias("done"), *[F.count_if(F.col(status) == s).alias(s) for s in ("ok", "failed", "skipped")], F.max(seconds).alias("seconds"), F.max(total).alias("total"), small.alias("errors"))
    rate = F.when(F.col("seconds") > 0, F.col("done") / F.col("seconds"))
    return out.withColumns({"percent": F.round(100 * F.col("done") / F.col("total"), 2), "rate": F.round(rate, 4), "eta": F.round((F.col("total") - F.col("done")) / rate, 2)})


def budget_totals(phases: DataFrame, phase: str, spent: str, quota: str) -> DataFrame:
    """Per phase: spent, quota and what is left, never below zero."""
    out = phases.groupBy(phase).agg(F.sum(spent).alias("spent"), F.max(quota).alias("quota"))
    return out.withColumn("left", F.greatest(F.lit(0.0), F.col("quota") - F.col("spent")))


def lookup_budget(left: float, most: float, rate: float, reserve: float = 90.0, safety: float = 0.9) -> tuple[float, int]:
    """Seconds for lookups and how many fit: what is left less a reserve, at most `most`, at the rate less a safety margin."""
    seconds = max(0.0, min(most, left - reserve))
    return seconds, int(seconds * rate * safety)


def events(log: DataFrame, name: str, level: str, fields: list[str]) -> DataFrame:
    """Structured events as lines: name, level and key=value pairs (a null value is left out), and the same as JSON."""
    pair = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string")))
    return log.select(F.concat_ws(" ", F.col(name), F.concat(F.lit("level="), F.col(level)), *[pair(c) for c in fields]).alias("line"), F.to_json(F.struct(F.col(name).alias("event"), F.col(level).alias("level"), *fields)).alias("json"))


def stage_times(log: DataFrame, stage: str, at: str, mark: str) -> DataFrame:
    """Seconds from the first start to the last end of each stage; null while it has not ended."""
    out = log.groupBy(stage).agg(F.min(F.when(F.col(mark) == "start", F.col(at))).alias("began"), F.max(F.when(F.col(mark) == "end", F.col(at))).alias("ended"))
    return out.withColumn("seconds", F.col("ended") - F.col("began"))


def rule_counts(rules: DataFrame, kind: str) -> DataFrame:
    """How many rules of each kind are in force."""
    return rules.groupBy(kind).agg(F.count("*").alias("rules"), F.countDistinct("word").alias("distinct"))


def summary_text(stats: Mapping[str, object]) -> str:
    return "\n".join(f"{k}: {v}" for k, v in stats.items())


def summary_html(title: str, stats: Mapping[str, object]) -> str:
    rows = "".join(f"<tr><td>{html.escape(str(k))}</td><td>{html.escape(str(v))}</td></tr>" for k, v in stats.items())
    return f"<h3>{html.escape(title)}</h3><table>{rows}</table>"
