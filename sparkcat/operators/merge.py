"""Merging by exact keys: representatives, unions, alignment, upserts. Order is always an argument, never arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in order. A minimum of a struct aggregates before the shuffle, unlike a window."""
    cols = [c for c in df.columns if c not in keys]
    ordered = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), ordered).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols]) if cols else best.select(*keys)


def coarse_merge(df: DataFrame, keys: Sequence[str], ident: str, rank: Sequence[Column], arrival: str, first: Sequence[str]) -> DataFrame:
    """Per key: the representative's ident (least rank, then arrival), how many siblings, and columns of the first arrival."""
    order = F.struct(*rank, F.col(arrival))
    return df.groupBy(*keys).agg(
        F.min_by(ident, order).alias("representative"), (F.count("*") - 1).alias("n_siblings"),
        *[F.min_by(c, F.struct(arrival)).alias(f"first_{c}") for c in first],
    )


def first_non_missing(cols: Sequence[str], order: str, missing: dict[str, Column] | None = None) -> list[Column]:
    """Aggregates: each column's first value in order that is not missing (null or '' or 0 by its type)."""
    out = []
    for c in cols:
        there = (missing or {}).get(c, F.col(c).isNotNull())
        out.append(F.min_by(F.when(there, F.col(c)), F.when(there, F.col(order))).alias(c))
    return out


def upsert(state: DataFrame, batch: DataFrame, key: str, payload: Sequence[str], scraped: str = "scraped", hot: Column | None = None) -> DataFrame:
    """Merge a batch into keyed state. branch: insert (new key), refresh (not yet processed), requeue (processed, hot:
    back to pending), touch (processed, cold: only times), keep (not in the batch)."""
    s, b = state.withColumn("_in_state", F.lit(True)).alias("s"), batch.alias("b")
    joined = s.join(b, key, "full_outer")
    s_has, b_has = F.col("s._in_state").isNotNull(), F.col("b._in_batch").isNotNull()
    hot = F.coalesce(hot if hot is not None else F.lit(False), F.lit(False))
    branch = (
        F.when(~s_has, "insert").when(~b_has, "keep").when(F.coalesce(F.col(f"s.{scraped}"), F.lit(0)) == 0, "refresh").when(hot, "requeue").otherwise("touch")
    )
    take = branch.isin("insert", "refresh", "requeue")
    merged = [F.when(take, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in payload]
    state_col = F.when(branch.isin("insert", "requeue"), 0).otherwise(F.col(f"s.{scraped}")).alias(scraped)
    return joined.select(key, branch.alias("branch"), *merged, state_col)


def priority_chain(frames: Sequence[tuple[DataFrame, str]], keys: DataFrame, key: str, value: str) -> DataFrame:
    """Per key, the value of the first source that has one, and the source's name. Sources are joined by key only."""
    from functools import reduce

    every = reduce(DataFrame.unionByName, [f.select(key, F.col(value).alias("value"), F.lit(i).alias("rank"), F.lit(n).alias("source")) for i, (f, n) in enumerate(frames)])
    best = every.where("value is not null").groupBy(key).agg(F.min_by(F.struct("value", "source"), F.struct("rank", "value")).alias("hit"))
    return keys.join(best, key, "left").select(key, F.col("hit.value").alias("value"), F.coalesce("hit.source", F.lit("miss")).alias("source"))


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows per key; Spark cuts each task's rows to k per key before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)


def zero_filled(counts: DataFrame, domain: DataFrame, key: str, n: str = "n") -> DataFrame:
    return domain.join(counts, key, "left").select(key, F.coalesce(n, F.lit(0)).alias(n))


def promotion_order(df: DataFrame, keys: Sequence[str], rank: str, arrival: str) -> DataFrame:
    """The arrival at which each row became a sibling: its own unless it once led, else that of the next leader;
    null for the row that leads at the end."""
    w = Window.partitionBy(*keys).orderBy(arrival)
    before = F.min(rank).over(w.rowsBetween(Window.unboundedPreceding, -1))
    led = df.withColumn("_led", before.isNull() | (F.col(rank) < before))
    later = F.min(F.when(F.col("_led"), F.col(arrival))).over(w.rowsBetween(1, Window.unboundedFollowing))
    return led.withColumn("event", F.when(F.col("_led"), later).otherwise(F.col(arrival))).drop("_led")


def zip_by_position(left: DataFrame, right: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The i-th row of left with the i-th of right, per key."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return left.withColumn("i", at).join(right.withColumn("i", at), [*keys, "i"])
