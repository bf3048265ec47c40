"""Admission control over event logs: rolling guards, runs, token buckets, budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_rate(df: DataFrame, bad: Column, ts: str, seconds: int, least: int, most: float, keys: Sequence[str] = ()) -> DataFrame:
    """Share of bad rows in the last `seconds`, and a trip once at least `least` rows show more than `most`.

    Time is cut into blocks of the window's width, and each block's rows are copied to the next, where they leave the window
    one after another: a window holds the block before, less the rows that have left, and its own block's rows so far. So
    each row is added once, however many a window holds, and a log without keys, or with a hot one, is spread over as many
    tasks as it has blocks.
    """
    width = seconds * 1_000_000
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    block = F.floor(at / width)
    rows = df.withColumns({"_at": at, "_bad": F.coalesce(bad, F.lit(False)).cast("long")})
    copy = lambda b, own: F.struct(b.alias("block"), F.lit(own).alias("own"))
    rows = rows.withColumn("_copy", F.explode(F.array(copy(block, True), copy(block + 1, False)))).withColumns({"_block": F.col("_copy.block"), "_own": F.col("_copy.own")}).drop("_copy")
    # A row is in windows up to and with its time plus the width: it leaves one microsecond later.
    rows = rows.withColumn("_at", F.when(F.col("_own"), F.col("_at")).otherwise(F.col("_at") + width + 1))
    every = Window.partitionBy(*keys, "_block")
    so_far = every.orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    held = lambda v: F.sum(F.when(F.col("_own"), 0).otherwise(v)).over(every) + F.sum(F.when(F.col("_own"), v).otherwise(-v)).over(so_far)
    out = rows.withColumns({"n_window": held(F.lit(1).cast("long")), "n_bad": held(F.col("_bad"))}).where("_own").drop("_at", "_bad", "_block", "_own")
    return out.withColumn("trip", (F.col("n_window") >= least) & (F.col("n_bad") > most * F.col("n_window")))


def running_total(df: DataFrame, value: Column, order: Sequence[Column | str], block: Column, keys: Sequence[str], name: str) -> DataFrame:
    """Add the running sum of a value in order within keys. `block` grows with the order: sums of blocks are added up first,
    so that rows run within blocks and a hot key is spread over them."""
    rows = df.withColumns({"_value": value, "_block": block})
    sums = rows.groupBy(*keys, "_block").agg(F.sum("_value").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*keys, "_block", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.sum("_value").over(Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(sums, [*keys, "_block"]).withColumn(name, F.col("_before") + within).drop("_value", "_block", "_before")


def sticky(df: DataFrame, flag: str, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Once set, the flag stays set."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("tripped", F.max(F.col(flag).cast("int")).over(w) == 1)


def failure_runs(df: DataFrame, ok: Column, order: str, keys: Sequence[str], dead: int = 4) -> DataFrame:
    """Length of the run of failures that ends at each row, and the state it implies: alive, unknown or dead."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("_ok", ok.cast("int")).withColumn("_island", F.sum("_ok").over(w))
    v = Window.partitionBy(*keys, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("run", F.sum(1 - F.col("_ok")).over(v))
    state = F.when(F.col("run") == 0, "alive").when(F.col("run") >= dead, "dead").otherwise("unknown")
    return out.withColumn("state", state).drop("_ok", "_island")


def token_bucket(df: DataFrame, at: Column, order: str, rate: float, keys: Sequence[str] = ()) -> DataFrame:
    """Grant times of a bucket that holds one token: i/r + max(a_j - j/r) over the rows so far."""
    gap = 1 / rate
    w = Window.partitionBy(*keys).orderBy(order)
    out = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_a", at)
    ahead = F.max(F.col("_a") - F.col("_i") * gap).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("grant_at", F.col("_i") * gap + ahead).withColumn("wait", F.col("grant_at") - F.col("_a")).drop("_i", "_a")


def budget_prefix(df: DataFrame, cost: Column, order: Sequence[Column], quota: float, keys: Sequence[str] = (), block: Column | None = None) -> DataFrame:
    """Rows in order as long as their running cost stays within the quota; `block`, which grows with the order, spreads keys."""
    if block is not None:
        out = running_total(df, cost, order, block, keys, "running")
    else:
        out = df.withColumn("running", F.sum(cost).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn("admitted", F.col("running") <= quota)


def breaker(df: DataFrame, bad: Column, order: str, calls: int, least: int, most: float, keys: Sequence[str] = ()) -> DataFrame:
    """Open while more than `most` of the last `calls` calls (at least `least`) failed."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(calls - 1), 0)
    out = df.withColumns({"n_calls": F.count("*").over(w), "n_failed": F.sum(bad.cast("long")).over(w)})
    return out.withColumn("open", (F.col("n_calls") >= least) & (F.col("n_failed") > most * F.col("n_calls")))


def aborted(df: DataFrame, ok: Column, order: str, keys: Sequence[str], most: int = 5) -> DataFrame:
    """Rows of a scan with whether they still happen: after `most` failures in a row a site's scan stops."""
    out = failure_runs(df, ok, order, keys, most)
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return out.withColumn("aborted", F.coalesce(F.max("run").over(w) >= most, F.lit(False))).drop("state")


def cooled_down(df: DataFrame, at: str, order: str, keys: Sequence[str], seconds: int = 900) -> DataFrame:
    """Whether a call is refused: a breaker that opens stays open for `seconds`. df: breaker()'s rows, `at` in seconds."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(F.col("open"), F.col(at))).over(w)
    return df.withColumn("refused", F.coalesce(F.col(at) < last + seconds, F.lit(False)))


def penalised_rate(df: DataFrame, limited: Column, order: str, rate: float, keys: Sequence[str], least: float = 0.25) -> DataFrame:
    """The rate in force at each call: halved by each limit met before it, not below `least`."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    met = F.coalesce(F.sum(limited.cast("int")).over(w), F.lit(0))
    return df.withColumn("rate", F.greatest(F.lit(least), rate * F.pow(F.lit(0.5), met)))
