"""Mixing sources to target weights: iterative proportional fitting of token weights, then sampling by probability.

Tokens (words) are summed per cell (source, language, topic); cells are raked until their sums over each of the three
marginals meet the targets. A document is kept with its cell's probability, by a number drawn from a hash of its doc_id:
the same document gets the same draw in every run and on every partitioning.

Every source and language keeps its name, however many there are; topics are the five of topic_of(), told by a text's
surface, as no table names any. Up to CELLS cells with tokens are raked on the driver (their number is counted first);
more are raked as a table, a sum and a join per marginal and round. Every document belongs to a cell.

Targets, where none are given, are the marginals' token shares to the power ALPHA (a temperature that lifts small ones).
Null sources and languages are the value ''; null and empty texts have no tokens and take their cell's probability, or that
of all tokens where the cell has none; very long texts count whole. Documents with a null doc_id draw the number of an empty
id. Repeated rows share one draw; a draw equal to the probability is left out. Empty tables give none. The columns topic,
n_tokens, keep_prob and sampled are added, in place of such columns if there are any; all others stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GAP_SQL, forget, stored

ALPHA, SHARE, ROUNDS, CLOSE = 0.7, 0.9, 200, 1e-9
#: Up to so many cells are raked on the driver, and their probabilities broadcast (some megabytes); more are joined.
CELLS = 100_000
OWN = ("topic", "n_tokens", "keep_prob", "sampled")
AXES = ("_source", "_lang", "_topic")


def topic_of(text: Column) -> Column:
    """A topic by surface form: tabular, shouting, symbolic, short or prose."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.char_length(t), F.lit(1))
    share = lambda pattern: (n - F.char_length(F.regexp_replace(t, pattern, ""))) / n
    return (
        F.when(share("[|]") > 0.02, "tabular").when(share("[A-Z]") > 0.4, "shouting")
        .when(share("[#*$%&<>]") > 0.05, "symbolic").when(n < 400, "short").otherwise("prose")
    )


def n_words(text: Column) -> Column:
    t = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, GAP_SQL))).cast("long")


def rake(cells: Mapping[tuple, float], targets: list[Mapping], rounds: int = ROUNDS) -> dict[tuple, float]:
    """Cell weights whose marginals meet the targets (each scaled to the targets' own total share of 1)."""
    w = {k: float(v) for k, v in sorted(cells.items()) if v > 0}
    total = sum(w.values()) or 1.0
    w = {k: v / total for k, v in w.items()}
    scaled = []
    for axis, target in enumerate(targets):
        there = {k[axis] for k in w}
        t = {v: float(target.get(v, 0.0)) for v in sorted(there)}
        s = sum(t.values())
        scaled.append({v: x / s for v, x in t.items()} if s else None)
    for _ in range(rounds):
        worst = 0.0
        for axis, target in enumerate(scaled):
            if target is None:
                continue
            sums: dict = {}
            for k, v in w.items():
                sums[k[axis]] = sums.get(k[axis], 0.0) + v
            worst = max([worst, *(abs(target[a] - s) for a, s in sums.items())])
            w = {k: v * target[k[axis]] / sums[k[axis]] if sums[k[axis]] else 0.0 for k, v in w.items()}
        if worst < CLOSE:
            break
    return w


def probabilities(cells: Mapping[tuple, float], weights: Mapping[tuple, float], share: float = SHARE) -> dict[tuple, float]:
    """Per cell, the probability that makes expected tokens follow the weights, with at most `share` of all tokens.

    A probability cannot exceed 1: the common scale is the largest for which the token total is met, cells at 1 are full.
    """
    have = {k: float(v) for k, v in sorted(cells.items()) if v > 0}
    want = share * sum(have.values())
    lo, hi = 0.0, max([have[k] / weights[k] for k in have if weights.get(k, 0) > 0], default=0.0)
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if sum(min(have[k], mid * weights.get(k, 0.0)) for k in have) > want else (mid, hi)
    return {k: min(1.0, hi * weights.get(k, 0.0) / have[k]) for k in have}


def with_cells(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whole as _row beside their cell, tokens and draw; and the cells' tokens t, as a table."""
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in OWN]).alias("_row"), *[
        c.alias(n) for n, c in (("_source", F.coalesce("source", F.lit(""))), ("_lang", F.coalesce("lang", F.lit(""))), ("_topic", topic_of(F.col("text"))), ("_tokens", n_words(F.col("text"))),
                                ("_draw", F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("mix")), F.lit(2**53)) / float(2**53)))
    ])
    # One pass over the texts.
    return base, stored(base.groupBy(*AXES).agg(F.sum("_tokens").alias("t")).where("t > 0"), "cells")


def local_table(spark: SparkSession, rows: Iterable[tuple], names: tuple[str, ...], number: str) -> DataFrame:
    """A small table of strings and one number. From Arrow, as executors would read a list in Python workers of another kind
    than the operators', which stay in memory beside these."""
    schema = pa.schema([*[(n, pa.string()) for n in names], (number, pa.float64())])
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema))


def raked_table(cells: DataFrame, targets: list[Mapping] | None = None, share: float = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """As rake() and probabilities() on any number of cells: _source, _lang, _topic, p."""
    spark = cells.sparkSession
    total = cells.agg(F.sum("t")).first()[0]
    goals = []
    for i, a in enumerate(AXES):
        sums = cells.groupBy(a).agg(F.sum("t").alias("s"))
        if targets is None:
            goal = sums.select(a, F.pow(F.col("s").cast("double"), ALPHA).alias("g"))
        else:
            named = local_table(spark, [(k, float(v)) for k, v in targets[i].items()], (a,), "g")
            goal = sums.select(a).join(named, a, "left").fillna(0.0, ["g"])
        goal = stored(goal, "goal")
        whole = goal.agg(F.sum("g")).first()[0]
        goals.append(goal.withColumn("g", F.col("g") / whole) if whole else None)
    w = stored(cells.withColumn("w", F.col("t") / float(total)), "weights")
    for _ in range(rounds):
        worst, before = 0.0, w
        for a, goal in zip(AXES, goals, strict=True):
            if goal is None:
                continue
            sums = w.groupBy(a).agg(F.sum("w").alias("s")).join(goal, a)
            sums = stored(sums, "sums")
            worst = max(worst, sums.agg(F.max(F.abs(F.col("s") - F.col("g")))).first()[0])
            w = w.join(sums, a).withColumn("w", F.when(F.col("s") > 0, F.col("w") * F.col("g") / F.col("s")).otherwise(0.0)).select(*AXES, "t", "w")
        w = stored(w, "weights")
        forget(spark, before)
        if worst < CLOSE:
            break
    lo, hi = 0.0, w.where("w > 0").agg(F.max(F.col("t") / F.col("w"))).first()[0] or 0.0
    for _ in range(8):  # the scale, 32 times closer with each pass
        steps = [lo + (hi - lo) * k / 32 for k in range(1, 33)]
        got = w.agg(*[F.sum(F.least(F.col("t").cast("double"), F.col("w") * x)).alias(f"s{k}") for k, x in enumerate(steps)]).first()
        at = next((k for k, x in enumerate(got) if x > share * total), 31)
        lo, hi = (steps[at - 1] if at else lo), steps[at]
    return w.select(*AXES, F.least(F.lit(1.0), hi * F.col("w") / F.col("t")).alias("p"))


def temperature_targets(cells: Mapping[tuple, float], alpha: float = ALPHA) -> list[dict]:
    out = []
    for axis in range(3):
        sums: dict = {}
        for k, v in cells.items():
            sums[k[axis]] = sums.get(k[axis], 0.0) + v
        out.append({k: v**alpha for k, v in sums.items()})
    return out


def mixed(docs: DataFrame, targets: list[Mapping] | None = None, share: float = SHARE) -> DataFrame:
    """docs with topic, n_tokens, keep_prob and sampled."""
    base, cells = with_cells(docs)
    if cells.count() <= CELLS:
        have = {tuple(r[a] for a in AXES): r["t"] for r in cells.collect()}
        p = probabilities(have, rake(have, targets or temperature_targets(have)), share)
        table = F.broadcast(local_table(docs.sparkSession, [(*k, v) for k, v in sorted(p.items())], AXES, "p"))
    else:
        table = raked_table(cells, targets, share)
    out = base.join(table, list(AXES), "left").withColumn("p", F.coalesce("p", F.lit(share)))
    return out.select("_row.*", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"), F.col("p").alias("keep_prob"), (F.col("_draw") < F.col("p")).alias("sampled"))
