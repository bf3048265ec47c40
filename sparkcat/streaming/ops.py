"""Structured Streaming forms: windows, deduplication, keyed state, upserts by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, folder: str, like: DataFrame, glob: str = "*.parquet", files_per_trigger: int = 4) -> DataFrame:
    """A table folder as a stream; NTZ times become TIMESTAMP, which watermarks need."""
    raw = spark.readStream.schema(like.schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    ntz = [c for c, t in raw.dtypes if t == "timestamp_ntz"]
    return raw.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else raw


def window_counts(events: DataFrame, ts: str, width: str, late: str) -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def dedupe(events: DataFrame, ts: str, keys: list[str], horizon: str) -> DataFrame:
    return events.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(keys)


def liveness_states(events: DataFrame, key: str, order: str, ok: str, dead: int = 4) -> DataFrame:
    """Per key: the run of failures so far, its state, and the order of its last row.

    A trigger's rows of a key are folded in order of `order`, however many frames they come in; rows that are older than
    the last one folded in an earlier trigger are late and left out.
    """

    def fold(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        run, last = state.get if state.exists else (0, None)
        rows = pd.concat(list(frames)).sort_values("_order", kind="stable")
        for at, good in zip(rows["_order"], rows["_ok"], strict=True):
            if last is None or at >= last:
                run, last = 0 if good else run + 1, int(at)
        state.update((run, last))
        yield pd.DataFrame({"key": [k[0]], "run": [run], "state": ["alive" if run == 0 else "dead" if run >= dead else "unknown"], "last": [last]})

    rows = events.select(F.col(key).cast("long").alias("key"), F.col(order).cast("long").alias("_order"), F.expr(ok).alias("_ok"))
    return rows.groupBy("key").applyInPandasWithState(fold, "key long, run long, state string, last long", "run long, last long", "update", "NoTimeout")


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run a stream over all data there is, batch by batch, and wait for its end."""
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    q.awaitTermination()


def versioned_upsert(spark: SparkSession, folder: str, key: str, order: str, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer: batch n leaves version n of the table, made of the latest rows per key, by `order`, of version
    n-1 and the batch together; of equals the batch's counts. A batch that is run again writes the same version again. The
    last `keep` versions stay (the one before is needed to run a batch again)."""

    def write(batch: DataFrame, n: int) -> None:
        rows = batch.withColumn("_new", F.lit(1))
        if n:
            rows = rows.unionByName(spark.read.parquet(f"{folder}/v{n - 1}").withColumn("_new", F.lit(0)))
        cols = [c for c in batch.columns if c != key]
        latest = rows.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(order, "_new")).alias("r")).select(key, "r.*")
        latest.write.mode("overwrite").parquet(f"{folder}/v{n}")
        if n >= keep:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v{n - keep}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    return write
