"""Sinks: item documents, episode shards, playlists, manifests, versioned tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def item_document(items: DataFrame, key: str) -> DataFrame:
    """One JSON text per item; a single enveloped file would gather all rows in one task."""
    return items.select(key, F.to_json(F.struct(*[c for c in items.columns])).alias("document"))


def envelope(spark: SparkSession, version: str, generated_at: str, items: int, project: str = "catalogue") -> DataFrame:
    """The head of a product: one row. Items are written beside it as JSON lines, so that no task holds them all."""
    return spark.createDataFrame([(version, project, generated_at, items)], "schema_version string, project string, generated_at string, items long")


def cleaned(items: DataFrame) -> DataFrame:
    """Items as they are exported: no poster at any level, tags as a list."""
    out = items.drop("poster")
    if "tags" in out.columns and dict(out.dtypes)["tags"] == "string":
        out = out.withColumn("tags", F.filter(F.split(F.coalesce("tags", F.lit("")), "[,/|; ]+"), lambda t: t != ""))
    for field in out.schema:
        out = out.withColumn(field.name, _without(F.col(field.name), field.dataType, "poster"))
    return out


def _without(c: Column, kind: T.DataType, name: str) -> Column:
    """A value without the fields of a name, at every level."""
    if isinstance(kind, T.StructType):
        kept = [f for f in kind if f.name != name]
        return F.when(c.isNotNull(), F.struct(*[_without(c[f.name], f.dataType, name).alias(f.name) for f in kept])) if _has(kind, name) else c
    if isinstance(kind, T.ArrayType) and _has(kind, name):
        return F.transform(c, lambda x: _without(x, kind.elementType, name))
    return c


def _has(kind: T.DataType, name: str) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has(kind.elementType, name)
    return isinstance(kind, T.StructType) and any(f.name == name or _has(f.dataType, name) for f in kind)


def episode_rows(items: DataFrame, key: str = "bangou") -> DataFrame:
    """A row per item and season that has episodes: key, season_number, title, episodes."""
    rows = items.select(key, F.col("title").alias("title"), F.explode("seasons").alias("s"))
    return rows.where(F.size("s.episodes") > 0).select(key, F.coalesce("s.season_number", F.lit(1)).alias("season_number"), "title", F.col("s.episodes").alias("episodes"))


def shard_count(rows: int, per_file: int = 2000) -> int:
    return -(-rows // per_file)


def eligible(items: DataFrame, key: str = "bangou") -> DataFrame:
    """Items with a key and an episode: those that get a playlist."""
    episodes = F.aggregate("seasons", F.lit(0), lambda a, s: a + F.greatest(F.size(s["episodes"]), F.lit(0)))
    return items.where((F.coalesce(F.col(key), F.lit("")) != "") & (F.coalesce(episodes, F.lit(0)) > 0))


def projected_seconds(total: int, sampled: int, seconds: float) -> float:
    """What all would take if they take as long as the sample did."""
    return seconds * total / sampled if sampled else 0.0


def write_playlists_within(df: DataFrame, path: str, category: str, ident: str, text: str, budget: float, sample: int = 200, clock: Callable[[], float] = time.time) -> tuple[int, bool]:
    """Write a playlist file for each item unless a sample shows that this would take longer than the budget: then none is
    left. Gives (files, skipped)."""
    total = df.count()
    if not total:
        return 0, False
    began = clock()
    write_playlists(df.limit(sample), path, category, text, ident)
    if projected_seconds(total, min(sample, total), clock() - began) > budget:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        return 0, True
    write_playlists(df, path, category, text, ident)
    return total, False


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """name, bytes and sha256 of each file of a product, computed where the files are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*[!_]*").load(path)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return files.where(~name.startswith("_") & ~name.startswith(".")).select(name.alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_atomically(df: DataFrame, path: str) -> None:
    """Write JSON to a new place beside the target and move it there when all of it is written."""
    spark, new = df.sparkSession, f"{path.rstrip('/')}.new"
    df.write.mode("overwrite").json(new)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    target, source = fs_path(path), fs_path(new)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"could not move {new} to {path}")


def write_product(items: DataFrame, unmatched: DataFrame, path: str, version: str, generated_at: str) -> DataFrame:
    """Items, episode shards, unmatched rows, the envelope, and a manifest of counts and checksums, which is returned."""
    spark, clean = items.sparkSession, cleaned(items)
    write_atomically(clean, f"{path}/items")
    write_shards(episode_rows(clean), f"{path}/episodes")
    write_atomically(unmatched, f"{path}/unmatched")
    n = spark.read.text(f"{path}/items").count()
    write_atomically(envelope(spark, version, generated_at, n), f"{path}/envelope")
    parts = {k: spark.read.text(f"{path}/{k}") for k in ("items", "episodes", "unmatched")}
    counts = reduce(DataFrame.unionByName, [f.agg(F.lit(k).alias("part"), F.count("*").alias("rows")) for k, f in parts.items()])
    sums = reduce(DataFrame.unionByName, [file_digests(spark, f"{path}/{k}").agg(F.lit(k).alias("part"), F.count("*").alias("files"), F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws(" ", "name", "sha256"))), "\n"), 256).alias("sha256")) for k in parts])
    out = counts.join(sums, "part").withColumns({"version": F.lit(version), "generated_at": F.lit(generated_at)})
    write_atomically(out, f"{path}/manifest")
    return spark.read.schema(out.schema).json(f"{path}/manifest")


def write_shards(rows: DataFrame, path: str, per_file: int = 2000) -> None:
    rows.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", per_file).json(path)


def playlist(ident: Column, entries: Column) -> Column:
    """An M3U text of an array of (season, episode, title, url)."""
    line = lambda e: F.concat(F.lit("#EXTINF:-1,"), ident, F.lit(" S"), e["season"].cast("string"), F.lit("E"), e["episode"].cast("string"), F.lit(" "), e["title"], F.lit("\n"), e["url"])
    return F.concat(F.lit("#EXTM3U\n"), F.array_join(F.transform(entries, line), "\n"), F.lit("\n"))


def write_playlists(df: DataFrame, path: str, category: str, text: str, ident: str | None = None) -> None:
    """Playlists by category, in files of their own if `ident` names what tells items apart."""
    by = [category, *([ident] if ident else [])]
    df.select(*by, F.col(text).alias("value")).write.mode("overwrite").option("lineSep", "\n").partitionBy(*by).text(path)


def manifest(frames: dict[str, DataFrame]) -> DataFrame:
    """name, rows and a checksum that doesn't depend on row order."""
    one = lambda n, f: f.agg(F.lit(n).alias("name"), F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(*f.columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"))
    return reduce(DataFrame.unionByName, [one(n, f) for n, f in frames.items()])
