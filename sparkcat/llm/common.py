"""Helpers that the corpus operators share: word rules, shared tables, hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and return.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
GAP_SQL = "[\\x20\\x09-\\x0D]+"
_own_dir: str | None = None


def lower_ascii(text: str | None) -> str:
    """Lower-case A-Z only: bytes.lower() leaves all other bytes as they are."""
    if not text:
        return ""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_column(text: Column) -> Column:
    """The words of a text (null: none) as an array, natively."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP_SQL), lambda w: w != "")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where it is unset and all runs on one
    machine (tests). On a cluster without it, a folder of one machine would lose data: that is an error."""
    global _own_dir
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        _own_dir = _own_dir or "file://" + tempfile.mkdtemp(prefix="sparkcat-")
        found = _own_dir
    return found.rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/sparkcat/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables that stored() wrote and that no later step reads."""
    for df in frames:
        for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
            delete_path(spark, f)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fmix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), elementwise."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def odd_constants(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit multipliers, the same for the same seed on every machine."""
    raw = np.array([xxhash.xxh64_intdigest(f"{seed}:{i}") for i in range(n)], dtype=np.uint64)
    return raw | np.uint64(1)


class WordHashes:
    """64-bit hashes of words, kept for repeated words up to a fixed number of entries (memory bound, not a data cap)."""

    def __init__(self, seed: int = 0, keep: int = 100_000):
        self.seed, self.keep, self.seen = seed, keep, {}

    def __call__(self, words: list[str]) -> np.ndarray:
        seen = self.seen
        if len(seen) > self.keep:
            seen.clear()
        h, seed = xxhash.xxh64_intdigest, self.seed
        out = []
        for w in words:
            v = seen.get(w)
            if v is None:
                v = seen[w] = h(w.encode("utf-8", "surrogatepass"), seed)
            out.append(v)
        return np.array(out, dtype=np.uint64)


_kept: dict = {}


def kept(key: tuple, make: Callable):
    """What a worker keeps from task to task for the operator at work; another operator's is dropped, so that the workers of
    a pipeline hold one operator's tables at a time."""
    if key not in _kept:
        if len(_kept) > 1 or any(k[0] != key[0] for k in _kept):
            _kept.clear()
            _give_back()
        _kept[key] = make()
    return _kept[key]


def _give_back() -> None:
    """Return freed memory to the system: Arrow's, and the C library's where it can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def word_hashes() -> WordHashes:
    """The process's own table of word hashes."""
    return kept(("words",), WordHashes)


def bounded_ids(df: DataFrame, key: str, bound: int) -> DataFrame:
    """At most `bound` rows of df, those with the smallest hash of the key: a fixed, source-independent sample."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(bound)


def not_fold(column: str, mod: int, rest: int) -> Column:
    """Whether crc32 of a key as text, modulo mod, differs from rest (null keys: crc32 of the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % mod != rest


@contextlib.contextmanager
def runtime_bloom(spark: SparkSession, more: dict[str, str] | None = None):
    """Inside, Spark filters a join's large side by a Bloom filter of the small side before it shuffles.

    The filter has a fixed size (spark.sql.optimizer.runtime.bloomFilter.maxNumBits, 8 MB), whatever the tables' sizes.
    The small side needs a comparison as a filter, which Spark takes as the sign that the filter pays.
    Joins that are broadcast get no filter; `more` settings hold inside too.
    """
    wanted = {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64g",
    } | (more or {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
