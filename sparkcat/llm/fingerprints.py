"""Document fingerprints by order MinHash: minimal occurrence-numbered k-mers, their text order kept, tuples hashed.

Each k-mer of code points is numbered by its occurrence in the text; the pair is hashed. The hash's low bits deal the
pairs into BINS bins (one permutation for all signature places), in each bin the TUPLE smallest are selected, put back in
text order, and their k-mers are hashed as a tuple. Moving text changes the order and thus the tuples, so signatures
follow edit distance, not only the set of k-mers. Likeness: of the bins that either text fills, the share that is equal.

A text of fewer than some 130 k-mers leaves bins with one member, which tells its k-mer but no order, or none.

Null and empty texts have an empty signature (like each other 1, like others 0); texts shorter than K are one k-mer; very
long texts are fingerprinted whole. Equal texts have equal fingerprints. Repeated rows are separate: rows that share a
doc_id follow each other in the order of their texts. Documents with a null doc_id come last in the order. Extra columns
are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fmix64, odd_constants

K, BINS, TUPLE = 8, 64, 2
_MULT = odd_constants(21, K)
_EMPTY = np.zeros(BINS, dtype=np.uint32)


def signature(text: str) -> np.ndarray:
    """BINS 32-bit places; 0 marks an empty bin."""
    if not text:
        return _EMPTY
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(c) < K:
        h = np.array([xxhash.xxh64_intdigest(c.tobytes())], dtype=np.uint64)
    else:
        n = len(c) - K + 1
        h = c[:n] * _MULT[0]
        for j in range(1, K):
            h += c[j : j + n] * _MULT[j]
        h = fmix64(h)
    n = len(h)
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.empty(n, dtype=bool)
    new[0], new[1:] = True, s[1:] != s[:-1]
    if new.all():
        occurrence = None
        rank = fmix64(h * np.uint64(0x9E3779B97F4A7C15))
    else:
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        occurrence = np.empty(n, dtype=np.uint64)
        occurrence[order] = (np.arange(n) - first).astype(np.uint64)
        rank = fmix64((h + occurrence * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0x9E3779B97F4A7C15))
    bins = (rank & np.uint64(BINS - 1)).astype(np.int64)
    # The bin in the high bits and the rank below: one sort finds every bin's smallest.
    key = (rank >> np.uint64(6)) | (bins.astype(np.uint64) << np.uint64(58))
    if n > 40 * BINS:  # the smallest of a bin lie among the low ranks, unless a bin has too few there
        low = np.nonzero(rank < np.uint64(2**64 - 1) // np.uint64(n // (16 * BINS)))[0]
        if np.bincount(bins[low], minlength=BINS).min() < TUPLE:
            low = np.arange(n)
    else:
        low = np.arange(n)
    picked = low[np.argsort(key[low], kind="stable")]
    b = bins[picked]
    start = np.searchsorted(b, np.arange(BINS))
    out = np.zeros(BINS, dtype=np.uint32)
    size = np.searchsorted(b, np.arange(BINS), side="right") - start
    full = np.nonzero(size)[0]
    one = picked[start[full]]
    two = np.where(size[full] > 1, picked[np.minimum(start[full] + 1, len(picked) - 1)], one)
    lo, hi = np.minimum(one, two), np.maximum(one, two)
    mixed = fmix64(h[lo] * np.uint64(3) + fmix64(h[hi]) + (size[full] > 1).astype(np.uint64))
    out[full] = (mixed >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    either = (x != 0) | (y != 0)
    return 1.0 if not either.any() else float((x[either] == y[either]).mean())


def fingerprint(text: str | None) -> str:
    return signature(text or "").astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by bucket and falling doc_id; each bucket ends with a copy of the row that follows it."""
    held, out = None, []
    cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    for pdf in batches:
        for bucket, doc, text, copy in zip(pdf["bucket"], pdf["doc_id"], pdf["text"], pdf["copy"], strict=True):
            if copy and (held is None or held[0] != bucket):
                continue
            s = signature(text)
            if held is not None and held[0] == bucket:
                _, prev, own, mine = held
                e = edited(own, text)
                es = signature(e) if e != own else mine
                out.append((prev, len(own), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), mine.astype(">u4").tobytes().hex(), es.astype(">u4").tobytes().hex(), likeness(mine, es), likeness(mine, s)))
            held = None if copy else (bucket, None if pd.isna(doc) else int(doc), text, s)
            if len(out) >= 500:
                yield _frame(out, cols)
                out = []
    yield _frame(out, cols)


def _frame(rows: list, cols: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=cols).astype({"doc_id": "Int64"})


def neighbours(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, with the likeness to it and to the next document.

    The next document is the one with the next smaller doc_id. Texts are shuffled once, into ranges of doc_id whose
    upper ends are doc_ids of the table; the row at an upper end is also sent to the range above, which it follows.
    Equal rows at an end are sent alike, and the first of them in order serves.
    """
    spark = docs.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    at = [i / n for i in range(1, n)]
    cuts = F.percentile_approx("doc_id", at, 100_000) if at else F.lit(None)
    stats = docs.agg(cuts.alias("q"), F.max("doc_id").alias("top"), F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    ends = sorted({*(stats["q"] or []), stats["top"]} - {None})  # as many numbers as shuffle partitions
    lit = F.array(*[F.lit(int(x)) for x in ends]) if ends else F.array().cast("array<bigint>")
    below = F.size(F.filter(lit, lambda q: q < F.col("doc_id"))).cast("int")
    bucket = F.coalesce(below, F.lit(0))  # null ids: after the smallest
    top = max(len(ends) - 1, 0)
    here = F.struct(bucket.alias("bucket"), F.lit(False).alias("copy"))
    # The row at the upper end of a range follows the range above; that of the highest range follows the lowest.
    above = F.when(bucket == top, F.lit(0)).otherwise(bucket + 1)
    is_end = F.array_contains(lit, F.col("doc_id"))
    if not ends:  # only null ids: the first of them follows the last
        is_end, above = F.lit(True), F.lit(0)
    copies = F.when(is_end, F.array(here, F.struct(above.alias("bucket"), F.lit(True).alias("copy")))).otherwise(F.array(here))
    rows = docs.select("doc_id", "text", F.inline(copies))
    # Numbers whose hashes fall into different partitions: each bucket has a partition of its own.
    part = F.pmod(F.hash("s"), F.lit(n))
    slots = {r["p"]: r["s"] for r in spark.range(20 * n).select(F.col("id").cast("int").alias("s")).groupBy(part.alias("p")).agg(F.min("s").alias("s")).collect()}
    slot = F.element_at(F.array(*[F.lit(slots.get(i, i)) for i in range(n)]), F.col("bucket") + 1)
    rows = rows.withColumn("slot", slot).repartition(n, "slot").sortWithinPartitions("bucket", "copy", F.col("doc_id").desc_nulls_last(), "text")
    return rows.mapInPandas(_compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
