"""Quality by an interpolated modified Kneser-Ney model of trusted text, made and used one part at a time.

The model (word n-grams up to order 3, three discounts per order) is counted from all documents labelled quality 1: nine
in ten of them (by a hash of doc_id) train it, the rest calibrate. It grows with the input, so it is never broadcast.

Interpolation is stored in back-off form: a document's log probability is a sum over its n-grams, where seen n-grams add
a correction and seen contexts a back-off weight. Such a sum needs no order of words, so it is a join of counts. The
n-grams of some megabytes of text are sorted and counted, each n-gram once with the documents that have it, and cut by
hash into as many shards as there are shuffle partitions; so is the model. Shards of one number meet in one task, and the
sums are added up per document.

All n-grams at once take many times the disk of the texts. So words fall into PARTS by their hash, and n-grams by one of
their words: trigrams by the middle one, bigrams by the first one and contexts by the last one, so that all that a part's
trigrams need of shorter n-grams lies in the part, except what is kept per word. For each part the texts are read again,
its model is counted, met by the texts' n-grams of the part, and dropped before the next. Every n-gram is in one part.

Perplexity is exp(-mean log probability) per word. Per language, the bound is the QUANTILE of the calibration documents'
perplexities; languages with fewer than LEAST of those use the bound over all. A document is kept if it does
not exceed its language's bound. Null, empty and blank texts have no perplexity and are not kept; very long texts are
scored whole. Null languages are ''. Repeated rows each have a row with the same result; a null doc_id has no label. No
trusted rows: all documents with words are kept. Extra columns are ignored, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, WordHashes, fmix64, forget, lower_ascii, runtime_bloom, stored, words_column

ORDER, QUANTILE, LEAST = 3, 0.995, 20
START = 0  # the hash of the mark before a text, which is in part 0
#: A chunk of texts ends at so many characters or texts; so many numbers of the model are packed at a time.
SHARD, CHARS, TEXTS, NUMBERS = 2**15, 4_000_000, 2**16, 2**20
#: So many parts, and so many of them at a time where only counts of counts are taken. More parts take less disk and more time.
PARTS, AT_ONCE = 20, 5
PACKED, VALUES = "shard int, data binary", "gram long, value double"
#: The low bits of a word's hash, which hold its part: PARTS is at most one more. The first k of eight bytes.
_PART, _BYTES = np.uint64(31), np.array([256**k - 1 for k in range(9)], dtype=np.uint64)
_M, _CONTEXT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x5BD1E995)


def padded(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Hashes of a text's words after the start marks, each with its part; nothing for a text without words."""
    words = WORD.findall(lower_ascii(text))
    if not words:
        return np.empty(0, np.uint64)
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    sizes = np.array([len(w) for w in raw])
    parts = word_parts(np.frombuffer(b"".join(raw) + bytes(8), np.uint8), np.cumsum(sizes) - sizes, sizes)
    return np.concatenate([np.full(ORDER - 1, np.uint64(START)), hashes(words) & ~_PART | parts])


def gram_hash(*words: np.ndarray) -> np.ndarray:
    """Hashes of n-grams, given as one array for each place."""
    g = np.full(len(words[0]), np.uint64(len(words)))
    for w in words:
        g = fmix64(g * _M + w)
    return g


def features(text: str | None, hashes: WordHashes) -> list[np.ndarray]:
    """At each word: the keys of its three n-grams, and of the contexts of the two longer ones."""
    h = padded(text, hashes)
    if not len(h):
        return [h] * 5
    one, two, three = gram_hash(h), gram_hash(h[:-1], h[1:]), gram_hash(h[:-2], h[1:-1], h[2:])
    return [one[2:], two[1:], three, one[1:-1] ^ _CONTEXT, two[:-1] ^ _CONTEXT]


def text_words(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """The texts' bytes in lower case, 8 more after them; where in these the words begin, how long each is, and the number
    of its text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), pa.scalar("\n", pa.large_string()))
    data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = (data != 32) & ((data - np.uint8(9)) > 4)  # bytes below 9 wrap around
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    begins, sizes = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False) + 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(begins, ends), prepend=0))
    low = np.zeros(len(data) + 8, np.uint8)
    np.bitwise_or(data, ((data - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5), out=low[:-8])
    return low, begins, sizes, owner


def word_parts(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The parts of words, by their lengths and last bytes: quicker than their hashes, which only a part's words need."""
    eight = np.ndarray(max(0, len(data) - 7), "<u8", data, strides=(1,))
    x = eight[begins + np.maximum(sizes - 8, 0)]
    x &= _BYTES[np.minimum(sizes, 8)]
    x += sizes.view(np.uint64)
    x *= _M
    x ^= x >> np.uint64(32)
    x *= _M
    x >>= np.uint64(32)  # the upper half, scaled to the parts
    x *= np.uint64(PARTS)
    x >>= np.uint64(32)
    return x


def _xxh64(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """xxh64 of slices of data, which goes on for 8 bytes after the last one; all slices of one length below 32 at a time."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    eight, four = (np.ndarray(len(data) - 7, kind, data, strides=(1,)) for kind in ("<u8", "<u4"))

    def turn(x: np.ndarray, k: int) -> np.ndarray:
        return (x << np.uint64(k)) | (x >> np.uint64(64 - k))

    out = np.empty(len(begins), np.uint64)
    kind = np.minimum(sizes, 32).astype(np.uint8)
    order = np.argsort(kind, kind="stable")
    edges = np.searchsorted(kind[order], np.arange(34))
    for size in range(1, 32):
        at = order[edges[size] : edges[size + 1]]
        if not len(at):
            continue
        place, h = begins[at], np.full(len(at), p5 + np.uint64(size))
        for _ in range(size // 8):
            h = turn(h ^ (turn(eight[place] * p2, 31) * p1), 27) * p1 + p4
            place = place + 8
        if size % 8 >= 4:
            h = turn(h ^ (four[place].astype(np.uint64) * p1), 23) * p2 + p3
            place = place + 4
        for k in range(size % 4):
            h = turn(h ^ (data[place + k].astype(np.uint64) * p5), 11) * p1
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        out[at] = h ^ (h >> np.uint64(32))
    for i in order[edges[32] :].tolist():
        out[i] = xxhash.xxh64_intdigest(data[begins[i] : begins[i] + sizes[i]].tobytes())
    return out


def places(texts: pa.Array, parts: range) -> tuple[np.ndarray, ...]:
    """Where the word before one of the texts' words is of these parts: the hashes of the two words before it and its own, and
    the number of the text. And for all words of these parts: the hash and the number of the text."""
    data, begins, sizes, owner = text_words(texts)
    part = word_parts(data, begins, sizes)
    own = np.concatenate([[START in parts] * 2, (part >= parts.start) & (part < parts.stop)])  # two marks before all words
    second = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, bool)
    at, last = np.flatnonzero(np.where(second, START in parts, own[1:-1])), np.flatnonzero(own[2:])
    # The hashes of these words and the two before them; in a text's first and second word some of those are marks.
    needed = np.zeros(len(own), bool)
    for k in (0, 1, 2):
        needed[at + k] = True
    needed[last + 2] = True
    needed = np.flatnonzero(needed[2:])
    h = np.full(len(own), np.uint64(START))
    h[needed + 2] = _xxh64(data, begins[needed], sizes[needed]) & ~_PART | part[needed]
    first = second | np.concatenate([[False], second[:-1]])[: len(second)]
    a, b = np.where(first[at], np.uint64(START), h[at]), np.where(second[at], np.uint64(START), h[at + 1])
    return a, b, h[at + 2], owner[at], h[last + 2], owner[last]


def part_of(words: np.ndarray) -> np.ndarray:
    return words & _PART


def dealt(by: np.ndarray, columns: list[np.ndarray], n: int) -> pa.RecordBatch:
    """Columns of 64 bits in rows of (shard, data), cut into n shards by a hash."""
    to = ((by >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(to, kind="stable")
    edges = np.searchsorted(to[order], np.arange(n + 1)).tolist()
    data = np.stack([x.view(np.uint64) for x in columns])[:, order]
    return _rows([(i, data[:, lo:hi].tobytes()) for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)) if lo < hi])


def squeezed(keys: np.ndarray) -> bytes:
    """Sorted keys as steps from one to the next, all first bytes before all second ones: their zeros take little room."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unsqueezed(data) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def _counts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Words in order and their counts, of a table with one row at most."""
    if not table.num_rows:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = table.column("data")[0].as_buffer()
    half = data.size // 2
    return unsqueezed(data.slice(0, half)), np.frombuffer(data.slice(half), np.int64)


def _rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "data"])


def gathered(table: pa.Table, k: int) -> np.ndarray:
    """The k columns that dealt() cut."""
    return np.concatenate([np.empty((k, 0), np.uint64), *[np.frombuffer(x.as_buffer(), np.uint64).reshape(k, -1) for x in table.column("data")]], axis=1)


def _first(*keys: np.ndarray) -> np.ndarray:
    """Whether a row is the first of its keys, which come sorted."""
    out = np.ones(len(keys[0]), bool)
    if len(out):
        out[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return out


def _summed(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of x over the groups that begin at `first`."""
    return np.add.reduceat(x, np.flatnonzero(first)) if len(x) else x


def _weights(m: np.ndarray, first: np.ndarray, d: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """For counts whose contexts begin at `first`: each one's discounted share of its context, and the context's back-off weight."""
    cut = np.array([0.0, *d])[np.minimum(m, 3)]
    group = np.cumsum(first) - 1
    total = _summed(m, first)[group]
    return (m - cut) / total, _summed(cut, first)[group] / total


def _low(m: np.ndarray, d: list[float], total: int, unseen: float) -> np.ndarray:
    """Probabilities of words that follow m different ones."""
    return (m - np.array([0.0, *d])[np.minimum(m, 3)]) / total + unseen


def _how_many(m: np.ndarray) -> list[int]:
    """How many of m are 1, 2, 3 and 4."""
    return [int((m == i).sum()) for i in (1, 2, 3, 4)]


def _discounts(n: list[int]) -> list[float]:
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    ratio = lambda a, b: a / b if b else 0.0
    raw = (1 - 2 * y * ratio(n2, n1), 2 - 3 * y * ratio(n3, n2), 3 - 4 * y * ratio(n4, n3))
    return [min(max(x, 0.05), cap) for x, cap in zip(raw, (0.95, 1.9, 2.8), strict=True)]


def trigrams(texts: DataFrame, parts: range, n: int, by: slice) -> DataFrame:
    """The trigrams of some parts, each once with its count in some megabytes of text: a, b, c, m, dealt by two of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(batch):
                words = places(chunk.column("text"), parts)[:3]
                _, at, m = np.unique(gram_hash(*words), return_index=True, return_counts=True)
                words = [w[at] for w in words]
                yield dealt(gram_hash(*words[by]), [*words, m], n)

    return texts.mapInArrow(run, PACKED)


def _types(table: pa.Table, context: slice) -> tuple[np.ndarray, ...]:
    """Each trigram once, those of a context together: a, b, c, m, and whether it is its context's first."""
    *words, m = gathered(table, 4)
    tri, two = gram_hash(*words), gram_hash(*words[context])
    order = np.lexsort((tri, two))
    tri, two = tri[order], two[order]
    first = _first(two, tri)
    return *[w[order][first] for w in words], _summed(m[order].view(np.int64), first), _first(two[first])


def word_counts(texts: DataFrame, n: int) -> tuple[DataFrame, list[list[int]], list[int]]:
    """How many different words each word follows, as stored rows of shards: word, count; for each order, how many counts are
    1, 2, 3 and 4; and words, bigrams and words counted thrice or more."""
    spark = texts.sparkSession

    def count(table: pa.Table) -> pa.Table:
        _, _, c, m, first = _types(table, slice(1, 3))
        follows = np.diff(np.flatnonzero(np.append(first, True)))
        words, times = np.unique(c[first], return_counts=True)
        stats = _rows([(-1, np.array([*_how_many(m), *_how_many(follows)]).tobytes())])
        return pa.Table.from_batches([dealt(gram_hash(words), [words, times], n), stats])

    def add(table: pa.Table) -> pa.Table:
        words, times = gathered(table, 2)
        order = np.argsort(words)
        first = _first(words[order])
        words, times = words[order][first], _summed(times[order].view(np.int64), first)
        stats = _rows([(-1, np.array([*_how_many(times), len(words), times.sum(), (times > 2).sum()]).tobytes())])
        return pa.Table.from_batches([_rows([(table.column("shard")[0].as_py(), squeezed(words) + times.tobytes())]), stats])

    def total(df: DataFrame, k: int) -> list[int]:
        return np.sum([np.zeros(k, np.int64), *[np.frombuffer(r["data"], np.int64) for r in df.where("shard < 0").collect()]], axis=0).tolist()

    made = []
    for lo in range(0, PARTS, AT_ONCE):
        made.append(stored(trigrams(texts, range(lo, min(lo + AT_ONCE, PARTS)), n, slice(1, 3)).groupBy("shard").applyInArrow(count, PACKED), "kn-counts"))
    parts = made[0]
    for more in made[1:]:
        parts = parts.union(more)
    words = stored(parts.where("shard >= 0").groupBy("shard").applyInArrow(add, PACKED), "kn-words")
    longer, one = total(parts, 8), total(words, 7)
    forget(spark, *made)
    return words, [one[:4], longer[4:], longer[:4]], one[4:]


def part_model(texts: DataFrame, words: DataFrame, part: int, n: int, d: list[list[float]], low: Callable) -> DataFrame:
    """gram, value of a part's n-grams of two and three words and their contexts; low: of counts of words, probabilities."""

    def three(table: pa.Table) -> pa.Table:  # by context
        a, b, c, m, first = _types(table, slice(0, 2))
        return pa.Table.from_batches([dealt(gram_hash(b, c), [a, b, c, *_weights(m, first, d[2]), first.astype(np.int64)], n)])

    def follows(table: pa.Table) -> pa.Table:  # by bigram
        _, b, c, *_ = gathered(table, 6)
        _, at, m = np.unique(gram_hash(b, c), return_index=True, return_counts=True)
        return pa.Table.from_batches([dealt(gram_hash(b[at]), [b[at], c[at], m], n)])

    def two(table: pa.Table) -> pa.Table:  # by first word
        b, c, m = gathered(table, 3)
        order = np.lexsort((c, b))
        b, c, m = b[order], c[order], m[order].view(np.int64)
        first = _first(b)
        return pa.Table.from_batches([dealt(gram_hash(c), [b, c, *_weights(m, first, d[1]), first.astype(np.int64)], n)])

    def one(table: pa.Table, counts: pa.Table) -> pa.Table:  # by last word
        b, c, own, gamma, first = gathered(table, 5)
        word, m = _counts(counts)
        rest = gamma.view(float) * low(m[np.searchsorted(word, c)]) if len(c) else np.empty(0)
        return pa.Table.from_batches([dealt(gram_hash(b, c), [b, c, own.view(float) + rest, rest, gamma, first], n)])

    def values(tri: pa.Table, bi: pa.Table) -> pa.Table:  # by bigram
        a, b, c, own, gamma, first = gathered(tri, 6)
        own, gamma, first = own.view(float), gamma.view(float), first > 0
        x, y, p, rest, weight, head = gathered(bi, 6)
        p, rest, weight, head = p.view(float), rest.view(float), weight.view(float), head > 0
        grams = gram_hash(x, y)
        order = np.argsort(grams)
        under = p[order][np.searchsorted(grams[order], gram_hash(b, c))] if len(b) else np.empty(0)
        keys = [gram_hash(a, b, c), gram_hash(a[first], b[first]) ^ _CONTEXT, grams, gram_hash(x[head]) ^ _CONTEXT]
        found = [np.log(own + gamma * under) - np.log(gamma) - np.log(under), np.log(gamma[first]), np.log(p) - np.log(rest), np.log(weight[head])]
        return pa.table({"gram": np.concatenate(keys).view(np.int64), "value": np.concatenate(found)})

    tri = trigrams(texts, range(part, part + 1), n, slice(0, 2)).groupBy("shard").applyInArrow(three, PACKED)
    bi = tri.groupBy("shard").applyInArrow(follows, PACKED).groupBy("shard").applyInArrow(two, PACKED)
    bi = bi.groupBy("shard").cogroup(words.groupBy("shard")).applyInArrow(one, PACKED)
    return tri.groupBy("shard").cogroup(bi.groupBy("shard")).applyInArrow(values, VALUES)


def train(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, float]:
    """The model as (gram, value, part): what each occurrence of a hashed n-gram or context adds to a log probability; and the
    log probability of an unseen word. Both grow with the texts of `ids`, which has each id once. A part is made anew whenever
    it is read (`part = k` makes no other), from stored tables, which the caller deletes in the end (forget)."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = stored(ids.select("doc_id"), "kn-trusted")
    with runtime_bloom(spark), lean(spark):
        # A comparison that holds for all, as runtime_bloom needs one.
        texts = stored(docs.join(ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(10)) >= 0), "doc_id", "left_semi").select("text"), "kn-texts")
    forget(spark, ids)
    with lean(spark):
        words, found, (types, total, often) = word_counts(texts, n)
    if not types:
        forget(spark, texts, words)
        return spark.createDataFrame([], f"{VALUES}, part int"), 0.0
    d = [_discounts(x) for x in found]
    unseen = (found[0][0] * d[0][0] + found[0][1] * d[0][1] + often * d[0][2]) / total / (types + 1)
    words = words.where("shard >= 0")

    def low(m: np.ndarray) -> np.ndarray:
        return _low(m, d[0], total, unseen)

    def single(part: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    word, m = _counts(pa.Table.from_batches([batch.slice(i, 1)]))
                    own = part_of(word) == part
                    yield pa.RecordBatch.from_pydict({"gram": gram_hash(word[own]).view(np.int64), "value": np.log(low(m[own])) - math.log(unseen)})

        return run

    out = None
    for part in range(PARTS):
        one = words.mapInArrow(single(part), VALUES).union(part_model(texts, words, part, n, d, low)).withColumn("part", F.lit(part))
        out = one if out is None else out.union(one)
    return out, math.log(unseen)


@contextlib.contextmanager
def lean(spark: SparkSession):
    """Inside, Spark deletes a query's shuffles when it ends, not at some later collection of garbage, and stored tables are
    packed more tightly. No query may be run twice."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about CHARS characters (or one longer text) and TEXTS texts at most."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()):
        if i > start and (size + n > CHARS or i - start == TEXTS):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def shards(keys: np.ndarray, values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted keys and their values, cut into shards that fit a cache."""
    return [(keys[i : i + SHARD], values[i : i + SHARD]) for i in range(0, len(keys), SHARD)]


def meet(model: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums per owner of the values of x's keys; x is met with a shard of the model at a time."""
    order = np.argsort(x, kind="stable")
    x, owner = x[order], owner[order]
    out = np.zeros(n)
    edges = [*np.searchsorted(x, np.array([keys[0] for keys, _ in model], dtype=np.uint64)), len(x)]
    for (keys, values), lo, hi in zip(model, edges, edges[1:], strict=False):
        if lo < hi:
            at = np.minimum(np.searchsorted(keys, x[lo:hi]), len(keys) - 1)
            ok = keys[at] == x[lo:hi]
            out += np.bincount(owner[lo:hi][ok], weights=values[at[ok]], minlength=n)
    return out


def _edges(keys: np.ndarray, n: int) -> list[int]:
    """Where the n shards of sorted keys begin, and where the last one ends."""
    return [*np.searchsorted(keys, np.array([(i * 2**64 + n - 1) // n for i in range(n)], dtype=np.uint64)).tolist(), len(keys)]


def packed_model(model: DataFrame, n: int) -> DataFrame:
    """The model in shards by key: each row has the sorted keys of some of a shard's numbers, and the numbers."""

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        keys = np.concatenate([b.column("gram").to_numpy() for b in held]).view(np.uint64)
        values = np.concatenate([b.column("value").to_numpy() for b in held])
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        edges = _edges(keys, n)
        rows = [(i, squeezed(keys[lo:hi]), values[lo:hi].tobytes()) for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)) if lo < hi]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2)]], names=["shard", "grams", "vals"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= NUMBERS:
                yield pack(held)
                held = []
        if held:
            yield pack(held)

    return model.mapInArrow(run, "shard int, grams binary, vals binary")


def packed_texts(docs: DataFrame, n: int, wanted: int) -> DataFrame:
    """A part's n-grams of `text` in shards by key. A row has some texts' keys of a shard, sorted and each once; how often
    each occurs; for each occurrence the place of its text in `docs`; and `docs`, the texts' values of `_key`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(batch):
                a, b, c, owner, word, last = places(chunk.column("text"), range(wanted, wanted + 1))
                every = np.concatenate([gram_hash(word), gram_hash(b, c), gram_hash(a, b, c), gram_hash(b) ^ _CONTEXT, gram_hash(a, b) ^ _CONTEXT])
                owner = np.concatenate([last, *[owner] * 4])
                order = np.argsort(every, kind="stable")
                every, owner, ids = every[order], owner[order], chunk.column("_key").to_numpy()
                edges, rows = _edges(every, n), []
                for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
                    if lo < hi:
                        keys, times = np.unique(every[lo:hi], return_counts=True)
                        texts, at = np.unique(owner[lo:hi], return_inverse=True)
                        rows.append((i, squeezed(keys), times.astype(np.uint32).tobytes(), at.astype(np.uint16).tobytes(), ids[texts].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3, 4)]], names=["shard", "grams", "times", "at", "docs"])

    return docs.select("_key", "text").mapInArrow(run, "shard int, grams binary, times binary, at binary, docs binary")


def _met(model: pa.Table, texts: pa.Table) -> pa.Table:
    """Sums of a shard's values per text."""
    def blobs(t: pa.Table, c: str, kind: type) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), dtype=kind) for x in t.column(c)]

    ids, sums = [np.empty(0, np.int64)], [np.empty(0)]
    if model.num_rows:
        keys, values = np.concatenate([unsqueezed(x.as_buffer()) for x in model.column("grams")]), np.concatenate(blobs(model, "vals", np.float64))
        order = np.argsort(keys, kind="stable")
        cut = shards(keys[order], values[order])
        for x, times, at, docs in zip([unsqueezed(x.as_buffer()) for x in texts.column("grams")], blobs(texts, "times", np.uint32), blobs(texts, "at", np.uint16), blobs(texts, "docs", np.int64), strict=True):
            ids.append(docs)
            sums.append(meet(cut, np.repeat(x, times), at, len(docs)))
    return pa.table({"_key": np.concatenate(ids), "s": np.concatenate(sums)})


def keyed(docs: DataFrame) -> DataFrame:
    out = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"))
    return out.withColumn("_key", F.xxhash64("doc_id", "text", "lang"))


def part_sums(docs: DataFrame, model: DataFrame, unseen: float) -> DataFrame:
    """_key, s: the sum of the model's values over the n-grams of each text with words, as a stored table. One part of the model
    after another is made and met; the sums so far are carried along."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts, sums = keyed(docs), stored(spark.createDataFrame([], "_key long, s double"), "kn-sums")
    for part in range(PARTS if unseen else 0):  # 0: the model is empty
        met = packed_model(model.where(F.col("part") == part), n).groupBy("shard").cogroup(packed_texts(texts, n, part).groupBy("shard")).applyInArrow(_met, "_key long, s double")
        with lean(spark):
            before, sums = sums, stored(met.union(sums).groupBy("_key").agg(F.sum("s").alias("s")), "kn-sums")
        forget(spark, before)
    return sums


def perplexities(docs: DataFrame, model: DataFrame, unseen: float, sums: DataFrame | None = None) -> DataFrame:
    """doc_id, lang, n_words, perplexity of each row; from part_sums, where they are given."""
    sums = part_sums(docs, model, unseen) if sums is None else sums
    heads = keyed(docs).select("doc_id", "lang", "_key", F.size(words_column(F.col("text"))).cast("long").alias("n_words"))
    # Repeated rows have one key: their sums come together, and are shared out again.
    heads = heads.groupBy("doc_id", "lang", "_key", "n_words").agg(F.count("*").alias("rows")).join(sums, "_key", "left")
    mean = F.coalesce("s", F.lit(0.0)) / F.col("rows") / F.col("n_words") + unseen
    out = heads.withColumn("perplexity", F.when(F.col("n_words") > 0, F.exp(-mean)))
    return out.select("doc_id", "lang", "n_words", "perplexity", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).drop("col")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_words, perplexity, bound, kept of every document."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(10)) == 0
    values, unseen = train(docs.select("doc_id", "text"), good.where(~held))
    sums = part_sums(docs, values, unseen)
    out = stored(perplexities(docs, values, unseen, sums), "kn-perplexity")
    forget(docs.sparkSession, values, sums)  # with all stored tables that the model is read from
    sample = out.join(good.where(held), "doc_id").where("perplexity is not null")
    overall = quantiles(sample.withColumn("lang", F.lit(""))).first()
    bounds = quantiles(sample).where(F.col("n") >= LEAST).select("lang", "bound")
    fallback = F.lit(float("inf") if overall is None else overall["bound"])
    bounds = stored(bounds, "kn-bounds")
    out = out.join(bounds, "lang", "left").withColumn("bound", F.coalesce("bound", fallback))
    return out.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("bound"), F.lit(False))).select("doc_id", "lang", "n_words", "perplexity", "bound", "kept")


def quantiles(sample: DataFrame, q: float = QUANTILE) -> DataFrame:
    """lang, bound, n: per language the largest perplexity of the class of nearly equal ones (1 in 10,000) that the quantile
    falls into, and the number of rows. Counts of classes are exact sums, so every run gives the same bound."""
    classes = sample.groupBy("lang", F.floor(F.log("perplexity") * 10_000).alias("k")).agg(F.count("*").alias("m"), F.max("perplexity").alias("top"))
    so_far = F.sum("m").over(Window.partitionBy("lang").orderBy("k"))
    ranked = classes.withColumns({"so_far": so_far, "n": F.sum("m").over(Window.partitionBy("lang"))})
    return ranked.where(F.col("so_far") >= F.ceil(q * F.col("n"))).groupBy("lang").agg(F.min("top").alias("bound"), F.first("n").alias("n"))
