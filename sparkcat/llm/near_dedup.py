"""MinHash near-dedup: universal hash minima, banding, signature estimate, full-set verification, star components.

A document's set holds its distinct 5-word shingles (words of the text with A-Z lowered); a text of 1-4 words is one
shingle; null, empty and blank texts have an empty set and link with nothing. Two documents link if
100 * |A & B| >= percent * |A | B|. A document's component is the smallest doc_id that links reach.

Shape of the job, and why it holds for hot groups:
* One pass over texts yields band keys, 120 signature bytes and a 128-bit digest of the set per document.
* Equal sets collapse by an aggregate on the digest, so copies (even a third of all rows) cost nothing afterwards. Each
  class of equal sets gets a number of its own; links, components and texts go by class.
* Buckets of at most SMALL members give their pairs inside the bucket; those whose signatures are far below the threshold
  (0.25, more than 6 standard deviations) are dropped, far fewer than banding itself may miss (1 in a million).
* Larger buckets first link members to a few pivots. For what those links leave apart, an exact prefix filter takes over:
  with shingles ordered from rare to frequent, two sets that link share one of the first 15 % (at 85) of theirs. Members
  that share such a shingle, again few as a rule, give pairs as above. Shingles that many members start with are the rest:
  those members are compared block against block, members outside the group's largest component against all: no pair rows,
  only links found. Blocks hold members of nearly one size, and meet only blocks of sizes that a link allows.
* Links are confirmed on full sets, built anew from the texts: texts shuffle in half the room of their sets. First each
  member is confirmed with its likest smaller partner; of the other pairs, only those that these links leave in different
  components are confirmed, so a large group of near copies costs a pair a member, not all its pairs.
* Components come from alternating large-star and small-star.

Rows that repeat a doc_id are documents with one id: each is linked by its own text, and has its own component. Null
doc_ids are kept, each its own component (null), and link nothing. Very long texts are compared whole. Of equal estimates
the smaller class serves as partner. Extra columns are ignored, whatever their names. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, WordHashes, fmix64, forget, lower_ascii, odd_constants, runtime_bloom, stored, word_hashes

K = 5
SMALL, BLOCK = 48, 256
#: At most so many shingles count as frequent (and are broadcast, some megabytes).
FREQUENT = 500_000
#: A pair at the threshold is estimated this far below it from 120 minima with a probability under 1e-10.
SLACK = 0.25
_HASHES = 120


def rows_of_bands(percent: int) -> int:
    """How many minima make a band; of 120, pairs at the threshold share no band in one case of a million or less."""
    return 5 if percent >= 85 else 4 if percent >= 80 else 3


def shingles(text: str | None, hashes: WordHashes, k: int = K) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's k-word shingles."""
    words = WORD.findall(lower_ascii(text))
    if not words:
        return np.empty(0, np.uint64)
    h = hashes(words)
    n = max(1, len(h) - k + 1)
    mult = odd_constants(11, k)
    out = np.full(n, np.uint64(len(h) if len(h) < k else k))
    for j in range(min(k, len(h))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n] * mult[j]
    return np.unique(fmix64(out))


def _sign(rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, a, b = word_hashes(), odd_constants(1, _HASHES), odd_constants(2, _HASHES)
        for pdf in batches:
            for at in range(0, len(pdf), 128):
                part = pdf.iloc[at : at + 128]
                sets = [shingles(t, hashes) for t in part["text"]]
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.nonzero(sizes)[0]
                digests = [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets]
                bands: list = [None] * len(sets)
                sketches: list = [None] * len(sets)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    minima = np.empty((len(full), _HASHES), dtype=np.uint64)
                    for j in range(_HASHES):
                        minima[:, j] = np.minimum.reduceat(flat * a[j] + b[j], starts)
                    # Multiply-shift: the high bits are universal; the low byte of a mixed minimum is the sketch.
                    sketch = (fmix64(minima) & np.uint64(255)).astype(np.uint8)
                    for n, i in enumerate(full):
                        bands[i] = [xxhash.xxh64_intdigest(minima[n, j : j + rows].tobytes(), j // rows) - 2**63 for j in range(0, _HASHES, rows)]
                        sketches[i] = sketch[n].tobytes()
                yield pd.DataFrame({"doc_id": part["doc_id"].array, "text_hash": part["text_hash"].array, "n_shingles": sizes, "digest": digests, "bands": bands, "sketch": sketches})

    return run


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = word_hashes()
    for pdf in batches:
        for at in range(0, len(pdf), 256):
            part = pdf.iloc[at : at + 256]
            yield pd.DataFrame({"rep": part["rep"].array, "members": [shingles(t, hashes).tobytes() for t in part["text"]]})


def _estimate(x: np.ndarray) -> np.ndarray:
    """Jaccard from the share of equal sketch bytes, corrected for chance."""
    return (x - 1 / 256) / (1 - 1 / 256)


def _small_pairs(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            left, right, like = [], [], []
            for members in pdf["members"]:
                ids = np.array([m["rep"] for m in members], dtype=np.int64)
                s = np.frombuffer(b"".join(m["sketch"] for m in members), dtype=np.uint8).reshape(len(ids), _HASHES)
                i, j = np.triu_indices(len(ids), 1)
                e = _estimate((s[i] == s[j]).mean(axis=1))
                ok = e >= least
                lo, hi = np.minimum(ids[i[ok]], ids[j[ok]]), np.maximum(ids[i[ok]], ids[j[ok]])
                left.append(lo), right.append(hi), like.append(e[ok])
            yield pd.DataFrame({"a": np.concatenate(left), "b": np.concatenate(right), "e": np.concatenate(like)})

    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    k = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * k >= percent * (len(x) + len(y) - k)


def _verify(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = word_hashes()
        for pdf in batches:
            ok, last, x = [], None, None
            for ta, tb in zip(pdf["ta"], pdf["tb"], strict=True):
                if ta != last:
                    last, x = ta, shingles(ta, hashes)
                ok.append(_linked(x, shingles(tb, hashes), percent))
            yield pdf.loc[np.array(ok, dtype=bool), ["a", "b"]]

    return run


def _near_pivot(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), _HASHES)
            y = np.frombuffer(b"".join(pdf["pivot_sketch"]), np.uint8).reshape(len(pdf), _HASHES)
            e = _estimate((x == y).mean(axis=1))
            ok = e >= least
            a, b = pdf["rep"][ok].to_numpy(), pdf["pivot"][ok].to_numpy()
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "e": e[ok]})

    return run


def _cross(percent: int):
    """Links between two blocks of one bucket, one per pair of components at most."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out, joined = [], set()
        if len(left) and len(right):
            sets = [np.frombuffer(x, np.uint64) for x in left["members"]]
            sizes = np.array([len(s) for s in sets])
            flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(flat, kind="stable")
            keys, first, count = np.unique(flat[order], return_index=True, return_counts=True)
            owner = owner[order]
            labels, ids = left["label"].to_numpy(), left["rep"].to_numpy()
            for rep, label, raw in zip(right["rep"], right["label"], right["members"], strict=True):
                s = np.frombuffer(raw, np.uint64)
                at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                at = at[keys[at] == s]
                n = count[at]
                total = int(n.sum())
                if not total:
                    continue
                take = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at], n)
                common = np.bincount(owner[take], minlength=len(sets))
                hit = np.nonzero((100 * common >= percent * (sizes + len(s) - common)) & (labels != label))[0]
                for i in hit:
                    if (key := (labels[i], label)) not in joined:
                        joined.add(key)
                        out.append((min(ids[i], rep), max(ids[i], rep)))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components (node, label: the smallest node) by alternating large-star and small-star.

    Each half-step takes a minimum per node (a partial aggregate) and a join back, so a node with very many
    neighbours is split like any skewed join. Every step is a stored table, which also cuts the lineage.
    """
    spark = edges.sparkSession
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = stored(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        forget(spark, e, least, large, low)
        now = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        e = nxt
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("label"))


def stars(found: DataFrame) -> DataFrame:
    """Components as links to their smallest node: they connect what the first links did, in fewer rounds from there."""
    return found.select(F.col("node").alias("a"), F.col("label").alias("b"))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    signed = stored(
        docs.mapInPandas(_sign(rows_of_bands(percent)), "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>, sketch binary"), "signed"
    )
    # A class for each set: its number, its smallest doc_id with a text, and its signature.
    classes = signed.where("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    classes = stored(classes.select(F.monotonically_increasing_id().alias("rep"), "digest", "first.*", "size", "bands", "sketch"), "classes")
    sketches = classes.select("rep", "sketch")
    busy = with_counts(classes.select("rep", F.explode("bands").alias("bucket")))
    small = pairs_of_small(busy, sketches, percent)
    hot = stored(busy.where(F.col("n") > SMALL), "hot")
    pivot_ids = hot.groupBy("bucket").agg(
        F.array_distinct(F.array(*[F.min_by("rep", F.xxhash64("rep", F.lit(i))) for i in range(4)])).alias("pivots")
    )
    pivots = stored(
        pivot_ids.select("bucket", F.explode("pivots").alias("pivot"))
        .join(sketches.select(F.col("rep").alias("pivot"), F.col("sketch").alias("pivot_sketch")), "pivot"), "pivots"
    )
    to_pivot = (
        hot.join(sketches, "rep").join(pivots, "bucket").where("rep <> pivot")
        .select("rep", "sketch", "pivot", "pivot_sketch").mapInPandas(_near_pivot(percent / 100), "a long, b long, e double")
    )
    pairs = stored(small.union(to_pivot).where("a <> b").groupBy("a", "b").agg(F.max("e").alias("e")), "pairs")

    # Only members of pairs and hot buckets need their texts again; a Bloom filter keeps the other texts out of the shuffle.
    needed = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).union(hot.select("rep")).distinct()
    needed = stored(needed.join(classes.select("rep", "doc_id", "text_hash"), "rep"), "needed").where(F.col("rep") >= 0)
    with runtime_bloom(spark):
        texts = docs.join(needed, ["doc_id", "text_hash"]).select("rep", "text")
        if signed.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
            texts = texts.groupBy("rep").agg(F.min("text").alias("text"))  # rows that repeat an id and a text
        texts = stored(texts, "texts")

    def confirmed(some: DataFrame) -> DataFrame:
        some = some.where(F.col("a") >= 0)
        both = some.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b")
        with runtime_bloom(spark):
            return stored(both.mapInPandas(_verify(percent), "a long, b long"), "links")

    likest = stored(pairs.groupBy("b").agg(F.max_by("a", F.struct("e", -F.col("a"))).alias("a")).select("a", "b"), "likest")
    links = confirmed(likest)
    found = components(links)

    def with_links_of(some: DataFrame, found: DataFrame) -> DataFrame:
        """Components after confirming those pairs whose ends are still in different ones."""
        label = lambda x: found.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}"))
        apart = some.select("a", "b").join(label("a"), "a", "left").join(label("b"), "b", "left")
        apart = stored(apart.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b"), "apart")
        if apart.limit(1).count():
            found = with_edges(confirmed(apart), found)
        forget(spark, apart)
        return found

    found = with_links_of(pairs.select("a", "b").join(likest, ["a", "b"], "left_anti"), found)
    if hot.limit(1).count():
        starts = prefixes(hot, found, classes, texts, percent)
        few = stored(pairs_of_small(starts, sketches, percent).select("a", "b").distinct(), "few")
        found = with_links_of(few, found)
        many = stored(starts.where(F.col("n") > SMALL), "many")
        if many.limit(1).count():
            found = with_edges(stored(hot_links(many, found, classes, texts, percent), "more"), found)
        forget(spark, starts, few, many)
    forget(spark, busy, hot, pivots, pairs, needed, texts, likest, links)
    # A component is named after the smallest doc_id of its classes.
    nodes = found.union(found.select("label", F.col("label").alias("l")).distinct()).toDF("rep", "label")
    nodes = stored(nodes.join(classes.select("rep", "doc_id"), "rep"), "nodes")
    names = nodes.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    names = nodes.select("rep", "label").join(names, "label").select("rep", "component_id")
    member = stored(classes.select("rep", "digest", "doc_id").join(names, "rep", "left").select("digest", F.coalesce("component_id", "doc_id").alias("component_id")), "member")
    forget(spark, classes, nodes, found)
    out = signed.select("doc_id", "n_shingles", "digest").join(member, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def with_counts(keyed: DataFrame) -> DataFrame:
    """bucket, rep, n of the members of buckets that have more than one, n their number; stored."""
    spark = keyed.sparkSession
    counts = stored(keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    busy = stored(keyed.join(counts, "bucket"), "busy")
    forget(spark, counts)
    return busy


def pairs_of_small(busy: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """a, b, e: pairs inside buckets of at most SMALL members whose signatures are not far below the threshold."""
    members = busy.where(F.col("n") <= SMALL).join(sketches, "rep").groupBy("bucket").agg(F.collect_list(F.struct("rep", "sketch")).alias("members"))
    return members.select("members").mapInPandas(_small_pairs(percent / 100 - SLACK), "a long, b long, e double")


def with_edges(links: DataFrame, found: DataFrame) -> DataFrame:
    """The components after further links (a stored table, which goes)."""
    out = components(stars(found).union(links)) if links.limit(1).count() else found
    forget(links.sparkSession, links)
    return out


def _token_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 2000):
            tokens, n = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["members"].iloc[at : at + 2000]]), return_counts=True)
            yield pd.DataFrame({"token": tokens.view(np.int64), "n": n})


def prefix(tokens: np.ndarray, frequent: np.ndarray, order: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set: by hash those that are not frequent, then the frequent ones from the rarest on. Two sets
    that link share one of so many: an order that is the same for all, and n - (what must be shared at least) + 1 of them."""
    n = len(tokens)
    at = np.minimum(np.searchsorted(frequent, tokens), max(len(frequent) - 1, 0))
    rank = np.where(frequent[at] == tokens, order[at], 0) if len(frequent) else np.zeros(n, np.int64)
    return tokens[np.lexsort((tokens, rank))[: n + (-percent * n) // 100 + 1]]


def prefixes(hot: DataFrame, found: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """bucket (a shingle), rep, n: which members of large buckets that hold several components start with which shingle."""
    spark = hot.sparkSession
    labelled = hot.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("label", "rep").alias("label"))
    apart = labelled.groupBy("bucket").agg((F.min("label") != F.max("label")).alias("apart")).where("apart").select("bucket")
    members = hot.join(apart, "bucket", "left_semi").select("rep").distinct()
    sets = stored(texts.join(members, "rep", "left_semi").mapInPandas(_sets, "rep long, members binary"), "sets")
    # A shingle is frequent from 1 / FREQUENT of all occurrences on, so there are at most FREQUENT of them.
    total = sets.agg(F.coalesce(F.sum(F.octet_length("members") / 8), F.lit(0))).first()[0]
    counts = sets.mapInPandas(_token_counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") >= max(SMALL, total / FREQUENT)).collect()
    tokens = np.array([r["token"] for r in rows], dtype=np.int64).view(np.uint64)
    by, n = np.argsort(tokens), np.array([r["n"] for r in rows], dtype=np.int64)
    shared = spark.sparkContext.broadcast((tokens[by], n[by]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, order = shared.value
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                first = [prefix(np.frombuffer(x, np.uint64), frequent, order, percent) for x in part["members"]]
                yield pd.DataFrame({"rep": np.repeat(part["rep"].to_numpy(), [len(x) for x in first]), "bucket": np.concatenate(first).view(np.int64)})

    out = with_counts(sets.mapInPandas(run, "rep long, bucket long"))
    forget(spark, sets)
    return out


def hot_links(hot: DataFrame, found: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links inside large groups (bucket, rep) between components that the links found so far leave apart.

    Sizes of two linked sets differ by the threshold's ratio at most. Members go by the step of their size on a scale of
    that ratio, cut into blocks; members outside the bucket's largest component meet blocks of their step and its two
    neighbours.
    """
    spark = hot.sparkSession
    labelled = stored(
        hot.join(found.withColumnRenamed("node", "rep"), "rep", "left").join(classes.select("rep", "size"), "rep")
        .select("bucket", "rep", F.coalesce("label", "rep").alias("label"), F.floor(F.log(F.col("size").cast("double")) / F.lit(-math.log(percent / 100) + 1e-9)).cast("int").alias("step")), "labelled"
    )
    sizes = labelled.groupBy("bucket", "label").agg(F.count("*").alias("m"))
    main = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("m", "label")).alias("main"), F.count("*").alias("k")).where("k > 1").select("bucket", "main")
    inside = stored(labelled.join(main, "bucket"), "inside")
    blocks = lambda c: F.greatest(F.ceil(F.sum(c) / F.lit(BLOCK)), F.lit(1)).cast("int")
    steps = stored(inside.groupBy("bucket", "step").agg(blocks((F.col("label") != F.col("main")).cast("int")).alias("rests"), blocks(F.lit(1)).alias("alls"), F.count_if(F.col("label") != F.col("main")).alias("others")), "steps")
    sets = texts.join(inside.select("rep").distinct(), "rep", "left_semi").mapInPandas(_sets, "rep long, members binary")
    inside = stored(inside.join(sets, "rep"), "members")
    cut = lambda k: F.pmod(F.xxhash64("rep"), F.col(k)).cast("int")
    # Steps that meet: those of the members outside (r_step) and of all (m_step).
    near = steps.where("others > 0").select("bucket", F.col("step").alias("r_step"), "rests", F.explode(F.array(*[F.col("step") + d for d in (-1, 0, 1)])).alias("m_step"))
    near = stored(near.join(steps.select("bucket", F.col("step").alias("m_step"), "alls"), ["bucket", "m_step"]), "near")
    side = lambda step, other, own, many: (
        near.select("bucket", F.col(step).alias("step"), F.col(other).alias("_other"), own, many)
    )
    rest = inside.where("label <> main").join(side("r_step", "m_step", "rests", "alls"), ["bucket", "step"])
    rest = rest.select("bucket", F.col("step").alias("rs"), F.col("_other").alias("ms"), cut("rests").alias("r"), F.explode(F.expr("sequence(0, alls - 1)")).alias("m"), "rep", "label", "members")
    every = inside.join(side("m_step", "r_step", "rests", "alls"), ["bucket", "step"])
    every = every.select("bucket", F.col("_other").alias("rs"), F.col("step").alias("ms"), F.explode(F.expr("sequence(0, rests - 1)")).alias("r"), cut("alls").alias("m"), "rep", "label", "members")
    every = every.select(*[F.col(c).alias(c) for c in every.columns])  # names of its own: both sides stem from one frame
    by = ["bucket", "rs", "ms", "r", "m"]
    return rest.groupBy(*by).cogroup(every.groupBy(*by)).applyInPandas(_cross(percent), "a long, b long").distinct()
