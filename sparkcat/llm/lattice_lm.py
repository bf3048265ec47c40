"""LM scoring by subword lattices: the marginal probability of a text over all segmentations of its words.

A word's lattice has an arc for each piece of an existing vocabulary (a SentencePiece file, its path a parameter) that
matches at a position, single characters and, where the vocabulary lacks a character, its bytes. A forward recursion in
log space sums over all paths. The pieces' scores come from the file: it is a BPE file, whose scores are ranks, so they are
read as Zipf weights of the rank; STEPS expectation-maximisation steps (forward and backward) then fit them to the distinct
training words, each of which counts once, as a word that is new to the model is met once.

Training words are pieces too, with an arc over the whole word, absolutely discounted: with c its count, N all tokens, V the
distinct ones and D = n1 / (n1 + 2 n2) (of the numbers of words met once and twice), P(word) = max(c - D, 0) / N for that
arc plus D V / N times the marginal over the file's pieces. The end of a text is a token like any other. No piece spans
white space, so the marginal of a text is the product of those of its words and end; the score is its log10.

Corpus counts cover all training rows (crc32(doc_id as text) mod 7 is not 2) and are keyed by word. Each distinct word's
lattice is run once, whatever its frequency, words of one length together; documents meet words in one join of hashed
words, where a document's rows are summed before and after. The most frequent words, FREQUENT of them at most, travel as a
broadcast table instead.

Null and empty texts have the end token only. Very long texts and words are scored whole. Repeated rows score alike, one
row for each; a null doc_id is a training row's. Words of one frequency are treated alike. Extra columns are ignored,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, fmix64, forget, lower_ascii, not_fold, odd_constants, stored

STEPS, FREQUENT = 3, 200_000
KEEP_WORDS = 200_000
#: Words of up to LONG characters (with their mark) are run together by length, BATCH at a time; longer ones one by one.
LONG, BATCH = 64, 4000
#: Words are gathered to so many before they run.
GATHER = 50_000


class Pieces:
    """The vocabulary as hashes by piece length, with log weights."""

    def __init__(self, path: str, counts: np.ndarray | None = None):
        self.texts, start = vocabulary(path)
        self.longest = max(map(len, self.texts))
        start = np.exp(start)
        if counts is not None:  # expected counts; every piece keeps a little of its initial weight
            start = counts + 0.1 * start / start.sum() * len(start)
        self.log = np.log(start / start.sum())
        self.at = {t: i for i, t in enumerate(self.texts)}
        self.byte = np.array([self.at.get(f"<0x{b:02X}>", -1) for b in range(256)])
        self.bytes: dict[int, float] = {}
        self.hashed = _hashed(path)

    def by_bytes(self, c: int) -> float:
        """The log weight of a character spelled in bytes."""
        if (got := self.bytes.get(c)) is None:
            got = self.bytes[c] = float(sum(self.log[p] for p in self.byte[list(chr(c).encode("utf-8", "surrogatepass"))]))
        return got

    def lattices(self, codes: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each end position, the arcs (start, pieces, log weights) of words of one length, a row of code points each;
        a word without an arc has weight -inf there, piece -1."""
        rows, n = codes.shape
        out: list = [[] for _ in range(n + 1)]
        weights = np.append(self.log, -np.inf)
        mult, columns = odd_constants(33, self.longest), np.ascontiguousarray(codes.T)
        for i in range(n):
            h, alive = np.zeros(rows, np.uint64), np.arange(rows)
            for size in range(1, min(self.longest, n - i) + 1):
                # Only rows whose characters from i on begin some piece go on to longer ones.
                h = h + columns[i + size - 1][alive] * mult[size - 1]
                keys, ids = self.hashed[size]
                k = fmix64(h)
                at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                found = keys[at] == k
                h, alive = h[found], alive[found]
                met = ids[at[found]]
                if size == 1 or (met >= 0).any():
                    p = np.full(rows, -1)
                    p[alive] = met
                    w = weights[p]
                    if size == 1:  # characters that are no piece are spelled in bytes
                        for r in np.nonzero(p < 0)[0]:
                            w[r] = self.by_bytes(int(codes[r, i]))
                    out[i + size].append((i, p, w))
                if not len(alive):
                    break
        return out

    def run(self, words: list[str], expect: np.ndarray | None = None) -> np.ndarray:
        """Log marginals of marked words; with `expect`, the words' expected pieces are added to it."""
        out = np.empty(len(words))
        by_size: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_size.setdefault(len(w), []).append(k)
        for size, which in by_size.items():
            if size > LONG:
                for k in which:
                    out[k] = self.log_marginal(words[k]) if expect is None else self.expect(words[k], 1.0, expect)
                continue
            for a in range(0, len(which), BATCH):
                some = which[a : a + BATCH]
                codes = np.frombuffer("".join([words[k] for k in some]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(some), size).astype(np.uint64)
                out[some] = self._run(codes, expect)
        return out

    def _run(self, codes: np.ndarray, expect: np.ndarray | None) -> np.ndarray:
        rows, n = codes.shape
        arcs = self.lattices(codes)
        alpha = np.full((n + 1, rows), -np.inf)
        alpha[0] = 0.0
        for j in range(1, n + 1):
            v = np.stack([alpha[i] + w for i, _, w in arcs[j]])
            m = v.max(axis=0)
            alpha[j] = m + np.log(np.exp(v - m).sum(axis=0))
        if expect is not None:
            beta = np.full((n + 1, rows), -np.inf)
            beta[n] = 0.0
            for j in range(n, 0, -1):
                for i, p, w in arcs[j]:
                    x = beta[j] + w
                    ok = p >= 0
                    expect += np.bincount(p[ok], weights=np.exp(alpha[i] + x - alpha[n])[ok], minlength=len(expect))
                    beta[i] = np.logaddexp(beta[i], x)
        return alpha[n]

    def arcs(self, word: str) -> list[list[tuple[int, int, float]]]:
        """For each end position, the arcs (start, piece, log weight) of a marked word; piece -1 stands for bytes."""
        n, at, log = len(word), self.at, self.log
        out: list = [[] for _ in range(n + 1)]
        for i in range(n):
            single = False
            for j in range(i + 1, min(n, i + self.longest) + 1):
                p = at.get(word[i:j])
                if p is not None:
                    out[j].append((i, p, log[p]))
                    single |= j == i + 1
            if not single:
                out[i + 1].append((i, -1, sum(log[p] for p in self.byte[list(word[i].encode("utf-8", "surrogatepass"))])))
        return out

    def forward(self, word: str) -> tuple[list[float], list]:
        arcs = self.arcs(word)
        alpha = [0.0] + [-math.inf] * len(word)
        exp, log = math.exp, math.log
        for j in range(1, len(word) + 1):
            a = arcs[j]
            if len(a) == 1:
                alpha[j] = alpha[a[0][0]] + a[0][2]
            else:
                v = [alpha[i] + w for i, _, w in a]
                m = max(v)
                alpha[j] = m + log(sum([exp(x - m) for x in v])) if m > -math.inf else m
        return alpha, arcs

    def log_marginal(self, word: str) -> float:
        return self.forward(word)[0][-1]

    def expect(self, word: str, weight: float, into: np.ndarray) -> float:
        """Add a word's expected pieces; its log marginal."""
        alpha, arcs = self.forward(word)
        n, total = len(word), alpha[-1]
        beta = [-math.inf] * n + [0.0]
        exp = math.exp
        for j in range(n, 0, -1):
            b = beta[j]
            if b == -math.inf:
                continue
            for i, p, w in arcs[j]:
                x = b + w
                m = beta[i]
                beta[i] = x if m == -math.inf else (x + math.log1p(exp(m - x)) if x > m else m + math.log1p(exp(x - m)))
                if p >= 0:
                    into[p] += weight * exp(alpha[i] + x - total)
        return total


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    """The pieces and their initial log weights. Control pieces have none of their own."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    scores = np.array([sp.get_score(i) for i in range(len(texts))])
    ranks = np.argsort(np.argsort(-scores, kind="stable"), kind="stable")
    return texts, -np.log(ranks + 10.0)


@lru_cache(maxsize=2)
def _hashed(path: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length, the hashes of the code points of pieces and of beginnings of pieces, sorted, and the pieces (-1: a
    beginning only)."""
    texts = vocabulary(path)[0]
    at = {t: i for i, t in enumerate(texts)}
    by: dict[int, set[str]] = {}
    for t in texts:
        for n in range(1, len(t) + 1):
            by.setdefault(n, set()).add(t[:n])
    out = {}
    for n, starts in by.items():
        some = sorted(starts)
        codes = np.array([[ord(c) for c in t] for t in some], dtype=np.uint64)
        h = fmix64((codes * odd_constants(33, n)).sum(axis=1, dtype=np.uint64))
        order = np.argsort(h)
        out[n] = h[order], np.array([at.get(t, -1) for t in some])[order]
    return out


def marked(word: str) -> str:
    return "▁" + word


class WordKeys:
    """Signed 64-bit keys of words (0 is none's), remembered in two generations."""

    def __init__(self):
        self.seen: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def __call__(self, words: Iterable[str]) -> list[int]:
        if len(self.seen) > KEEP_WORDS:
            self.older, self.seen = self.seen, {}
        seen, older, out = self.seen, self.older, []
        for w in words:
            k = seen.get(w)
            if k is None:
                k = older.get(w)
                if k is None:
                    k = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 5)
                    k = (k - 2**64 if k >= 2**63 else k) or 1
                seen[w] = k
            out.append(k)
        return out


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches joined to GATHER rows or more, so that many words have one length."""
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= GATHER:
            yield pd.concat(held)
            held, n = [], 0
    if held:
        yield pd.concat(held)


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words of batches with their counts in training texts and in all texts."""
    for pdf in batches:
        train: Counter = Counter()
        rest: set = set()
        for text, held in zip(pdf["text"], pdf["held_out"], strict=True):
            words = WORD.findall(lower_ascii(text))
            rest.update(words) if held else train.update(words)
        words = [*train, *(rest - train.keys())]
        yield pd.DataFrame({"w": words, "c": [train[x] for x in words]})


def _expected(path: str, counts: np.ndarray | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(path, counts)
        into = np.zeros(len(pieces.texts))
        for pdf in _gathered(batches):
            pieces.run([marked(w) for w in pdf["w"]], into)
        used = np.nonzero(into)[0]
        yield pd.DataFrame({"piece": used, "n": into[used]})

    return run


def train(docs: DataFrame, path: str) -> tuple[DataFrame, int, int, int, float]:
    """word table (key, c, logp: log10 P by the model), and N, V, the end token's count and D. docs: text, held_out."""
    spark = docs.sparkSession
    counts = docs.select("text", "held_out").mapInPandas(_word_counts, "w string, c long").groupBy("w").agg(F.sum("c").alias("c"))
    counts = stored(counts, "lattice-words")
    ends = docs.where(~F.col("held_out")).count()
    known = counts.where("c > 0")
    total = known.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).first()
    n, v = (total["n"] or 0) + ends, total["v"] + (ends > 0)
    discount = total["n1"] / (total["n1"] + 2 * total["n2"]) if total["n1"] and total["n2"] else 0.5
    e = None
    for _ in range(STEPS if total["v"] else 0):
        expected = known.select("w").mapInPandas(_expected(path, e), "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()  # the vocabulary's size
        e = np.zeros(len(vocabulary(path)[0]))
        e[expected["piece"].to_numpy(dtype=int)] = np.round(expected["n"].to_numpy(dtype=float), 6)
    back = discount * v / n if n else 1.0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, word_keys = Pieces(path, e), WordKeys()
        for pdf in _gathered(batches):
            m = math.log(back) + pieces.run([marked(w) for w in pdf["w"]])
            c = pdf["c"].to_numpy()
            with np.errstate(divide="ignore"):
                own = np.log(np.where(c > 0, np.maximum(c - discount, 0.0), 0.0) / n) if n else np.full(len(c), -np.inf)
            yield pd.DataFrame({"key": word_keys(pdf["w"]), "c": c, "logp": np.logaddexp(own, m) / math.log(10)})

    table = stored(counts.mapInPandas(run, "key long, c long, logp double"), "lattice-table")
    forget(spark, counts)
    return table, n, v, ends, discount


def most_frequent(table: DataFrame, bound: int | None = None) -> DataFrame:
    """The words of the table from some frequency on, as many as there are within the bound."""
    bound = FREQUENT if bound is None else bound
    step = F.floor(16 * F.log("c"))
    total, least = 0, None
    for r in table.where("c > 0").groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect():  # some hundreds
        total += r["count"]
        if total > bound:
            break
        least = r["s"]
    return table.where(F.lit(False)) if least is None else table.where((F.col("c") > 0) & (step >= least))


def score(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("held_out", ~not_fold("doc_id", 7, 2))
    table, n, v, ends, discount = train(docs, path)
    frequent = most_frequent(table).toPandas().sort_values("key")
    shared = spark.sparkContext.broadcast([frequent[x].to_numpy() for x in ("key", "c", "logp")])
    scale = float(n + v + 1)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A head for each row (key 0), with the sums over its frequent words, and a row for each other word of it."""
        keys, cs, logs = shared.value
        base = np.log10((cs + 1) / scale)
        word_keys = WordKeys()
        for pdf in batches:
            for at in range(0, len(pdf), 200):
                part = pdf.iloc[at : at + 200]
                words = [Counter(WORD.findall(lower_ascii(t))) for t in part["text"]]
                k = np.array([x for w in words for x in word_keys(w)], dtype=np.int64)
                m = np.array([x for w in words for x in w.values()], dtype=np.int64)
                owner, size = np.repeat(np.arange(len(words)), [len(w) for w in words]), len(words)
                i = np.minimum(np.searchsorted(keys, k), max(len(keys) - 1, 0))
                here = keys[i] == k if len(keys) else np.zeros(len(k), bool)
                own, i, times, far = owner[here], i[here], m[here], ~here
                total = lambda o, w: np.bincount(o, weights=w, minlength=size)
                row, more = part["_row"].to_numpy(), [None] * int(far.sum())
                none = np.zeros(len(more))
                yield pd.DataFrame({
                    "_row": np.concatenate([row, row[owner[far]]]), "doc_id": pd.array([*part["doc_id"].astype("Int64"), *more], dtype="Int64"),
                    "held_out": pd.array([*part["held_out"], *more], dtype="boolean"), "key": np.concatenate([np.zeros(size, np.int64), k[far]]),
                    "m": np.concatenate([total(owner, m).astype(np.int64), m[far]]), "known": np.concatenate([total(own, times * (cs[i] > 0)), none]).astype(np.int64),
                    "base": np.concatenate([total(own, times * base[i]), none]), "lat": np.concatenate([total(own, times * logs[i]), none]),
                })

    # Rows are numbered before they are stored, and only read afterwards: a number is a row's own, also of equal rows.
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    rows = stored(numbered.mapInPandas(split, "_row long, doc_id long, held_out boolean, key long, m long, known long, base double, lat double"), "lattice-rows")
    far = rows.where("key <> 0").select("_row", "key", "m").join(table, "key").groupBy("_row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("m")).otherwise(0)).alias("far_known"),
        F.sum(F.col("m") * F.log10((F.col("c") + 1) / F.lit(scale))).alias("far_base"), F.sum(F.col("m") * F.col("logp")).alias("far_lat"),
    )
    end_base = math.log10((ends + 1) / scale)
    end_own = math.log10(max(ends - discount, 1e-9) / n) if n else -9.0
    more = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.where("key = 0").join(far, "_row", "left").select(
        "doc_id", "held_out", (F.col("m") + 1).alias("n_tokens"), (F.col("known") + more("far_known") + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + more("far_base") + end_base).alias("base_score"), (F.col("lat") + more("far_lat") + end_own).alias("score"),
    )
