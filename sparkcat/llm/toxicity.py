"""Toxicity: Levenshtein automata run over a lexicon trie, with context windows, and a logistic score.

The lexicon is learned from labelled training rows: all words whose document frequency among toxic rows is above that among
the others by a log-likelihood ratio of 2 ln(number of words tested) at least, where chance would give about one word. Each
distinct word of a document walks the trie of all terms while a Levenshtein automaton of the word runs along; what is
accepted is a term, perhaps misspelled (one edit from 5 letters on, two from 9, any letter). The automaton is parametric:
its states are the edit counts around the diagonal, its inputs say which of the letters there equal the trie's letter, and
its table is built once for one and for two edits. Few edits leave a piece of a term and most of its pairs of letters whole,
so it is exact to run along only those paths of the trie whose terms share these with the word. Common look-alikes (@ for a,
1 for i and so on) are folded first. Words that harmless training rows hold count only if exact.
Around each hit a window of words is scored for quotation (quotation marks, words of reporting) against abuse
(address in the second person, no quotation); both kinds of hits, exact and misspelled, are features of a logistic model.

Labels come from at most SAMPLE rows of each class (smallest hashes of doc_id) whose crc32(doc_id) mod 5 is not 0, a
documented bound for fitting, which also bounds the lexicon; every document's whole text is scored. Inputs of a score are
the text only.

Null, empty and very long texts are scored like others, those without words as texts without hits. Repeated rows are scored
alike; of labels that disagree the toxic one counts. Terms equally near go by the smaller text. Without labels of both
classes, as in an empty table, the lexicon is empty and every score is the prior 0.1. Extra columns pass through score()
untouched; only one that is called toxicity is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import GAP_SQL, bounded_ids, forget, kept, not_fold, stored

SAMPLE, WINDOW, LEAST_DF = 20_000, 6, 3
KEEP_WORDS = 100_000
EDGE = r"[\p{P}\p{S}]"
STRIP = re.compile(r"^[\W_]+|[\W_]+$")
FOLD = str.maketrans({"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"})
QUOTES = set("\"“”„«»‘’")
#: Words of reporting and of direct address, fixed values.
REPORTS = set("said says say wrote writes quote quoted quotes called calls reported report reports word words term terms article quoting sagte sagt schrieb zitat zitiert nannte wort dit écrit cité citation mot appelé dijo dice escribió cita citado palabra llamó".split())
ADDRESS = set("you your you're youre u ur yourself du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti tus usted ustedes vosotros".split())
FEATURES = 6


def neighbours(word: str) -> int:
    """Which pairs of neighbouring letters a word has, as bits; pairs may share a bit."""
    out, last = 0, -1
    for c in map(ord, word):
        if last >= 0:
            out |= 1 << (31 * last + c & 63)
        last = c
    return out


class Parametric:
    """The Levenshtein automaton for `most` edits, whatever the word: a state holds the edit counts at the 2 * most + 1
    places around the diagonal, an input tells which of the word's letters there equal the next letter read."""

    def __init__(self, most: int):
        self.most, self.width = most, 2 * most + 1
        start = tuple(abs(d) if d >= 0 else most + 1 for d in range(-most, most + 1))
        self.states, found = [start], {start: 0}
        self.table: list[list[int]] = []  # by state and input; -1: no way to accept any more
        for row in self.states:
            step = []
            for equal in range(1 << self.width):
                nxt = []
                for d in range(self.width):
                    up = row[d + 1] + 1 if d + 1 < self.width else most + 1
                    left = nxt[d - 1] + 1 if d else most + 1
                    nxt.append(min(up, left, row[d] + (not equal >> d & 1), most + 1))
                key = tuple(nxt)
                if min(key) > most:
                    step.append(-1)
                    continue
                if key not in found:
                    found[key] = len(self.states)
                    self.states.append(key)
                step.append(found[key])
            self.table.append(step)

    def edits(self, state: int, left: int) -> int:
        """Edits of the word in a state, with so many of its letters beyond the number read (or before, if negative)."""
        d = left + self.most
        return self.states[state][d] if 0 <= d < self.width else self.most + 1


AUTOMATA = {most: Parametric(most) for most in (1, 2)}


def trie(terms: Iterable[str], root: dict | None = None) -> dict:
    root = {} if root is None else root
    for t in terms:
        node = root
        for c in t:
            node = node.setdefault(c, {})
        node[""] = t
    return root


class Lexicon:
    """A trie of weighted terms and the automaton that walks it."""

    def __init__(self, terms: dict[str, float], fuzzy: list[str], harmless: frozenset[str] = frozenset()):
        self.terms, self.harmless = terms, harmless
        self.trie = trie(fuzzy)
        # One edit leaves the first or the last half of a term whole; two leave its first, last or middle third whole.
        # Lengths differ by the edits at most. By a word's length: the sizes of pieces, and the terms of each.
        self.parts: dict[int, tuple[set[int], set[int], dict]] = {}
        for t in fuzzy:
            most, n = self.edits(len(t)), len(t)
            k = n // (most + 1)
            for length in range(n - most, n + most + 1) if most else ():
                ends, middles, terms_of = self.parts.setdefault(length, (set(), set(), {}))
                ends.add(k)
                if most == 2:
                    middles.add(k)
                for key in ((0, t[:k]), (1, t[-k:]), (2, t[k : 2 * k]))[: most + 1]:
                    terms_of.setdefault(key, []).append((neighbours(t), t))
        # What is known of words met before: their hits, and, in two generations, those without one.
        self.hits: dict[str, tuple[str, int]] = {}
        self.plain: set[str] = set()
        self.older: set[str] = set()

    @staticmethod
    def edits(n: int) -> int:
        return 0 if n < 5 else 1 if n < 9 else 2

    def find(self, raw: str) -> tuple[str, int] | None:
        """The nearest term of a lower-case word and its distance; punctuation at its edges doesn't count."""
        return self.find_all({raw}).get(raw)

    def find_all(self, words: set[str]) -> dict[str, tuple[str, int]]:
        """The hits among some words. Each distinct word runs once while it is remembered."""
        hits, found, older = self.hits, {}, self.older
        for raw in words - self.plain:
            if raw in older:
                self.plain.add(raw)
                continue
            got = hits.get(raw)
            if got is None:
                word = raw if raw.isalpha() else STRIP.sub("", raw)
                got = (word, 0) if word in self.terms else self._search(word)
                if got is None:
                    self.plain.add(raw)
                    continue
                if len(hits) > KEEP_WORDS:
                    hits.clear()
                hits[raw] = got
            found[raw] = got
        if len(self.plain) > KEEP_WORDS:
            self.older, self.plain = self.plain, set()
        return found

    def _search(self, word: str) -> tuple[str, int] | None:
        if len(word) < 4:
            return None
        folded = word if word.isalpha() else word.translate(FOLD)
        if folded in self.terms:
            return folded, 1
        # A word that training met in harmless documents matches only exactly.
        return None if word in self.harmless else self.near(folded)

    def near(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its edits: the automaton runs along those paths of the trie that can end in one."""
        most = min(2, self.edits(len(word) + 2))
        part = self._part(word, most)
        if not part:
            return None
        table, equal, window = AUTOMATA[most].table, self._equal(word, most), (2 << 2 * most) - 1
        found = []
        for t in part:
            state = depth = 0
            for c in t:
                state = table[state][equal.get(c, 0) >> depth & window]
                if state < 0:
                    break
                depth += 1
            else:
                d = AUTOMATA[most].edits(state, len(word) - depth)
                if d <= self.edits(len(t)):
                    found.append((d, t))
        return min(found)[::-1] if found else None

    @staticmethod
    def _equal(word: str, most: int) -> dict[str, int]:
        """For each letter of a word, at which places it stands."""
        out: dict[str, int] = {}
        for i, c in enumerate(word):
            out[c] = out.get(c, 0) | 1 << i + most
        return out

    def _part(self, w: str, most: int) -> set[str]:
        """The terms of fitting length that share a whole piece with a word at nearly the same place, and enough pairs of
        letters: an edit takes two pairs and brings two at most."""
        n = len(w)
        if n not in self.parts:
            return set()
        ends, middles, terms_of = self.parts[n]
        keys = [key for k in ends for key in ((0, w[:k]), (1, w[-k:]))]
        keys += [(2, w[i : i + k]) for k in middles for i in range(max(0, k - 2), min(k + 3, n - k + 1))]
        lists = [terms_of[key] for key in keys if key in terms_of]
        if not lists:
            return set()
        mine, much = neighbours(w), 2 * most
        return {t for some in lists for m, t in some if (m & ~mine).bit_count() <= much and (mine & ~m).bit_count() <= much}

    def walk(self, word: str, most: int) -> tuple[str, int] | None:
        """Intersect the whole trie with the Levenshtein automaton of a word: what near() gives, without its index."""
        if not most:
            return None
        automaton, equal = AUTOMATA[most], self._equal(word, most)
        table, window = automaton.table, (1 << automaton.width) - 1
        found: tuple[int, str] | None = None
        stack = [(self.trie, 0, 0)]
        while stack:
            node, state, depth = stack.pop()
            for c, child in node.items():
                if c == "":
                    d = automaton.edits(state, len(word) - depth)
                    if d <= min(most, self.edits(len(child))) and (found is None or (d, child) < found):
                        found = (d, child)
                    continue
                nxt = table[state][equal.get(c, 0) >> depth & window]
                if nxt >= 0:
                    stack.append((child, nxt, depth + 1))
        return (found[1], found[0]) if found else None


def lexicon_of(model: dict) -> Lexicon:
    """The lexicon of a model; workers keep it, and what it remembers of words, from task to task."""
    return kept(("toxicity", model["id"]), lambda: Lexicon(model["terms"], model["fuzzy"], frozenset(model["harmless"])))


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Saturated evidence: exact abuse, exact quoted, misspelled abuse, misspelled quoted, density, addressed share."""
    raw = (text or "").lower().split()
    found = lexicon.find_all(set(raw))
    if not found:
        return [0.0] * FEATURES
    sums = [0.0] * 4
    hits = addressed = 0
    terms = lexicon.terms
    for i in [i for i, w in enumerate(raw) if w in found]:
        term, edits = found[raw[i]]
        low = max(0, i - WINDOW)
        window = raw[low : i + WINDOW + 1]
        before, after = window[: i - low + 1], window[i - low :]
        marks = any(c in QUOTES for c in raw[i]) or (any(w[0] in QUOTES for w in before) and any(w[-1] in QUOTES or w.rstrip(".,;!?")[-1:] in QUOTES for w in after))
        words = {w if w.isalpha() else STRIP.sub("", w) for w in window}
        quoted, direct = marks or not words.isdisjoint(REPORTS), not words.isdisjoint(ADDRESS)
        sums[(0 if edits == 0 else 2) + (1 if quoted and not direct else 0)] += terms[term] * (1.0 if edits == 0 else 0.5 / edits)
        hits += 1
        addressed += direct
    return [*(math.log1p(x) for x in sums), min(1.0, 20 * hits / max(len(raw), 1)), addressed / hits if hits else 0.0]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> list[float]:
    """Newton's method on a ridge-penalised logistic loss; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) / len(y) + penalty * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """The model: terms with weights, harmless words near to terms, and logistic weights. SAMPLE bounds its size."""
    spark = docs.sparkSession
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(not_fold("doc_id", 5, 0))
    ids = bounded_ids(known.where("toxic = 1"), "doc_id", SAMPLE).union(bounded_ids(known.where("toxic = 0"), "doc_id", SAMPLE))
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("toxic", "text"), "toxic-train")
    # Lower case, punctuation at a word's edges taken off, as features() does.
    words = F.array_distinct(F.transform(F.split(F.lower("text"), GAP_SQL), lambda w: F.regexp_replace(w, f"^{EDGE}+|{EDGE}+$", "")))
    df = rows.select("toxic", F.explode(words).alias("w")).where("length(w) > 2").groupBy("w").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
    totals = rows.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    t, n = totals["t"] or 0, totals["n"]
    if not t or t == n:
        forget(spark, rows)
        return {"id": "none", "terms": {}, "fuzzy": [], "harmless": [], "weights": [0.0] * FEATURES + [math.log(0.1 / 0.9)]}
    df = stored(df, "toxic-df")
    least = 2 * math.log(max(df.count(), 2))
    a, b = F.col("a").cast("double"), (F.col("n") - F.col("a")).cast("double")
    ll = lambda k, m, total: F.when(k > 0, k * F.log(k / (m * total))).otherwise(0.0)
    share = F.col("n") / F.lit(float(n))
    llr = 2 * (ll(a, share, float(t)) + ll(b, share, float(n - t)))
    odds = F.log((a + 0.1) / t) - F.log((b + 0.1) / (n - t))
    picked = df.where(F.col("a") >= LEAST_DF).select("w", llr.alias("llr"), odds.alias("odds")).where((F.col("llr") >= least) & (F.col("odds") > 1.5))
    terms = {r["w"]: min(r["odds"], 6.0) for r in picked.orderBy("w").collect()}
    shared_terms = spark.sparkContext.broadcast(terms)

    def near_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(shared_terms.value, list(shared_terms.value))
        for pdf in batches:
            yield pdf[[w not in lexicon.terms and lexicon.near(w) is not None for w in pdf["w"]]]

    # Of the words of harmless rows only those matter that would be taken for a term.
    harmless = df.where("a < 0.5 * n and n >= 2").select("w").mapInPandas(near_terms, "w string")
    model = {"terms": terms, "fuzzy": list(terms), "harmless": sorted(r["w"] for r in harmless.collect())}
    model["id"] = xxhash.xxh128_hexdigest(repr(model).encode("utf-8", "surrogatepass"))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = lexicon_of(shared.value)
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"], "x": [features(s, lexicon) for s in pdf["text"]]})

    got = rows.mapInPandas(run, "toxic int, x array<double>").toPandas()  # 2 * SAMPLE rows at most
    forget(spark, rows, df)
    x, y = np.array(got["x"].tolist()).reshape(len(got), FEATURES), got["toxic"].to_numpy(dtype=float)
    order = np.lexsort([*x.T, y])  # sums don't depend on the order in which tasks end
    return model | {"weights": fit_logistic(x[order], y[order])}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """docs with toxicity (0 to 1), over whole texts; all other columns stay as they are, in Arrow."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("toxicity")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, w = lexicon_of(shared.value), shared.value["weights"]
        for batch in batches:
            out = []
            for s in batch.column("text"):  # one text at a time as Python's own
                z = sum(a * b for a, b in zip(features(s.as_py(), lexicon), w, strict=False)) + w[-1]
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield batch.append_column("toxicity", pa.array(out, pa.float64()))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType())]))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels)
    out = score(docs.select("doc_id", "text").withColumn("held_out", ~not_fold("doc_id", 5, 0)), model)
    return out.select("doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
