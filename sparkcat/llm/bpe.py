"""BPE encoding by backtracking over longest matches, and decoding by an offset table, for a word-end BPE vocabulary.

Text steps as the vocabulary file defines them: special tokens are cut out first, then NFC, white space runs to one space,
per-character lower case, then the file's split pattern and the byte alphabet. The result equals exact rank-order merging:
a token sequence is the encoding of a word exactly if every two neighbours are compatible, that is, if merging the pair's
own text gives just these two tokens again. The encoder takes, from left to right, the longest token that an Aho-Corasick
pass found at the position and that is compatible with the token before it; where none is, it steps back, and a position
found to be a dead end is not entered again, so the work is linear in the matches.

Null and empty texts have no tokens. Every row gives one row, those with a null doc_id too; repeated rows and ties are
encoded alike. Very long texts are encoded whole, their work linear in their length. Extra columns are ignored, whatever
their names; an empty table gives an empty result. Words already met are kept in a table of fixed size per worker (a
memory bound, not a cap: a word met again is encoded again). The vocabulary's path is a parameter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import kept

#: Below this character all versions of Unicode's tables in use agree on letters and digits.
LAST_COMMON = "\u0400"
#: Below this character NFC changes nothing and lower case goes by single characters. White space only parts words, so there
#: lower case does for a file whose steps are STEPS.
LAST_PLAIN = "\u0300"
STEPS = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
KEEP_WORDS, KEEP_PAIRS = 150_000, 300_000
#: So many rows at a time are taken out of an Arrow batch, one text at a time as Python's own.
ROWS = 200
#: Texts of up to so many units are merged by plain scans for the least rank, longer ones by a heap.
SHORT = 24
NEVER = (1 << 60, -1)


def byte_alphabet() -> list[str]:
    """The printable character for each byte, as byte-level vocabularies use: printable Latin-1 as it is, others from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordBpe:
    """An encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # What all special tokens start with: a text without it has none of them.
        self.special_start = os.path.commonprefix(list(self.special))
        # Of the library only what comes before the model, so that its own tables are not held beside these.
        library = Tokenizer.from_str(json.dumps({**spec, "model": {"type": "WordLevel", "vocab": {"": 0}, "unk_token": ""}, "added_tokens": [], "post_processor": None, "decoder": None}))
        self.normalize, self.presplit = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.last_plain = LAST_PLAIN if spec["normalizer"] == STEPS else ""
        # The same for lower-cased ASCII text, where the standard library has no need of Unicode's tables.
        ascii_split = self.split.pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")
        self.split_ascii = re.compile(ascii_split, re.ASCII) if self.last_plain and r"\p" not in ascii_split else None
        self.bytes = byte_alphabet()
        # A unit is one symbol before any merge: a byte's character, or one with the word end. Units are single characters here.
        self.end_unit = {c: chr(0xE000 + i) for i, c in enumerate(self.bytes)}
        self.rank = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[self.vocab[a], self.vocab[b]] = (r, self.vocab[a + b])
        self.units: dict[int, str] = {i: self._units(t) for t, i in self.vocab.items()}
        self.match = ahocorasick.Automaton()
        for i, u in self.units.items():
            self.match.add_word(u, (len(u), i))
        self.match.make_automaton()
        self.single = {u: i for i, u in self.units.items() if len(u) == 1}
        self.pairs: dict[int, bool] = {}  # by both ids in one number
        self.words: dict[str, bytes] = {}  # ids as 32-bit numbers
        self.older: dict[str, bytes] = {}  # the words kept before: those met again stay
        # The offset table: all token texts in one buffer, each after a space.
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        texts = [b""] * size
        for t, i in [*self.vocab.items(), *self.special.items()]:
            texts[i] = b" " + t.encode()
        self.offset = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        self.buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def _units(self, token: str) -> str:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return body[:-1] + self.end_unit.get(body[-1], body[-1])
        return token

    def merged(self, units: str) -> list[int]:
        """Exact merging in rank order, for the short texts of token pairs."""
        ids = [self.single[u] for u in units]
        if len(ids) <= SHORT:
            return self._merged_short(ids)
        nxt, prv, alive = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)], [True] * len(ids)
        heap = [(*self.rank[p], i) for i in range(len(ids) - 1) if (p := (ids[i], ids[i + 1])) in self.rank]
        heapq.heapify(heap)
        while heap:
            r, made, i = heapq.heappop(heap)
            j = nxt[i] if alive[i] else -1
            if j < 0 or self.rank.get((ids[i], ids[j])) != (r, made):
                continue
            ids[i], alive[j], nxt[i] = made, False, nxt[j]
            if nxt[i] >= 0:
                prv[nxt[i]] = i
            for a, b in ((prv[i], i), (i, nxt[i])):
                if a >= 0 and b >= 0 and (found := self.rank.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (*found, a))
        return [x for x, ok in zip(ids, alive, strict=True) if ok]

    def _merged_short(self, ids: list[int]) -> list[int]:
        get = self.rank.get
        ranks = [get(p, NEVER) for p in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) is not NEVER:
            i = ranks.index(least)
            ids[i : i + 2] = [least[1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), NEVER)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), NEVER)
        return ids

    def compatible(self, a: int, b: int) -> bool:
        """The pair-compatibility table, filled as pairs are met. a = -1: b stands alone at a word's start."""
        key = (a << 32) + b
        if (got := self.pairs.get(key)) is None:
            if len(self.pairs) > KEEP_PAIRS:
                self.pairs.clear()
            want = [b] if a < 0 else [a, b]
            got = self.pairs[key] = self.merged("".join(self.units[i] for i in want)) == want
        return got

    def encode_units(self, units: str) -> tuple[int, ...]:
        n = len(units)
        at: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for last, found in self.match.iter(units):
            at[last - found[0] + 1].append(found)  # matches come by their ends: the longest at a position is the last
        dead, path, pos, pick = set(), [], 0, 1
        pairs, compatible, before = self.pairs, self.compatible, -1
        while pos < n:
            options = at[pos]
            while pick <= len(options):
                length, token = options[-pick]
                if pos + length not in dead and ((ok := pairs.get((before << 32) + token)) or (ok is None and compatible(before, token))):
                    break
                pick += 1
            if pick <= len(options):
                path.append((pos, token, pick))
                pos, pick, before = pos + length, 1, token
            elif path:
                # Whether a position can be left depends on the token before it only through its last pair, and the first
                # token that reaches it by a valid path is the one of the only valid encoding of that prefix.
                dead.add(pos)
                pos, _, pick = path.pop()
                pick += 1
                before = path[-1][1] if path else -1
            else:
                return tuple(self.merged(units))
        return tuple(t for _, t, _ in path)

    def word(self, word: str, text: str | None = None) -> bytes:
        """The ids of a word, as 32-bit numbers; text: the same in the byte alphabet, if known."""
        got = self.words.get(word)
        if got is None:
            if len(self.words) > KEEP_WORDS:
                # Emptied in place, as encode() holds on to the table.
                self.older = dict(self.words)
                self.words.clear()
            got = self.older.get(word)
            if got is None:
                text = text or "".join([self.bytes[b] for b in word.encode()])
                got = np.array(self.encode_units(text[:-1] + self.end_unit[text[-1]] if self.end else text), dtype=np.int32).tobytes()
            self.words[word] = got
        return got

    def encode(self, text: str | None) -> list[int]:
        return self.encode_array(text).tolist()

    def encode_array(self, text: str | None) -> np.ndarray:
        out: list[bytes] = []
        if not text:
            return np.empty(0, np.int32)
        parts = self.special_split.split(text) if self.special_split and self.special_start in text else [text]
        word, words = self.word, self.words
        for part in parts:
            if part in self.special:
                out.append(np.int32(self.special[part]).tobytes())
            elif self.split_ascii and part.isascii():
                out += [words[w] if w in words else word(w) for w in self.split_ascii.findall(part.lower())]
            elif part and (last := max(part)) >= LAST_COMMON:  # newer letters: the library's tables of characters decide
                out += [self.word("\0" + piece, piece) for piece, _ in self.presplit(self.normalize(part))]
            elif part:
                out += [words[w] if w in words else word(w) for w in self.split.findall(part.lower() if last < self.last_plain else self.normalize(part))]
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """Token texts joined by spaces, as UTF-8, gathered from the buffer at the tokens' offsets."""
        if not len(ids):
            return b""
        starts = self.offset[ids]
        sizes = self.offset[ids + 1] - starts
        ends = np.cumsum(sizes)
        return self.buffer[np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)].tobytes()[1:]


def load(path: str) -> WordBpe:
    return kept(("bpe", path), lambda: WordBpe(path))


def _run(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        texts = [str(i) for i in range(len(bpe.offset))]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = []
                for text in part.column("text"):
                    ids = bpe.encode_array(text.as_py())
                    if digests:
                        rows.append((len(ids), hashlib.sha256(" ".join([texts[i] for i in ids.tolist()]).encode()).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
                    else:
                        rows.append((len(ids), ids))
                kinds = [pa.int64(), pa.string(), pa.string()] if digests else [pa.int64(), pa.list_(pa.int32())]
                names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["n_tokens", "token_ids"]
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *cols], ["doc_id", *names])

    return run


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and token_ids of every document."""
    return docs.select("doc_id", "text").mapInArrow(_run(path, False), "doc_id long, n_tokens long, token_ids array<int>")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text."""
    return docs.select("doc_id", "text").mapInArrow(_run(path, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
