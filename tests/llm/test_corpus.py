"""Corpus operators against brute force, round trips and held-out labels, with the edge cases each must handle."""

import base64
import gzip
import hashlib
import json
import math
import re
import struct
import time
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

import corpus_pipeline
from sparkcat.llm import bpe, common, fingerprints, html_text, kneser_ney, lattice_lm, mixing, near_dedup, quality_rules, queries, toxicity, warc

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "der alte mann und das meer " * 4000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, label string, path string, _key string"


def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    base = " ".join(f"w{i}" for i in range(80))
    near = base.replace("w40", "x40")
    texts = [None, "", " \n\t ", "one", "one", "a b c d", "a b c d e", base, base, near, base.upper(), LONG, "Ünïcödé 日本 𝒳 " * 30]
    rows = [(i, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else "s", 0, "x", "y", "l", "p", "k") for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, base, "en", "s", 0, "x", "y", "l", "p", "k"), (None, None, None, None, None, "x", "y", "l", "p", "k")]
    return spark.createDataFrame(rows, DOCS)


def none(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def sets_of(text):
    w = WORD.findall((text or "").translate(LOW))
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows, percent=85):
    sets = {i: sets_of(t) for i, t in rows}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while True:
        new = dict(label)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            return sets, label
        label = new


@pytest.mark.parametrize("small,block", [(48, 256), (1, 3)])
def test_near_duplicates(spark, monkeypatch, small, block):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    docs = documents(spark)
    got = near_dedup.near_duplicates(docs).collect()
    sets, label = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {i: (len(s), label[i], label[i] == i) for i, s in sets.items()}


def test_near_duplicates_edges(spark):
    got = near_dedup.near_duplicates(edge(spark)).collect()
    assert len(got) == edge(spark).count() and near_dedup.near_duplicates(none(spark)).count() == 0
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert [by[i]["n_shingles"] for i in (0, 1, 2, 3, 5, 6)] == [0, 0, 0, 1, 1, 1]
    assert [by[i]["component_id"] for i in (0, 1, 2, 3, 4, 7, 8, 9, 10)] == [0, 1, 2, 3, 3, 7, 7, 7, 7]
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)


def test_prefixes_miss_no_link():
    """Any two sets that link share a shingle of their prefixes, whatever is frequent."""
    rng = np.random.default_rng(11)
    for percent in (80, 85, 95):
        for _ in range(300):
            a = np.unique(rng.integers(1, 10_000, rng.integers(1, 60)).astype(np.uint64))
            b = np.unique(np.concatenate([rng.choice(a, max(1, int(len(a) * rng.uniform(0.8, 1))), replace=False), rng.integers(1, 10_000, rng.integers(0, 8)).astype(np.uint64)]))
            frequent = np.unique(rng.choice(a, len(a) // 2 + 1))
            order = rng.integers(48, 60, len(frequent))
            if near_dedup._linked(a, b, percent):
                assert len(np.intersect1d(near_dedup.prefix(a, frequent, order, percent), near_dedup.prefix(b, frequent, order, percent)))


def test_a_large_bucket_of_unlinked_members(spark):
    """Texts that share half of their words, in one bucket by force: no pairs are made, and the two that link are found."""
    common = " ".join(f"c{i}" for i in range(60))
    text = F.concat(F.lit(common), F.lit(" "), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: F.concat(F.lit("u"), (F.col("doc_id") * 100 + i).cast("string"))), " "))
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("t")).withColumn("text", text).select("doc_id", "text")
    docs = docs.union(docs.where("doc_id in (17, 400)").select((F.col("doc_id") + 30_000).alias("doc_id"), F.concat("text", F.lit(" end")).alias("text")))
    classes = docs.select(F.col("doc_id").alias("rep"), F.lit(116).alias("size"))
    hot = docs.select(F.lit(1).cast("long").alias("bucket"), F.col("doc_id").alias("rep"), F.count("*").over(Window.partitionBy(F.lit(1))).alias("n"))
    none = spark.createDataFrame([], "node long, label long")
    starts = near_dedup.prefixes(hot, none, classes, docs.withColumnRenamed("doc_id", "rep"), 85)
    assert starts.count() < 100 and {r["rep"] for r in starts.collect()} == {17, 400, 30_017, 30_400}


@pytest.mark.parametrize("small,block", [(48, 256), (1, 2)])
def test_rows_that_repeat_an_id_keep_the_links_of_each_text(spark, monkeypatch, small, block):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    base = [f"w{i}" for i in range(100)]
    text = " ".join(base)
    near, far = " ".join([*base[:50], "x", *base[51:]]), " ".join(f"v{i}" for i in range(60))
    rows = [(1, near), (5, "short text"), (5, text), (5, text), (7, far), (3, far), (5, far), (9, "short text"), (-(2**63), "short text"), (8, text.upper())]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(1, 1), (5, -(2**63)), (5, 1), (5, 1), (7, 3), (3, 3), (5, 3), (9, -(2**63)), (-(2**63), -(2**63)), (8, 1)]
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == sorted(want)


def test_near_duplicates_at_80_percent(spark):
    base = [f"w{i}" for i in range(204)]  # 200 shingles
    edited = lambda n: " ".join(["x" if i in range(2, 2 + 5 * n, 5) else w for i, w in enumerate(base)])
    docs = spark.createDataFrame([(0, " ".join(base)), (1, edited(4)), (2, " ".join(base[:100]))], "doc_id long, text string")
    alike = 100 * len(sets_of(edited(4)) & sets_of(" ".join(base))) / len(sets_of(edited(4)) | sets_of(" ".join(base)))
    assert 80 <= alike < 85
    assert [sorted(r["component_id"] for r in near_dedup.near_duplicates(docs, p).collect()) for p in (80, 85)] == [[0, 0, 2], [0, 1, 2]]


def test_components_of_a_long_path(spark):
    edges = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert {r["label"] for r in near_dedup.components(edges).collect()} == {0}


def test_bpe_equals_library(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("word_bpe_49k.json")
    t, own = Tokenizer.from_file(path), bpe.load(path)
    texts = [r["text"] for r in documents(spark).collect()] + ["", "<|endoftext|> a<|startoftext|>b", "İSTANBUL ΣΑΣ ½ Ⅷ é \x85y\x1cz don't we'll", "aaaa" * 500, "日本語 𝒳 👩‍👩‍👧"]
    texts += ["".join(chr(c) for c in range(s, s + 0x400) if not 0xD800 <= c < 0xE000) for s in range(0, 0x20000, 0x800)]
    for x in texts:
        ids = t.encode(x, add_special_tokens=False).ids
        assert own.encode(x) == ids
        assert own.decode(np.array(ids, dtype=np.int64)).decode() == t.decode(ids, skip_special_tokens=False)
    got = bpe.encode_digests(edge(spark), path)
    assert got.count() == edge(spark).count() and bpe.encode_digests(none(spark), path).count() == 0
    assert bpe.encode_documents(edge(spark), path).where("size(token_ids) <> n_tokens").count() == 0


def test_bpe_plain_text_skips_the_normalizer(monkeypatch):
    """Below U+0300 lower case alone gives the library's tokens, at every character."""
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("word_bpe_49k.json")
    t, own = Tokenizer.from_file(path), bpe.WordBpe(path)
    monkeypatch.setattr(own, "normalize", None)
    for c in map(chr, range(0x300)):
        for x in (c, f"A{c}{c}b", f"!{c}?", f"1{c}2", f"\xc9{c}\xea", f"it'{c}s '{c}", f"x {c} {c}Y"):
            assert own.encode(x) == t.encode(x, add_special_tokens=False).ids


def test_bpe_other_steps_go_by_the_file(tmp_path):
    """A file that keeps capitals apart is not lower-cased."""
    from tokenizers import Tokenizer

    spec = json.load(open(queries.tokenizer_file("word_bpe_49k.json"), encoding="utf-8"))
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(spec | {"normalizer": {"type": "NFC"}}), encoding="utf-8")
    t, own = Tokenizer.from_file(str(path)), bpe.WordBpe(str(path))
    for x in ("Don't SHOUT 12 times", "<|endoftext|>", "\xc9t\xe9  OK", "a\tB"):
        assert own.encode(x) == t.encode(x, add_special_tokens=False).ids


def test_warc_round_trip_with_copies(spark):
    rows = [(1, "u", "<p>a</p>\r\n\r\nWARC/1.1\r\n"), (2, "u\r\nX: y", "same ü"), (3, "v", "same ü"), (4, None, None), (5, "w", ""), (9, "w", "same ü"), (9, "w", "same ü"), (10, "w", "x" * 300_000), (11, "w", "\r\n\r\n"), (12, "w", "a\r\n\r\n\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "page_id long, url string, html string, id string, record_type string, payload_bytes int")
    got = warc.round_trip(pages).collect()
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), i)
    want = sorted((i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), "response" if best[h or ""] == i else "revisit", best[h or ""] if best[h or ""] != i else -1) for i, _, h in rows)
    assert sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], -1 if r["refers_to"] is None else r["refers_to"]) for r in got) == want
    nulls = spark.createDataFrame([(None, "u", "a"), (None, "u", "a")], "page_id long, url string, html string")
    assert [r["record_type"] for r in warc.round_trip(nulls).collect()] == ["response"] * 2 and warc.round_trip(pages.limit(0)).count() == 0


def foreign(kind, rid, date, block, more="", content="application/http; msgtype=response"):
    """A record as another program may write it: WARC/1.0, other order and case of fields, a gzip member of its own."""
    head = f"WARC/1.0\r\ncontent-length: {len(block)}\r\nWARC-Type: {kind}\r\nWARC-Date: {date}\r\nWARC-Record-ID: <urn:x:{rid}>\r\nContent-Type: {content}\r\nWARC-Target-URI: http://a.b/{rid}{more}\r\n\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n")


def test_warc_of_another_program_is_resolved(spark, tmp_path):
    """Revisits that came in, copies, binary payloads, and records of other kinds."""
    http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n"
    body = b"\xff\x00binary\r\n\r\nWARC/1.1\r\n\r\n" * 3
    digest = f"\r\nWARC-Payload-Digest: sha1:{warc.base32_sha1(body)}"
    lost = f"\r\nWARC-Payload-Digest: sha1:{warc.base32_sha1(b'gone')}\r\nWARC-Refers-To: <urn:x:gone>"
    records = [
        foreign("warcinfo", "i", "2020-01-01T00:00:00Z", b"software: other", content="application/warc-fields"),
        foreign("response", "b", "2020-01-03T00:00:00Z", http % len(body) + body), foreign("response", "a", "2020-01-02T00:00:00Z", http % len(body) + body),
        foreign("revisit", "c", "2020-01-04T00:00:00Z", http % len(body), digest), foreign("revisit", "d", "2020-01-05T00:00:00Z", b"", lost),
        foreign("request", "e", "2020-01-02T00:00:00Z", b"GET / HTTP/1.1", "\r\nWARC-Concurrent-To: <urn:x:a>", "application/http; msgtype=request"), foreign("resource", "f", "2020-01-06T00:00:00Z", body, content="image/png"),
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.warc.gz").write_bytes(b"".join(records[:4]))
    (tmp_path / "in" / "y.warc.gz").write_bytes(b"".join(records[4:]))
    warc.deduplicated(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out")
    got = {r["uri"][-1]: r for r in warc.read(spark, f"file://{tmp_path}/out").collect()}
    assert {k: r["record_type"] for k, r in got.items()} == {"a": "response", "b": "revisit", "c": "revisit", "d": "revisit", "e": "request", "f": "revisit"}
    assert bytes(got["a"]["payload"]) == body and got["a"]["date"] == "2020-01-02T00:00:00Z" and bytes(got["e"]["payload"]) == b"GET / HTTP/1.1"
    assert {got[k]["refers_to_id"] for k in "bcf"} == {got["a"]["record_id"]} and got["d"]["refers_to_id"] == "<urn:x:gone>"
    assert {got[k]["payload_bytes"] for k in "abcf"} == {len(body)} and f"warc-concurrent-to: {got['a']['record_id']}" in got["e"]["fields"]
    assert len({r["record_id"] for r in got.values()} | {"<urn:x:a>"}) == 7


def test_plain_warc_files(spark, tmp_path):
    http, bodies = b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\n", [b"a\r\n\r", b"same", b"same", b"\r\n\r\n"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.warc").write_bytes(b"".join(gzip.decompress(foreign("response", i, f"2020-01-0{i + 1}T00:00:00Z", http + x)) for i, x in enumerate(bodies)))
    assert sorted(bytes(r["payload"]) for r in warc.read(spark, f"file://{tmp_path}/in", compressed=False).collect()) == sorted(bodies)
    warc.deduplicated(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out", compressed=False)
    assert sorted((r["uri"][-1], r["record_type"]) for r in warc.read(spark, f"file://{tmp_path}/out").collect()) == [("0", "response"), ("1", "response"), ("2", "revisit"), ("3", "response")]


def test_warc_damage_is_an_error(spark, tmp_path):
    whole = gzip.decompress(foreign("response", "a", "2020-01-02T00:00:00Z", b"HTTP/1.1 200 OK\r\n\r\nabc", "\r\nWARC-Payload-Digest: sha1:" + warc.base32_sha1(b"abc")))
    for name, data in (("short", whole[:-6]), ("long", whole.replace(b"abc", b"abcd")), ("other", whole.replace(b"abc", b"abd")), ("no", b"x" + whole)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.gz").write_bytes(gzip.compress(data))
        with pytest.raises(Exception, match="WARC|digest"):
            warc.read(spark, f"file://{tmp_path}/{name}").collect()


def test_fingerprints(spark):
    docs = documents(spark)
    got = {r["doc_id"]: r for r in fingerprints.neighbours(docs, 5).collect()}
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        e = fingerprints.edited(t, nxt)
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprints.fingerprint(t), fingerprints.fingerprint(e))
    long = [r for r in got.values() if r["n_chars"] > 300]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.95 * len(long)
    assert fingerprints.neighbours(edge(spark)).count() == edge(spark).count() and fingerprints.neighbours(none(spark)).count() == 0
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    assert fingerprints.neighbours(one).first()["near_next"] == 1.0


@pytest.mark.parametrize("buckets", [1, 2, 5])
def test_the_next_document_with_null_and_repeated_ids(spark, buckets):
    """Order: falling doc_id, nulls last, ties by text; the first follows the last."""
    rows = [(None, "null b"), (None, "null a"), (5, "five b"), (5, "five a"), (7, "seven"), (1, "one"), (2, None), (9, "nine" * 30), (9, "nine" * 30)]
    got = fingerprints.neighbours(spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, bucket string, copy string"), buckets).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for k, (i, t) in enumerate(order):
        e = fingerprints.edited(t, order[(k + 1) % len(order)][1])
        want.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)


def plain_signature(text):
    """A signature in plain integers: number the k-mers, deal them into bins, hash each bin's two smallest in text order."""
    mask, k = 2**64 - 1, fingerprints.K

    def mix(x):
        for c in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ x >> 33) * c & mask
        return x ^ x >> 33

    mult = [xxhash.xxh64_intdigest(f"21:{i}") | 1 for i in range(k)]
    h = [mix(sum(ord(c) * m for c, m in zip(text[i : i + k], mult, strict=True)) & mask) for i in range(len(text) - k + 1)] if len(text) >= k else [xxhash.xxh64_intdigest(text.encode("utf-32-le"))]
    seen, bins = Counter(), {}
    for at, x in enumerate(h):
        rank = mix(((x + seen[x] * 0xD6E8FEB86659FD93) & mask) * 0x9E3779B97F4A7C15 & mask)
        seen[x] += 1
        bins.setdefault(rank & 63, []).append((rank >> 6, at))
    out = [0] * fingerprints.BINS
    for b, members in bins.items():
        picked = sorted(at for _, at in sorted(members)[: fingerprints.TUPLE])
        first, last = h[picked[0]], h[picked[-1]]
        out[b] = mix((first * 3 + mix(last) + (len(members) > 1)) & mask) >> 32 | 1
    return out


def test_fingerprints_by_brute_force(spark):
    """The query's signatures and likenesses against plain integers."""
    docs = documents(spark).where("n_chars < 3000").limit(60)
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.neighbours(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()}
    like = lambda x, y: 1.0 if not any(x) and not any(y) else sum(a == b for a, b in zip(x, y, strict=True) if a or b) / sum(1 for a, b in zip(x, y, strict=True) if a or b)
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        own, other, edited = plain_signature(t), plain_signature(nxt), plain_signature(t[: len(t) - half] + nxt[:half])
        assert got[i]["fingerprint"] == "".join(f"{x:08x}" for x in own) and got[i]["edited_fingerprint"] == "".join(f"{x:08x}" for x in edited)
        assert math.isclose(got[i]["near_edited"], like(own, edited)) and math.isclose(got[i]["near_next"], like(own, other))


def test_fingerprint_follows_order():
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    a, small = " ".join(words), " ".join(words[:200] + ["zz"] + words[200:])
    blocks = [words[i : i + 20] for i in range(0, 400, 20)]
    shuffled = " ".join(w for i in rng.permutation(len(blocks)) for w in blocks[i])
    like = lambda x, y: fingerprints.likeness(fingerprints.signature(x), fingerprints.signature(y))
    assert like(a, a) == 1 and like(a, small) > 0.9 and 0.2 < like(a, shuffled) < 0.8 and like("", "") == 1 and like("", a) == 0


def test_html(spark):
    page = "<body><header>Site</header><div class='menu'>m</div><main class='c1'><article><header><h1>T</h1><p>by</p></header><p>a&eacute;\n <b>b</b><br>c<p>d<div class='comments'><p>bad</p></div><aside>x</aside><ul><li>one<li>two</ul></article></main><footer>f"
    assert html_text.main_text(html_text.parse(page), None) == "T\naé b c\nd\none\ntwo"
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    import html

    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S).group(1)
        want = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r["page_id"]]["text"] == "\n".join(b for b in want if b)
    odd = spark.createDataFrame([(1, None, None), (2, "", ""), (3, "x", "plain <"), (3, "x", "plain <"), (None, "http://a.b/c", "<p>hi</p>" * 20_000)], pages.schema)
    assert sorted(r["n_chars"] for r in html_text.extract(odd).collect()) == [0, 0, 7, 7, 59999] and html_text.extract(odd.limit(0)).count() == 0
    clashing = odd.selectExpr("*", "'h' as host", "'p' as path", "'t' as text", "1 as n_chars", "2 as votes")
    assert sorted(r["n_chars"] for r in html_text.extract(clashing).collect()) == [0, 0, 7, 7, 59999]


@pytest.mark.parametrize("attributes", ["style='overflow:hidden'", "data-id='menu'", "data-role='form'", "title='a hidden gem'", "class='content with-sidebar'", "class='post no-comments'", "title=it's", "data-x='a>b'"])
def test_html_keeps_articles_whatever_other_attributes_say(attributes):
    assert html_text.main_text(html_text.parse(f"<body><p>x</p><div {attributes}><p>hello world</p></div></body>"), None) == "hello world"


@pytest.mark.parametrize("attributes", ["hidden", "style='color:red; display: none'", "class=sidebar", "class='x site-footer'", "class=siteFooter", "id=comments", "class='ad-slot'", "role=navigation", "aria-hidden='true'"])
def test_html_drops_what_names_itself(attributes):
    assert html_text.main_text(html_text.parse(f"<body><p>x</p><div {attributes}><p>hello world</p></div></body>"), None) == "x"


def test_html_forms_headers_and_several_articles():
    text = lambda s: html_text.main_text(html_text.parse(s), None)
    assert text("<body><form action=x><div><p>long text of a page</p><input name=q><label>L</label><button>go</button></div></form><form><p>sub</p><input></form>") == "long text of a page"
    assert text("<div class='post'><header><h1>Title</h1><p>by</p></header><p>text</p></div>") == "Title\ntext"
    assert text("<article><p>one</p></article><article><p>two two</p></article>") == "one\ntwo two"
    assert text("<html><head><title>t</title><meta x><body><p>no end of head") == "no end of head"
    assert text("<p>a < b &amp; c</p>") == "a < b & c"


@pytest.mark.parametrize("source", [
    "<p>hello</p><img " + 'a="b" ' * 1_700_000, '<p>hello</p><img a="' + "b " * 5_000_000, "<p>hello</p>" + '<a b="' * 400_000, "<p>hello</p>" + "<a b='c\">" * 100_000,
    "<p>hello</p>" + "<div>" * 50_000, "<div>" * 30_000 + "<p>hello</p></div>" * 30_000, "<b>" * 30_000 + "<p>hello" * 30_000, "<p>hello</p>" + "<!--" * 100_000, "<p>hello</p>" + "<section>" * 20_000 + "</section></i>" * 20_000,
])
def test_html_takes_time_in_proportion(source):
    """Cut-off tags, quotation marks that never close, and deep nesting, each of which could cost a square or worse."""
    began = time.process_time()
    assert html_text.main_text(html_text.parse(source), None).startswith("hello")
    assert time.process_time() - began < 5


def test_consensus_path_wins_over_a_pages_own():
    big = "<aside></aside><div class='x1'><p>" + "long side text " * 50 + "</p></div><div class='post-12'><p>real</p></div>"
    page = html_text.parse(f"<body>{big}</body>")
    assert html_text.main_text(page, "/body/div.post-") == "real" and "long side" in html_text.main_text(page, None)


def quality_brute(t):
    t = t or ""
    w = WORD.findall(t)
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    cover = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover), n < 50 or 100 * len(cover) > 50 * n


def test_quality_rules(spark):
    lab = spark.read.parquet(f"{DATA}/labels.parquet")
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for docs in (documents(spark), edge(spark).drop("score", "kept")):
        for r in quality_rules.quality_rules(docs, lab).collect():
            assert tuple(r[c] for c in cols) == quality_brute(r["text"])
            assert not (r["kept"] and r["base_failed"])
    got = quality_rules.quality_rules(documents(spark), lab).join(lab, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"))
    share = {r["quality"]: r["k"] for r in got.collect()}
    assert share[1] > 0.95
    assert quality_rules.quality_rules(none(spark), labels(spark)).count() == 0
    assert quality_rules.quality_rules(edge(spark), labels(spark)).where("kept = base_failed").count() == 0


def test_quality_rules_reject_labelled_junk(spark):
    """Also of the junk that passes the base rules, and without losing trusted documents."""
    docs, lab = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    got = quality_rules.quality_rules(docs.select("doc_id", "text"), lab).join(lab, "doc_id").where("not base_failed")
    share = {r["quality"]: r["k"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert share[0] < 0.05 and share[1] > 0.99


def spark_hash(*values):
    """xxhash64 of Spark: each value's hash seeds the next."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed)
    return seed - 2**64 if seed >= 2**63 else seed


def test_quality_verdicts_by_brute_force(spark):
    """kept, from counts, folds, ratios and the threshold, in plain Python."""
    docs, lab = documents(spark), spark.read.parquet(f"{DATA}/labels.parquet")
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    good = {r["doc_id"] for r in lab.where("quality = 1").collect()}
    n, folds = quality_rules.BUCKETS, quality_rules.FOLDS
    grams = {}
    for i, t in rows.items():
        h = [spark_hash(w) for w in WORD.findall(t)]
        grams[i] = [x % n for x in [*h, *(spark_hash(a, b) for a, b in zip(h, h[1:], strict=False))]]
    fold = {i: spark_hash(i, "fold") % folds for i in good}
    raw = Counter(g for x in grams.values() for g in x)
    by_fold = [Counter(g for i in good if i in grams and fold[i] == k for g in grams[i]) for k in range(folds)]

    def ratios(parts):
        c = [1.0 + sum(p[b] for p in parts) for b in range(n)]
        r = [1.0 + raw[b] for b in range(n)]
        return [round(math.log(x) - math.log(sum(c)) - math.log(y) + math.log(sum(r)), 5) for x, y in zip(c, r, strict=True)]

    score = lambda i, table: sum(table[g] for g in grams[i]) / max(1, len(grams[i]))
    left = [ratios([p for j, p in enumerate(by_fold) if j != k]) for k in range(folds)]
    past = sorted(score(i, left[fold[i]]) for i in good if i in rows and not quality_brute(rows[i])[5])
    bound, table = past[int(quality_rules.LOW * len(past))], ratios(by_fold)
    for r in quality_rules.quality_rules(docs, lab).collect():
        want = score(r["doc_id"], table)
        assert math.isclose(r["score"], want, abs_tol=1e-5)
        if abs(want - bound) > 1e-6:
            assert r["kept"] == (not quality_brute(r["text"])[5] and want >= bound)


def test_quality_model_counts_all_trusted(spark):
    """Where all documents are trusted, their counts are those of the corpus and all ratios 0, however many there are."""
    docs = spark.range(20_500).selectExpr("id as doc_id", "concat('w', id) as text")
    ratios, _ = quality_rules.model(docs, docs.selectExpr("doc_id", "1 as quality"))
    assert not any(float(x) for x in ratios.split(","))


@pytest.mark.parametrize("share", [0.0, 0.002, 0.5, 0.999])
def test_quality_threshold_is_the_value_in_order(spark, share):
    rng = np.random.default_rng(5)
    values = [*rng.normal(size=3000).tolist(), *[0.25] * 500, *[0.25 + i * 2**-54 for i in range(9)], 1e300, -1e300, -0.5, 2.0]
    for cut in (values, values[:3000], values[3000:3500], values[:1]):
        got = quality_rules.lowest(spark.createDataFrame([(x,) for x in cut], "q double"), share)
        assert got == sorted(cut)[int(share * len(cut))]
    assert quality_rules.lowest(spark.createDataFrame([], "q double"), share) is None


def test_llr_score_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    ratios = ",".join(str(i % 7) for i in range(quality_rules.BUCKETS))
    h = spark.sql("select xxhash64('a') a, xxhash64('b') b, xxhash64('c') c, xxhash64(xxhash64('a'), xxhash64('b')) ab, xxhash64(xxhash64('b'), xxhash64('c')) bc").first()
    want = sum(v % quality_rules.BUCKETS % 7 for v in h) / 5
    assert math.isclose(quality_rules.scored(quality_rules.hashed(docs), ratios).first()["score"], want)


def test_automaton_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row = reduce(lambda acc, j: [*acc, min(row[j + 1] + 1, acc[j] + 1, row[j] + (x != b[j]))], range(len(b)), [i + 1])
        return row[-1]

    terms = ["idiot", "worthless", "contemptibly", "moron"]
    lex = toxicity.Lexicon(dict.fromkeys(terms, 1.0), terms)
    rng = np.random.default_rng(1)
    for t in terms * 60:
        w = list(t)
        for _ in range(rng.integers(0, 4)):
            k = rng.integers(0, len(w)) if w else 0
            w[k : k + 1] = [["q"], [], [*w[k : k + 1], "z"]][rng.integers(0, 3)]
            w = w or ["a"]
        w = "".join(w)
        near = [(distance(w, x), x) for x in terms if distance(w, x) <= lex.edits(len(x))]
        best = min(near) if near else None
        found = lex.walk(w, 2)
        assert (found and (found[1], found[0])) == best
        assert not near or w in terms or lex.near(w) == best[::-1]


def test_misspelled_terms_are_found_anywhere():
    """Two edits from 9 letters, also of the first letter, and for each term of the lexicon."""
    filler = [f"{a}{b}{c}{d}zzz" for a in "bcdfg" for b in "hjklm" for c in "npqrs" for d in "tvwxy"]
    terms = [*filler, "worthless", "disgusting", "idiot"]
    lex = toxicity.Lexicon(dict.fromkeys(terms, 1.0), terms)
    for w, want in (("wrothless", "worthless"), ("disgsuting", "disgusting"), ("xorthless", "worthless"), ("orthless", "worthless"), ("qisgustin", "disgusting"), ("rthless", "worthless"), ("jdiot", "idiot"), ("diot", "idiot")):
        assert lex.find(w) == lex.walk(w, lex.edits(len(w) + 2)) and lex.find(w)[0] == want
    assert lex.find("table") is None and lex.find("horseback") is None


def test_hits_of_a_corpus_by_brute_force(spark):
    """Every distinct word of the table against every term, by edit distances; ties go to the smaller term."""
    def near(a, b, most):
        if abs(len(a) - len(b)) > most:
            return most + 1
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            nxt = [i + 1]
            for j, y in enumerate(b):
                nxt.append(min(row[j + 1] + 1, nxt[j] + 1, row[j] + (x != y)))
            row = nxt
        return row[-1]

    words = sorted({w for r in documents(spark).limit(80).collect() for w in (r["text"] or "").lower().split()})[:6000]
    rng = np.random.default_rng(2)
    terms = sorted({w for w in rng.choice(words, 40) if w.isalpha() and len(w) > 3} | {"idiot", "worthless"})
    lex = toxicity.Lexicon(dict.fromkeys(terms, 1.0), terms)
    found = lex.find_all(set(words))
    for w in words:
        bare = w if w.isalpha() else toxicity.STRIP.sub("", w)
        folded = bare if bare.isalpha() else bare.translate(toxicity.FOLD)
        hits = [(d, t) for t in terms if (d := near(folded, t, 2)) <= lex.edits(len(t))] if len(bare) > 3 else []
        want = (bare, 0) if bare in terms else (folded, 1) if len(bare) > 3 and folded in terms else min(hits)[::-1] if hits else None
        assert found.get(w) == want


def test_every_term_may_be_misspelled(spark):
    """Also beyond the 250 strongest."""
    bad = [f"{a}{b}{c}schimpf" for a in "bdfgk" for b in "aeiou" for c in "lmnrstwxbdfg"]
    rows = [(i, " ".join(bad) if i % 4 == 0 else "ein ganz normaler text ohne boeses wort hier drin") for i in range(400)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels(spark, [(i, 1, int(i % 4 == 0)) for i in range(400)]))
    assert len(model["terms"]) == len(bad) == 300 and set(model["fuzzy"]) == set(bad)


def test_quotation_counts_less():
    lex = toxicity.Lexicon({"idiot": 5.0}, ["idiot"])
    abuse, quoted = toxicity.features("you are an idiot", lex), toxicity.features('the report called him an "idiot" in court', lex)
    assert abuse[0] > 0 and abuse[1] == 0 and quoted[0] == 0 and quoted[1] > 0


def test_toxicity(spark):
    bad = "du bist ein trottelhaft mensch und das weiss jeder hier"
    rows = [(i, (bad if i % 4 == 0 else "ein ganz normaler text ohne boeses wort hier drin")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = labels(spark, [(i, 1, int(i % 4 == 0)) for i in range(400)])
    got = {r["doc_id"]: r for r in toxicity.classify(spark, docs, lab).collect()}
    assert all(r["predicted"] == int(i % 4 == 0) and r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    # Labels of held-out rows are not read.
    other = labels(spark, [(i, 1, 1 - int(i % 4 == 0) if zlib.crc32(str(i).encode()) % 5 == 0 else int(i % 4 == 0)) for i in range(400)])
    assert {i: r["score"] for i, r in got.items()} == {r["doc_id"]: r["score"] for r in toxicity.classify(spark, docs, other).collect()}
    out = toxicity.classify(spark, edge(spark), labels(spark)).collect()
    assert len(out) == edge(spark).count() and all(0 <= r["score"] <= 1 for r in out) and toxicity.classify(spark, none(spark), lab).count() == 0


def test_raking_meets_marginals():
    cells = {("a", "en", "p"): 100, ("a", "fr", "p"): 50, ("b", "en", "q"): 10, ("b", "fr", "p"): 40, ("a", "en", "q"): 30}
    targets = [{"a": 1, "b": 1}, {"en": 2, "fr": 1}, {"p": 3, "q": 1}]
    w = mixing.rake(cells, targets)
    for axis, want in enumerate(({"a": 0.5, "b": 0.5}, {"en": 2 / 3, "fr": 1 / 3}, {"p": 0.75, "q": 0.25})):
        for k, v in want.items():
            assert math.isclose(sum(x for c, x in w.items() if c[axis] == k), v, abs_tol=1e-6)
    p = mixing.probabilities(cells, w, 0.5)
    assert all(0 <= x <= 1 for x in p.values()) and math.isclose(sum(p[k] * cells[k] for k in cells), 115, rel_tol=1e-6)


def test_mixing(spark):
    a = {(r["doc_id"], r["sampled"]) for r in mixing.mixed(documents(spark)).collect()}
    assert a == {(r["doc_id"], r["sampled"]) for r in mixing.mixed(documents(spark).repartition(7)).collect()}
    assert mixing.mixed(edge(spark)).count() == edge(spark).count() and mixing.mixed(none(spark)).count() == 0


def test_sampled_tokens_meet_the_targets(spark, monkeypatch):
    """Expected tokens follow the raked weights on each marginal, whether cells are raked on the driver or as a table, and
    so do those that are drawn, as far as chance allows."""
    rows = [(i, "w " * (1 + i % 7), ["en", "fr"][i % 3 == 0], ["a", "b", "c"][i % 5 % 3]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = [{"a": 1, "b": 1, "c": 2}, {"en": 1, "fr": 1}, {"short": 1}]
    probs = []
    for cells in (100_000, 0):
        monkeypatch.setattr(mixing, "CELLS", cells)
        got = mixing.mixed(docs, targets, 0.2).collect()
        assert len(got) == 6000
        total = sum(r["n_tokens"] for r in got)
        expected, drawn = Counter(), Counter()
        for r in got:
            assert r["n_tokens"] == len(WORD.findall(r["text"]))
            for k in (r["source"], r["lang"]):
                expected[k] += r["n_tokens"] * r["keep_prob"]
                drawn[k] += r["n_tokens"] * r["sampled"]
        for k, want in {"a": 0.25, "b": 0.25, "c": 0.5, "en": 0.5, "fr": 0.5}.items():
            assert math.isclose(expected[k], want * 0.2 * total, rel_tol=1e-4) and math.isclose(drawn[k], want * 0.2 * total, rel_tol=0.15)
        probs.append({r["doc_id"]: round(r["keep_prob"], 5) for r in got})
    assert probs[0] == probs[1]
    lifted = []
    for cells in (100, 0):
        monkeypatch.setattr(mixing, "CELLS", cells)
        lifted.append({(r["doc_id"], round(r["keep_prob"], 4)) for r in mixing.mixed(docs, share=0.5).collect()})
    assert lifted[0] == lifted[1]


def test_mixing_pools_no_source(spark):
    """Each of more than 64 sources has its own target, also a small one, and one that is called 'other'."""
    size = {f"s{i:03d}": 1 + i % 9 for i in range(150)} | {"other": 4}
    rows = [(1000 * k + j, "w " * 50, "en", name) for k, (name, n) in enumerate(size.items()) for j in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    prob = lambda got: {r["source"]: r["keep_prob"] for r in got.select("source", "keep_prob").distinct().collect()}
    lifted = prob(mixing.mixed(docs, share=0.3))
    assert lifted.keys() == size.keys()
    for name, n in size.items():
        assert math.isclose(lifted[name] / lifted["other"], (n / 4) ** (mixing.ALPHA - 1), rel_tol=1e-6)
    aimed = prob(mixing.mixed(docs, [{"s000": 1.0, "other": 1.0}, {"en": 1.0}, {"short": 1.0}], 0.002))
    assert 0 < aimed["other"] < aimed["s000"] and all(aimed[x] == 0 for x in size if x not in ("s000", "other"))


def test_lattice_marginal_is_the_sum_over_segmentations():
    p = lattice_lm.Pieces(queries.tokenizer_file("piece_bpe_32k.model"))

    def brute(w):
        return 1.0 if not w else sum(math.exp(p.log[p.at[w[:j]]]) * brute(w[j:]) for j in range(1, len(w) + 1) if w[:j] in p.at)

    for w in ("the", "zeitung", "banana"):
        assert math.isclose(math.log(brute("▁" + w)), p.log_marginal("▁" + w), rel_tol=1e-9)
    assert math.isfinite(p.log_marginal("▁日𝒳" * 100)) and math.isclose(np.exp(p.log).sum(), 1)


def test_lattices_of_a_length_equal_single_ones():
    p = lattice_lm.Pieces(queries.tokenizer_file("piece_bpe_32k.model"))
    words = ["▁the", "▁zeitung", "▁日本𝒳", "▁", "▁" + "ab" * 50, "▁that.", "▁thaty", "▁èê,"]
    one, many = np.zeros(len(p.texts)), np.zeros(len(p.texts))
    want = [p.expect(w, 1.0, one) for w in words]
    assert np.allclose(p.run(words, many), want) and np.allclose(p.run(words), want) and np.allclose(one, many)


def test_lattice_looks_up_no_more_than_begins_a_piece(monkeypatch):
    """Where the vocabulary has no longer piece that goes on as the word does, longer pieces are not looked up; arcs stay."""
    p = lattice_lm.Pieces(queries.tokenizer_file("piece_bpe_32k.model"))
    words = ["▁" + "".join(c) for c in (["qxzjkvwq"] * 3 + ["straßenb", "internat", "zzzzzzzz", "日本語の文字列で"])]
    looked, mixed = [], lattice_lm.fmix64
    monkeypatch.setattr(lattice_lm, "fmix64", lambda h: looked.append(len(h)) or mixed(h))
    codes = np.array([[ord(c) for c in w] for w in words], dtype=np.uint64)
    got = p.lattices(codes)
    begins = {t[:n] for t in p.texts for n in range(1, len(t) + 1)}
    want = 0
    for w in words:
        for i in range(len(w)):
            n = next((k for k in range(1, len(w) - i + 1) if w[i : i + k] not in begins), len(w) - i)
            want += min(n, p.longest)
    assert sum(looked) == want
    for r, w in enumerate(words):
        for end, arcs in enumerate(p.arcs(w)):
            here = {(i, int(x[r]), round(float(y[r]), 9)) for i, x, y in got[end] if y[r] > -np.inf}
            assert here == {(i, x, round(float(y), 9)) for i, x, y in arcs}


def test_lattice_score_by_brute_force(spark, monkeypatch):
    """Whole scores from plain sums over all segmentations, expectation steps included; also with few broadcast words."""
    path = queries.tokenizer_file("piece_bpe_32k.model")
    texts = ["the sea the sea", "a man and the man", "sand and seaman", "mansea the the", "zzz q the", "a a a sea"] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for i in train for w in [*texts[i].split(), "end"])
    n, v = sum(count.values()), len(count)
    n1, n2 = (sum(c == k for w, c in count.items() if w != "end") for k in (1, 2))
    d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    names, start = lattice_lm.vocabulary(path)
    at, zipf = {t: i for i, t in enumerate(names)}, np.exp(start)

    def paths(w):
        return [[]] if not w else [[at[w[:j]], *rest] for j in range(1, len(w) + 1) if w[:j] in at for rest in paths(w[j:])]

    p = zipf / zipf.sum()
    for _ in range(lattice_lm.STEPS):
        e = np.zeros(len(p))
        for w in count.keys() - {"end"}:
            every = [(math.prod(p[i] for i in x), x) for x in paths("▁" + w)]
            for q, x in every:
                for i in x:
                    e[i] += q / sum(y for y, _ in every)
        p = e + 0.1 * zipf / zipf.sum() * len(p)
        p /= p.sum()
    def log_p(w):
        return math.log10(max(count[w] - d, 0) / n + d * v / n * sum(math.prod(p[i] for i in x) for x in paths("▁" + w)))

    want = {i: sum(map(log_p, t.split())) + math.log10((count["end"] - d) / n) for i, t in enumerate(texts)}
    for frequent in (100_000, 2):
        monkeypatch.setattr(lattice_lm, "FREQUENT", frequent)
        got = {r["doc_id"]: r["score"] for r in lattice_lm.score(docs, path).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-4) for i in want)


def test_lattice_scores(spark):
    path = queries.tokenizer_file("piece_bpe_32k.model")
    for docs in (documents(spark), edge(spark)):
        rows = docs.select("doc_id", "text").collect()
        count, tokens = Counter(), []
        for r in rows:
            w = [*WORD.findall((r["text"] or "").translate(LOW)), "\0end"]
            tokens.append((r["doc_id"], w))
            if zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 7 != 2:
                count.update(w)
        n, v = sum(count.values()), len(count)
        want = sorted((str(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 4)) for i, w in tokens)
        got = lattice_lm.score(docs, path).collect()
        assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert lattice_lm.score(none(spark), path).count() == 0


def test_kneser_ney_is_a_distribution(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "b a b"), (3, "c c a b d")], "doc_id long, text string")
    values, unseen = kneser_ney.train(docs, docs.select("doc_id"))
    add = {r["gram"]: r["value"] for r in values.collect()}
    hashes = kneser_ney.WordHashes()

    def log_prob(text):
        every = kneser_ney.features(text, hashes)
        return [unseen + sum(add.get(int(x[i].view(np.int64)), 0.0) for x in every) for i in range(len(every[0]))]

    for history in ("", "a", "b a", "a b", "d", "x y"):
        total = sum(math.exp(log_prob(f"{history} {w}".strip())[-1]) for w in ("a", "b", "c", "d", "unseen"))
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_kneser_ney_by_brute_force(spark):
    """Perplexities from the model's textbook definition over plain counters."""
    texts = {1: "a b a c a b", 2: "b a b c c", 3: "c c a b d", 4: "a b", 5: "x a b", 6: "c c c c a"}
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id long, text string, lang string")
    trained = [1, 2, 3, 6]
    values, unseen = kneser_ney.train(docs, spark.createDataFrame([(i,) for i in trained], "doc_id long"))
    tri = Counter(g for i in trained for w in [["<s>", "<s>", *texts[i].split()]] for g in zip(w, w[1:], w[2:]))
    two = Counter(g[1:] for g in tri)
    one = Counter(g[1:] for g in two)
    discounts = {}
    for k, table in ((3, tri), (2, two), (1, one)):
        n = Counter(table.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        raw = [j - (j + 1) * y * (n[j + 1] / n[j] if n[j] else 0.0) for j in (1, 2, 3)]
        discounts[k] = [min(max(x, 0.05), cap) for x, cap in zip(raw, (0.95, 1.9, 2.8), strict=True)]

    def p(gram, k):
        table = {3: tri, 2: two, 1: one}[k]
        same = {g: c for g, c in table.items() if g[:-1] == gram[:-1]}
        low = 1 / (len(one) + 1) if k == 1 else p(gram[1:], k - 1)
        if not same:
            return low
        d = discounts[k]
        total, c = sum(same.values()), table.get(gram, 0)
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / total + sum(d[min(x, 3) - 1] for x in same.values()) / total * low

    for r in kneser_ney.perplexities(docs, values, unseen).collect():
        w = ["<s>", "<s>", *texts[r["doc_id"]].split()]
        logs = [math.log(p(g, 3)) for g in zip(w, w[1:], w[2:])]
        assert math.isclose(r["perplexity"], math.exp(-sum(logs) / len(logs)), rel_tol=1e-6)


def test_kneser_ney_shards(monkeypatch):
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(1, 500, 200).astype(np.uint64))
    values, x, owner = rng.random(len(keys)).astype(np.float32), rng.integers(0, 600, 900).astype(np.uint64), rng.integers(0, 7, 900)
    table = dict(zip(keys.tolist(), values.tolist(), strict=True))
    want = [sum(table.get(int(k), 0.0) for k in x[owner == i]) for i in range(7)]
    for shard in (1, 16, 10_000):
        monkeypatch.setattr(kneser_ney, "SHARD", shard)
        assert np.allclose(kneser_ney.meet(kneser_ney.shards(keys, values), x, owner, 7), want)
    assert not kneser_ney.meet([], x, owner, 7).any()


def test_kneser_ney_parts_hold_each_ngram_once():
    """The parts that are made and met one after another leave no n-gram out and count none twice, and none holds most."""
    texts = ["", None, " \t", "A b\tC b", "é" * 40 + " X É", " ".join(x * k for k in (7, 8, 9, 31, 32, 33) for x in "aB"), "q\x1cw\x0bAB Ab", *[f"w{i} of x{i} y{i} v{i % 7}" for i in range(200)]]
    hashes, got, sizes = kneser_ney.WordHashes(), Counter(), []
    for part in range(kneser_ney.PARTS):
        a, b, c, owner, word, last = kneser_ney.places(pa.array(texts), range(part, part + 1))
        rows = [x for g in ((a, b, c), (b, c), (b,), (a, b)) for x in zip([len(g)] * len(b), *[w.tolist() for w in g], owner.tolist())]
        got.update(rows + [(0, *x) for x in zip(word.tolist(), last.tolist())])
        sizes.append(len(b))
    want = Counter()
    for i, text in enumerate(texts):
        h = kneser_ney.padded(text, hashes).tolist()
        for a, b, c in zip(h, h[1:], h[2:]):
            want.update([(3, a, b, c, i), (1, b, i), (0, c, i), (2, b, c, i), (2, a, b, i)])
    assert got == want
    assert max(sizes) < 0.5 * sum(sizes), sizes


def test_kneser_ney_trains_on_all_trusted_words(spark, monkeypatch):
    """However many words the trusted documents have, and however long one of them is."""
    trained = []
    train = kneser_ney.train
    monkeypatch.setattr(kneser_ney, "train", lambda docs, ids: trained.append(ids) or train(docs, ids))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2, F.repeat(F.lit("a b c d "), 30_000)).otherwise("a b c e").alias("text"), F.lit("en").alias("lang"))
    docs = docs.union(docs.where("doc_id = 7"))
    got = kneser_ney.classify(docs, spark.range(10_300).selectExpr("id as doc_id", "1 as quality", "0 as toxic"))
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(10)) == 0
    assert trained[0].count() == spark.range(10_300).select(F.col("id").alias("doc_id")).where(~held).count()
    assert got.count() == 301 and got.where("doc_id = 7").distinct().count() == 1 and got.where("perplexity > 5").count() == 0


def test_kneser_ney_deletes_its_model(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    for lab in (spark.read.parquet(f"{DATA}/labels.parquet"), labels(spark)):
        kneser_ney.classify(documents(spark), lab)
    left = [p.name.rsplit("-", 1)[0] for p in (tmp_path / "sparkcat").iterdir()]
    assert sorted(left) == ["kn-bounds"] * 2 + ["kn-perplexity"] * 2


def test_kneser_ney_join_equals_lookup(spark):
    """The sharded join gives each row the sum over its own n-grams, repeated rows included."""
    docs = edge(spark)
    values, unseen = kneser_ney.train(documents(spark).unionByName(docs.select("doc_id", "text"), allowMissingColumns=True), documents(spark).select("doc_id").distinct())
    table, hashes = {r["gram"]: r["value"] for r in values.collect()}, kneser_ney.WordHashes()

    def perplexity(text):
        f = kneser_ney.features(text, hashes)
        s = sum(table.get(int(k), 0.0) for x in f for k in x.view(np.int64)) + len(f[0]) * unseen
        return len(f[0]), round(math.exp(-s / len(f[0])), 6) if len(f[0]) else None

    want = sorted((str(r["doc_id"]), r["lang"] or "", *map(str, perplexity(r["text"]))) for r in docs.collect())
    got = kneser_ney.perplexities(docs, values, unseen).collect()
    assert sorted((str(r["doc_id"]), r["lang"], str(r["n_words"]), str(r["perplexity"] and round(r["perplexity"], 6))) for r in got) == want


def test_kneser_ney_bound_is_a_quantile(spark):
    """The bounds are perplexities of calibration documents themselves, and most labelled junk lies above them."""
    docs, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    rows = kneser_ney.classify(docs, lab).join(lab, "doc_id").withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(10)) == 0).collect()
    assert {r["bound"] for r in rows} <= {r["perplexity"] for r in rows if r["quality"] == 1 and r["held"]}
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(junk) < 0.5 * len(junk)


def test_kneser_ney_edges(spark):
    lab = spark.read.parquet(f"{DATA}/labels.parquet")
    assert kneser_ney.classify(edge(spark), labels(spark)).count() == edge(spark).count()
    got = kneser_ney.classify(documents(spark), lab).join(lab, "doc_id").where("quality = 1")
    assert got.where("kept").count() >= 0.95 * got.count() and kneser_ney.classify(none(spark), labels(spark)).count() == 0


def test_pipeline(spark):
    docs = documents(spark)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = {r["doc_id"] for r in kept.select("doc_id").collect()}
        kept = spark.createDataFrame(stage(spark, kept, DATA).collect(), docs.schema)
        after = {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert after <= before and kept.columns == docs.columns, name
        if name == "near_dedup":
            _, label = brute_components([(r["doc_id"], r["text"]) for r in docs.where(F.col("doc_id").isin(list(before))).collect()], 80)
            assert after == {i for i in before if label[i] == i}
    out = corpus_pipeline.run(spark, DATA).toPandas()
    assert set(out["doc_id"]) <= after and isinstance(out, pd.DataFrame) and (out["n_tokens"] > 0).all()


def test_quality_stage_learns_from_all_trusted(spark, tmp_path):
    """Of 20,500 trusted documents the 500 with the largest hashes have words of their own, and stay like the others."""
    ids = [r["id"] for r in spark.range(20_500).orderBy(F.xxhash64("id")).collect()]
    texts = [" ".join(f"{x}{i}" for i in range(60)) for x in "ab"]
    docs = spark.createDataFrame([(i, texts[at >= 20_000]) for at, i in enumerate(ids)], "doc_id long, text string")
    docs.selectExpr("doc_id", "1 as quality").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.of_quality(spark, docs, str(tmp_path)).count() == 20_500


@pytest.mark.parametrize("at", range(4))
def test_stages_take_odd_tables(spark, at):
    _, stage = corpus_pipeline.STAGES[at]
    docs = edge(spark)
    assert stage(spark, docs, DATA).columns == docs.columns
    assert stage(spark, none(spark), DATA).count() == 0


def test_tokens_stage_holds_no_batch_of_python_texts(spark, tmp_path):
    """The mixing stage starts no workers of another kind, whose memory would stay beside the tokenizer's; that takes its texts
    from Arrow, not as a batch of pandas objects, and ids beside null ones keep all their digits."""
    assert "ExistingRDD" not in mixing.mixed(documents(spark))._jdf.queryExecution().toString()
    assert mixing.local_table(spark, [("a", 0.5), (None, 1.0)], ("x",), "p").dtypes == [("x", "string"), ("p", "double")]
    assert mixing.local_table(spark, [], ("x",), "p").count() == 0
    docs = spark.createDataFrame([(None, "a"), (2**53 + 1, "a b"), (3, None)], "doc_id long, text string").coalesce(1)
    out = corpus_pipeline.to_tokens(spark, docs, DATA)
    assert "InPandas" not in out._jdf.queryExecution().toString()
    assert [(r["doc_id"], r["n_tokens"]) for r in out.collect()] == [(None, 1), (2**53 + 1, 2), (3, 0)]


def test_freed_arrow_memory_is_given_back(monkeypatch):
    freed = []
    monkeypatch.setattr(pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: freed.append(1)})())
    monkeypatch.setattr(common, "_kept", {("toxicity", "x"): 1})
    assert common.kept(("words",), dict) == {} and freed


CLASHING = ["score", "kept", "toxicity", "topic", "n_tokens", "sampled", "keep_prob", "_tokens", "_h", "_two", "_fixed", "_row", "_document", "component_id", "text_hash", "digest", "held_out", "n_words", "base_failed"]


@pytest.mark.parametrize("at", range(4))
def test_stages_leave_clashing_columns_as_they_are(spark, at):
    """Columns that operators use themselves keep their values, whatever their types."""
    _, stage = corpus_pipeline.STAGES[at]
    docs = documents(spark)
    docs = docs.select("*", *[F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in CLASHING])
    out = stage(spark, docs, DATA)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{c} {r['doc_id']}" for r in rows for c in CLASHING)
