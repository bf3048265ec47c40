"""The registered queries of the corpus operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fingerprints, html_text, kneser_ney, lattice_lm, mixing, near_dedup, quality_rules, toxicity, warc
from .common import table


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """The place of a public tokenizer file on this machine; the folder is a parameter (SPARKCAT_TOKENIZERS)."""
    folder = folder or os.environ.get("SPARKCAT_TOKENIZERS")
    if not folder:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec else "/opt/tokenizers"
    return os.path.join(folder, name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", "keep_prob", "sampled")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("score", 6).alias("score"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours(table(spark, sf_dir, "documents"))


def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_bpe_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_toxicity, op2_warc_revisits, op3_source_mixing, op4_minhash_near_dedup, op5_quality_rules, op6_order_minhash,
        op7_lattice_lm, op8_kneser_ney, op9_html_consensus, op10_bpe_backtracking,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """Links, components and learned models are no plain SQL; those queries are tested against brute force instead."""
    return {"op2_warc_revisits": OP2_SQL}


#: DuckDB's sha1() gives hex; the digest's base32 letters come from 20 bits at a time.
OP2_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (
  select page_id, octet_length(encode(h)) as payload_bytes, sha1(h) as x from p
), e as (
  select page_id, payload_bytes::bigint as payload_bytes,
    array_to_string(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(x, 1 + 5 * (i // 4)::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31), 1)), '') as payload_digest
  from d
), m as (select payload_digest, max(page_id) as original from e group by 1)
select page_id, payload_bytes, payload_digest,
  case when page_id < original then 'revisit' else 'response' end as record_type,
  case when page_id < original then original end as refers_to
from e join m using (payload_digest)
"""
