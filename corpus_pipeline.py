"""From raw documents to training tokens, in stages that are each written as Parquet and read again.

All stages but the last return the columns of documents, with their values as they came: rows travel whole, as one struct,
through operators that add columns, so columns of any name may be there. Each works on all that its predecessor kept.
Stages tell texts by themselves: null, empty, blank and very long texts have a result like any other (below), rows that
repeat are judged alike, each by itself, and empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcat.llm import bpe, mixing, near_dedup, quality_rules, toxicity
from sparkcat.llm.common import forget, stored, table
from sparkcat.llm.queries import tokenizer_file


def carried(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns that an operator needs, and whole rows as the struct _document beside them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_document"), *needed)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5. Null and empty texts score as texts without terms and stay; ties at 0.5 go.
    A row's doc_id matters for training only, where null is no label's."""
    scored = toxicity.score(carried(docs, "text"), toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels")))
    return scored.where(F.col("toxicity") < 0.5).select("_document.*")


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the ratio's threshold (a score equal to it passes). Null, empty and blank texts
    have no words and go."""
    judged = quality_rules.quality_rules(carried(docs, "doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged.where("kept").select("_document.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts alike to 80 % or more: that with the smallest doc_id. Null and empty texts are
    like no other and stay, as do rows with a null doc_id; rows that repeat a doc_id are one document and share its fate,
    which stays if one of its texts does."""
    judged = near_dedup.near_duplicates(docs, 80).where("doc_id is not null")
    gone = judged.groupBy("doc_id").agg(F.max(F.col("kept").cast("int")).alias("stays")).where("stays = 0").select("doc_id")
    # Stored, so that Spark knows the ids' size: while they are few (by its own threshold) it broadcasts them and shuffles no text.
    gone = stored(gone, "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def to_target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares of sources, languages and topics. Null sources and languages are a value
    of their own; null and empty texts have no tokens and the probability of their cell, or of all tokens; a null doc_id
    draws the number of an empty one."""
    return mixing.mixed(carried(docs, "doc_id", "text", "source", "lang")).where("sampled").select("_document.*")


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of token ids and of the decoded text, for each row; null and empty texts have none."""
    return bpe.encode_digests(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("quality_rules", of_quality),
    ("near_dedup", without_near_copies),
    ("mixing", to_target_mix),
    ("bpe", to_tokens),
]
#: Learned scores, components and raking are no plain SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        after = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if i:
            forget(spark, docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
