"""Arrow UDFs for what built-in functions can't express: NFKC titles, episode names, Ratcliff-Obershelp similarity, HTML."""

from __future__ import annotations

import html
import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .episodes import episode, episode_parts  # noqa: F401
from .titles import extract_seq, numeral, title, title_parts, without_brackets  # noqa: F401


def _struct(**fields: T.DataType) -> T.StructType:
    """A type without a session: workers import this module too."""
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


TEXT, INT = T.StringType(), T.IntegerType()
TITLE = dict(norm_title=TEXT, seq=INT, year=TEXT)


@F.pandas_udf(_struct(**TITLE))
def parse_title(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([title_parts(x) for x in raw], columns=list(TITLE))


@F.pandas_udf(_struct(**TITLE, quality_tags=T.ArrayType(TEXT), merge_key=TEXT, merge_group=TEXT))
def parse_title_fully(raw: pd.Series, category: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([title(x, c) for x, c in zip(raw, category, strict=True)], columns=[*TITLE, "quality_tags", "merge_key", "merge_group"])


@F.pandas_udf(_struct(kind=TEXT, ep_number=INT, ep_title=TEXT, air_date=TEXT, ep_end=INT, note=TEXT))
def parse_episode(name: pd.Series, order: pd.Series) -> pd.DataFrame:
    rows = [episode(x, int(i)) for x, i in zip(name, order, strict=True)]
    return pd.DataFrame(rows, columns=["kind", "ep_number", "ep_title", "air_date", "ep_end", "note"]).astype({"ep_end": "Int32", "ep_number": "int32"})


@F.pandas_udf(INT)
def parse_seq(text: pd.Series) -> pd.Series:
    """The sequence number that a text states, else null."""
    return pd.Series([extract_seq(x) for x in text], dtype="Int32")


def similarity(a: str | None, b: str | None) -> float:
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity, 0 to 1."""
    return pd.Series([similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


BREAKS = re.compile(r"<[^>]*>")
UNSEEN = re.compile("[\u200b-\u200f\ufeff]")


@F.pandas_udf(TEXT)
def html_text(s: pd.Series) -> pd.Series:
    """Every character reference decoded, then tags to spaces, characters without width taken out, white space collapsed."""
    return pd.Series([" ".join(UNSEEN.sub("", BREAKS.sub(" ", html.unescape(x or ""))).split()) for x in s])


def register(spark: SparkSession) -> None:
    """The UDFs by name, for SQL texts."""
    for name, f in (("parse_title", parse_title), ("parse_title_fully", parse_title_fully), ("parse_episode", parse_episode), ("parse_seq", parse_seq), ("ratio", ratio), ("html_text", html_text)):
        spark.udf.register(name, f)
