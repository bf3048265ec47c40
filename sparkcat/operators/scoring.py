"""Scoring candidates for catalogue items: seven signals, three reasons to reject, bands; the best of a few per source.

Only string similarity and sequence numbers need Arrow UDFs; they run once per pair, after candidates are cut to a few per
item and source. All weights and limits are the catalogue's (fixed values).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import udf as U
from ..functions.titles import SIMPLIFIED, VARIANTS
from .merge import top_per_key

#: How many candidates of a source are scored, the bands of a score, and the separators that titles are compared without
#: (fixed values, as are the weights and limits below).
CANDIDATES = 5
BANDS = (70, 55, 40)
_FOLD = {**SIMPLIFIED, **VARIANTS}
SEPARATORS = "[\\s\\-_·・:：/()（）\\[\\]【】《》\"'“”‘’,，.。]+"


def simplified(c: Column) -> Column:
    return F.translate(c, "".join(map(chr, _FOLD)), "".join(map(chr, _FOLD.values())))


def scoring_form(c: Column) -> Column:
    """Lower case, simplified script, no separators: what titles are compared by."""
    return F.regexp_replace(simplified(F.lower(F.trim(F.coalesce(c, F.lit(""))))), SEPARATORS, "")


def _number(c: Column) -> Column:
    text = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))


def popularity_prior(popularity: Column) -> Column:
    p = F.coalesce(popularity.try_cast("double"), F.lit(0.0))
    return F.when(p > 0, F.least(F.lit(5.0), F.log10(p + 1))).otherwise(0.0)


def scored(pairs: DataFrame) -> DataFrame:
    """Add score (0 to 100), match_kind, reject (null if not rejected) and title_ratio.

    pairs: title, category, year, seq, episodes of the item; cand_title, cand_original, cand_year, media_type, popularity,
    cand_episodes of the candidate. Missing texts are empty, missing numbers unknown.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    out = pairs.withColumns({"_s": scoring_form(F.col("title")), "_c": scoring_form(F.col("cand_title")), "_o": scoring_form(F.col("cand_original"))})
    out = out.withColumns({"title_ratio": U.ratio("_s", "_c"), "_so": U.ratio("_s", "_o"), "_co": U.ratio("_c", "_o"), "_seq": U.parse_seq("cand_title")})
    ascii_ = lambda c: text(c).rlike("[A-Za-z]")
    name = F.col("title_ratio")
    pair = (name < 0.3) & text("title").rlike("[一-鿿]") & (F.col("_o") != "") & (F.col("_co") >= 0.6) & (ascii_("cand_title") | ascii_("cand_original"))
    kind = F.when(pair, "translation_pair").when((name >= 0.99) | (F.col("_s") == F.col("_c")), "exact").when(name >= 0.55, "fuzzy").otherwise("")
    s1 = F.when(pair, 30.0).otherwise(40 * name)
    has2 = (F.col("_o") != "") & ascii_("title")
    year, cand_year = _number(F.col("year")), _number(F.col("cand_year"))
    both, apart = year.isNotNull() & cand_year.isNotNull(), F.abs(year - cand_year)
    s3 = F.when(~both, 8.0).when(apart == 0, 15.0).when(apart == 1, 10.0).when(apart == 2, 5.0).otherwise(0.0)
    s4 = F.when(text("media_type") == F.when(text("category") == "movies", "movie").otherwise("tv"), 10.0).otherwise(0.0)
    own, theirs = F.coalesce("episodes", F.lit(0)), F.coalesce("cand_episodes", F.lit(0))
    has5, share = text("category").isin("tv", "anime") & (own > 0) & (theirs > 0), own / F.nullif(theirs, F.lit(0))
    s5 = F.when(share.between(0.5, 2), 10.0).when(share.between(0.25, 4), 5.0).otherwise(0.0)
    gained = s1 + F.when(has2, 20 * F.col("_so")).otherwise(0.0) + s3 + s4 + F.when(has5, s5).otherwise(0.0) + popularity_prior(F.col("popularity"))
    full = 70.0 + F.when(has2, 20.0).otherwise(0.0) + F.when(has5, 10.0).otherwise(0.0)
    seq = F.when(F.coalesce("seq", F.lit(0)) == 0, 1).otherwise(F.col("seq"))
    total = 100 * gained / full + F.when(seq == F.coalesce("_seq", F.lit(1)), 10).otherwise(-10)
    reject = (
        F.when((s4 == 0) & (name < 0.5), "type_mismatch").when(both & (s3 == 0) & (name < 0.8), "year_far")
        .when((name < 0.15) & (kind != "translation_pair"), "name_unrelated")
    )
    score = F.when(reject.isNotNull(), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(100), F.bround(total, 0)))).cast("int")
    return out.withColumns({"match_kind": kind, "reject": reject, "score": score}).drop("_s", "_c", "_o", "_so", "_co", "_seq")


def decision(score: Column, bands: tuple[int, int, int] = BANDS) -> Column:
    high, medium, low = bands
    return F.when(score >= high, "high").when(score >= medium, "medium").when(score >= low, "low").otherwise("miss")


def best_candidates(pairs: DataFrame, key: str, source: str, place: str, low: int = BANDS[2]) -> DataFrame:
    """Per item and source, the best of the first CANDIDATES candidates: highest score, then earliest; none below `low`."""
    few = scored(top_per_key(pairs, [key, source], [F.col(place)], CANDIDATES, "_place"))
    best = few.groupBy(key, source).agg(F.max_by(F.struct(*[c for c in few.columns if c not in (key, source, "_place")]), F.struct("score", -F.col("_place"))).alias("_best"))
    return best.select(key, source, "_best.*").where(F.col("score") >= low)


def first_hits(best: DataFrame, key: str, source: str, order: list[str], medium: int = BANDS[1]) -> DataFrame:
    """Per item, the best candidate of the first source in order that has one in the medium band or above."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(source))
    found = best.where((F.col("score") >= medium) & (rank > 0))
    cols = [c for c in found.columns if c != key]
    return found.groupBy(key).agg(F.min_by(F.struct(*cols), rank).alias("_hit")).select(key, "_hit.*")
