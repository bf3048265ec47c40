"""Where items and candidates come from: site types and plug-ins, offline candidate frames of lookup providers, resumable
scans, and the classes of transport results. Nothing here opens a network connection."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from . import feeds

Crawler = Callable[[SparkSession, Mapping], DataFrame]
_CRAWLERS: dict[str, Crawler] = {}
#: Providers in order of trial, the ones that answer only some categories with those (fixed values).
ORDER = ["tmdb", "tvdb", "douban", "bilibili", "omdb"]
ONLY = {"tvdb": ("tv", "anime", "variety"), "bilibili": ("anime",)}
CANDIDATE = (
    "provider string, item_key string, pos int, title string, original_title string, media_type string, tmdb_id string, tvdb_id string, douban_id string, imdb_id string, bilibili_season_id string, overview string, poster string, "
    "backdrop string, year string, first_air_date string, rating double, vote_count int, popularity double, original_language string, country string, genres array<string>, number_of_episodes int, number_of_seasons int"
)
#: How many candidates a provider's search gives at most (fixed values).
MOST = {"tmdb": 20, "omdb": 10}


def crawler(kind: str) -> Callable[[Crawler], Crawler]:
    """Register a plug-in that gives raw items of sites of a type."""

    def add(f: Crawler) -> Crawler:
        _CRAWLERS[kind] = f
        return f

    return add


@crawler("maccms")
def paged_site(spark: SparkSession, site: Mapping) -> DataFrame:
    """A paged feed, with mirrors as fallbacks; all pages, or from a page on, and rows since a time, unreadable ones kept."""
    options = {"mirrors": ",".join(site.get("fallbacks") or []), **({"pages": str(site["pages"])} if site.get("pages") else {}), "start": str(site.get("start_page", 1))}
    feed = feeds.read_feed(spark, site["api_url"], site["name"], **options)
    items = feeds.raw_items(feed, F.lit(site.get("category", "movies"))).withColumn("priority", F.lit(int(site.get("priority", 10))))
    since = site.get("since")
    return items if since is None else items.where(F.col("update_time").isNull() | (F.col("update_time") >= F.lit(since).cast("timestamp")))


@crawler("table")
def stored_site(spark: SparkSession, site: Mapping) -> DataFrame:
    """Raw items that were stored before, as Parquet."""
    return spark.read.parquet(site["api_url"]).withColumns({"site": F.lit(site["name"]), "priority": F.lit(int(site.get("priority", 10)))})


def site_items(spark: SparkSession, site: Mapping) -> DataFrame:
    """The raw items of a site by its type; an unknown type is an error that names it."""
    kind = site.get("type", "maccms")
    if kind not in _CRAWLERS:
        raise ValueError(f"no crawler for sites of type {kind!r}: {sorted(_CRAWLERS)}")
    return _CRAWLERS[kind](spark, site)


def harvest(spark: SparkSession, sites: Sequence[Mapping], seen: DataFrame | None = None, progress: Mapping[str, Mapping] | None = None) -> tuple[DataFrame, DataFrame]:
    """All enabled sites' items, and a report per site (items, new, updated, skipped).

    Each (site, raw_id) comes once; with `seen` (site, raw_id, content_hash) unchanged rows are left out. Sites that
    `progress` calls done are skipped, others go on after their last page.
    """
    from ..operators import merge, state

    frames = []
    for site in feeds.enabled_sites(list(sites)):
        at = (progress or {}).get(site["name"], {})
        if not at.get("done"):
            frames.append(site_items(spark, {**site, "start_page": at.get("page", 0) + 1} if at else site))
    if not frames:
        raise ValueError("no site is enabled and unfinished")
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    one = merge.first_wins(every, ["site", "raw_id"], [-F.coalesce(F.unix_timestamp("update_time"), F.lit(0)), F.col("raw_title")])
    if seen is None:
        judged = one.withColumn("change", F.lit("new"))
    else:
        judged = state.changes(one, seen, ["site", "raw_id"], [c for c in one.columns if c not in ("update_time", "priority")])
    report = judged.groupBy("site").agg(F.count("*").alias("items"), *[F.count_if(F.col("change") == k).alias(k) for k in ("new", "updated", "skipped")])
    return judged.where("change <> 'skipped'"), report


def legacy_report(report: DataFrame) -> DataFrame:
    """The report in the older projection: site, total, added."""
    return report.select("site", F.col("items").alias("total"), (F.col("new") + F.col("updated")).alias("added"))


def advance(progress: Mapping[str, Mapping], site: str, page: int, done: bool = False) -> dict[str, dict]:
    """A scan's cursor after a page: pages only grow, done stays done."""
    at = progress.get(site, {})
    return {**{k: dict(v) for k, v in progress.items()}, site: {"page": max(at.get("page", 0), page), "done": bool(at.get("done") or done)}}


class Provider(Protocol):
    """A lookup provider: candidates of items (CANDIDATE columns), found by item_key."""

    name: str

    def search(self, items: DataFrame) -> DataFrame: ...


class StoredProvider:
    """Candidates from a table of earlier answers: those whose title or original title starts like the item's, in the table's
    order, with the item's year pushed into the join when both have one. An equi-join on the block, never a product."""

    def __init__(self, name: str, table: DataFrame, block: int = 2):
        self.name, self.table, self.block = name, table, block

    def search(self, items: DataFrame) -> DataFrame:
        from ..operators.merge import top_per_key
        from ..operators.scoring import scoring_form

        start = lambda c: F.left(scoring_form(F.col(c)), F.lit(self.block))
        mine = items.select("item_key", F.col("year").alias("_year"), F.col("category").alias("_category"), start("title").alias("_block"))
        if self.name in ONLY:
            mine = mine.where(F.col("_category").isin(*ONLY[self.name]))
        theirs = self.table.withColumn("_block", F.explode(F.array_distinct(F.array(start("title"), start("original_title"))))).where("_block <> ''")
        found = mine.join(theirs, "_block").where(F.col("_year").isNull() | (F.col("_year") == "") | F.col("year").isNull() | (F.abs(F.col("_year").try_cast("int") - F.col("year").try_cast("int")) <= 2))
        found = top_per_key(found, ["item_key"], [F.col("pos"), F.col("title")], MOST.get(self.name, 20), "_n").withColumns({"provider": F.lit(self.name), "pos": F.col("_n")})
        have = set(found.columns)
        return found.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in (x.split(" ", 1) for x in CANDIDATE.split(", "))])


def chain(providers: Sequence[Provider], settings: Mapping[str, bool] | None = None) -> list[Provider]:
    """The enabled providers in order of trial; unknown ones come last."""
    on = [p for p in providers if (settings or {}).get(p.name, True)]
    return sorted(on, key=lambda p: (ORDER.index(p.name) if p.name in ORDER else len(ORDER), p.name))


def with_details(items: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Tier B: cast (10 at most), directors, runtime, genres and ids of matched items, from a table of details."""
    from ..operators.library import is_missing

    cut = details.withColumn("cast", F.slice("cast", 1, 10)) if "cast" in details.columns else details
    d = cut.select(key, *[F.col(c).alias(f"_d_{c}") for c in cut.columns if c != key])
    out = items.join(d, key, "left")
    return out.withColumns({c: F.when(~is_missing(out, f"_d_{c}"), F.col(f"_d_{c}")).otherwise(F.col(c) if c in items.columns else F.lit(None)) for c in cut.columns if c != key}).drop(*[f"_d_{c}" for c in cut.columns if c != key])


def with_ratings(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """Ratings by imdb_id for items without one."""
    r = ratings.select("imdb_id", F.col("rating").alias("_r"), F.col("rating_source").alias("_s"))
    none = F.coalesce("rating", F.lit(0.0)) == 0
    return items.join(r, "imdb_id", "left").withColumns({"rating": F.when(none, F.col("_r")).otherwise(F.col("rating")), "rating_source": F.when(none & F.col("_r").isNotNull(), F.col("_s")).otherwise(F.col("rating_source"))}).drop("_r", "_s")


def transport_class(status: Column, error: Column | None = None) -> Column:
    """ok, retryable (limits, server errors, time-outs, refused connections) or error."""
    out = F.when(status.between(200, 399), "ok").when((status == 429) | (status == 408) | (status == 403) | (status >= 500), "retryable").otherwise("error")
    return out if error is None else F.when(F.coalesce(error, F.lit("")) != "", "retryable").otherwise(out)


def retry_delay(attempt: Column, jitter: Column, retry_after: Column | None = None, base: float = 0.5, cap: float = 60.0) -> Column:
    """Seconds until the next attempt: exponential with up to a quarter of jitter, or what the server asks for, capped."""
    wait = F.least(F.lit(cap), base * F.pow(F.lit(2.0), attempt)) * (1 + 0.25 * jitter)
    return wait if retry_after is None else F.when(retry_after > 0, F.least(F.lit(cap), retry_after)).otherwise(wait)


def tolerant_json(body: Column, schema: str) -> Column:
    """A response as JSON whatever its content type: a byte-order mark, white space or a call around it are taken off; null
    if it is none."""
    bare = F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(body, F.lit("")), "^﻿", "")), r"^[A-Za-z_$][\w$.]*\((.*)\);?$", "$1")
    return F.from_json(bare, schema)


def search_hits(page: Column) -> Column:
    """Hits of a search page's HTML: an array of (id, title, rating, abstract)."""
    part = lambda x, pattern: F.regexp_extract(x, pattern, 1)
    rows = F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(r'(?s)(<div class="result">.*?)(?=<div class="result">|$)'), 1)
    return F.filter(F.transform(rows, lambda x: F.struct(
        part(x, r"(?:subject/|sid:\s*)(\d+)").alias("id"), T.html_plain(part(x, r"(?s)<h3>(.*?)</h3>")).alias("title"), part(x, r'class="rating_nums">([\d.]+)<').try_cast("double").alias("rating"), T.html_plain(part(x, r'(?s)class="subject-cast">(.*?)</span>')).alias("abstract"),
    )), lambda x: x["id"] != "")


def abstract_parts(abstract: Column) -> Column:
    """(year, genres) of a search hit's abstract: the first year, and up to six known genres."""
    from ..functions.taxonomy import GENRES

    words = F.filter(F.split(F.coalesce(abstract, F.lit("")), r"[\s/]+"), lambda w: w.isin(*GENRES))
    return F.struct(T.year_of(abstract).alias("year"), F.slice(F.array_distinct(words), 1, 6).alias("genres"))


def staff(text: Column, most: int = 10) -> Column:
    """Names of a staff list (role：name lines): bracketed parts off, each name once, ten at most."""
    names = F.transform(F.split(F.coalesce(text, F.lit("")), r"[\n、,，/]+"), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "^[^：:]*[：:]", ""), r"[（(\[【][^）)\]】]*[）)\]】]", "")))
    return F.slice(F.array_distinct(F.filter(names, lambda x: x != "")), 1, most)


def episode_count(title: Column) -> Column:
    """How many episodes a title says there are (更新至12集, 全40集, 第3集); null if it says nothing."""
    return F.nullif(F.regexp_extract(F.coalesce(title, F.lit("")), r"(?:更新至|更至|全|第)?\s*(\d{1,4})\s*[集话話期]", 1), F.lit("")).try_cast("int")
