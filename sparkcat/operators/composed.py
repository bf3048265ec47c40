"""A whole run of the catalogue from the operators: harvest, filters, liveness, coarse merge and library, lookups, fine merge,
export. Each phase maps frames to frames, and what several others read is stored between them; what a later run needs
(library, cache, registry) is returned as frames too."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomy as X
from ..functions import text as T
from ..functions import udf as U
from ..session import stored
from ..sources import providers as V
from . import library as L
from . import scoring as S
from . import state as K
from .prefilter import Filters


@dataclass
class Outcome:
    items: DataFrame  # final items, nested
    unmatched: DataFrame  # audit rows
    library: DataFrame  # after this run
    cache: DataFrame  # after this run
    reasons: DataFrame  # why raw items were left out: reason, n


def live_items(items: DataFrame, registry: DataFrame) -> DataFrame:
    """Items with the lines whose first episode's domain the registry does not call dead; items without one are left out."""
    one = items.withColumn("_id", F.monotonically_increasing_id()).select("_id", F.posexplode("lines").alias("_i", "_line"))
    one = one.withColumn("domain", T.domain(F.get("_line.episodes", F.lit(0))["url"], False))
    live = one.join(registry.where("state = 'dead'").select("domain"), "domain", "left_anti")
    lines = live.groupBy("_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_line"))), lambda x: x["_line"]).alias("lines"))
    return items.withColumn("_id", F.monotonically_increasing_id()).drop("lines").join(lines, "_id").drop("_id")


def flat_lines(items: DataFrame) -> DataFrame:
    """Items with lines as a flat list of episodes: name, url, url_type, priority, site, place."""
    episode = lambda line: F.transform(line["episodes"], lambda e, i: F.struct(e["name"].alias("name"), e["url"].alias("url"), T.url_type(e["url"]).alias("url_type"), F.coalesce("priority", F.lit(10)).alias("priority"), F.col("site").alias("site"), (i + 1).alias("place")))
    return items.withColumn("lines", F.flatten(F.transform("lines", episode)))


def entities(items: DataFrame) -> DataFrame:
    """Coarse entities by category, normal title and sequence number, with what lookups need."""
    parsed = flat_lines(items).withColumn("_t", U.parse_title_fully("raw_title", "category"))
    parsed = parsed.select(*[c for c in parsed.columns if c not in ("_t", "year")], F.col("_t.merge_key").alias("merge_key"), F.col("_t.norm_title").alias("norm_title"), F.col("_t.seq").alias("seq"), F.coalesce(F.nullif("year", F.lit("")), "_t.year").alias("year"))
    e = L.coarse_entities(parsed.withColumn("arrival", F.struct("site", "raw_id")), ["merge_key", "category", "norm_title", "seq"], "priority", "lines", "arrival")
    keep = ["raw_title", "site", "raw_id", "sub_category", "poster", "overview", "douban_id", "year"]
    return e.select("merge_key", "category", "norm_title", "seq", "lines", "line_count", *[F.col(f"primary.{c}").alias(c) for c in keep if c in items.columns or c == "year"], T.epoch_of(F.col("primary.update_time")).alias("last_updated"))


def looked_up(pending: DataFrame, providers: Sequence[V.Provider], settings=None) -> DataFrame:
    """For each pending entity its best candidate of the first provider that has one in the medium band or above."""
    from functools import reduce

    items = pending.select(F.col("merge_key").alias("item_key"), F.col("norm_title").alias("title"), "year", "category", "seq", F.size("lines").alias("episodes"))
    chain = V.chain(providers, settings)
    found = reduce(lambda a, b: a.unionByName(b), [p.search(items) for p in chain])
    cand = found.select("item_key", "provider", "pos", F.col("title").alias("cand_title"), F.col("original_title").alias("cand_original"), F.col("year").alias("cand_year"), "media_type", "popularity", F.col("number_of_episodes").alias("cand_episodes"), F.struct(*[c for c in found.columns if c not in ("item_key", "provider", "pos")]).alias("meta"))
    best = S.best_candidates(items.join(cand, "item_key"), "item_key", "provider", "pos")
    return S.first_hits(best, "item_key", "provider", [p.name for p in chain]).select(F.col("item_key").alias("merge_key"), "provider", F.col("score").alias("confidence"), "match_kind", "meta")


def finished(enriched: DataFrame, now: int, rules: X.Rules | None = None) -> tuple[DataFrame, DataFrame]:
    """Final items (one per id) and the audit rows of those that may not enter: by an authority's category, then the gate."""
    signal = F.when(F.col("provider") == "tmdb", F.col("meta.media_type"))
    authority = F.when(F.col("provider") == "tmdb", X.authoritative_category(F.lit("TMDB"), signal, F.col("meta.genres"))["category"]).otherwise("")
    matched = F.col("provider").isNotNull()
    full = enriched.withColumns({
        "matched": matched, "cover": T.first_present("meta.poster", "poster"), "overview": T.first_present("meta.overview", "overview"), "_authority": authority,
        "external_id": L.external_id(F.coalesce("provider", F.lit("")), tmdb=F.col("meta.tmdb_id"), tvdb=F.col("meta.tvdb_id"), douban=F.col("meta.douban_id"), bilibili=F.col("meta.bilibili_season_id"), imdb=F.col("meta.imdb_id")),
    })
    reason = (
        F.when(matched & F.col("_authority").isNull(), "not_in_whitelist").when(T.present("cover").isNull(), "no_cover").when(T.present("overview").isNull(), "no_overview")
        .when(~matched, "all_sources_miss").when(F.col("confidence") < S.BANDS[1], "low_confidence").otherwise("")
    )
    full = full.withColumn("_reason", reason)
    audit = L.unmatched(full.withColumn("search_title", F.col("norm_title")), F.col("_reason"), F.lit(now))
    good = full.where("_reason = ''").withColumn("category", F.coalesce(F.nullif("_authority", F.lit("")), "category"))
    good = good.withColumn("key", L.group_key(F.col("external_id"), F.col("meta.tmdb_id"), F.col("meta.douban_id"), F.col("merge_key")))
    flat = good.select("key", "merge_key", "seq", "category", "sub_category", "matched", "cover", "overview", "provider", "confidence", F.coalesce(F.nullif("meta.title", F.lit("")), "raw_title").alias("title"), F.coalesce("meta.year", "year").alias("year"), "site", "meta.original_title", "meta.rating", "meta.genres", "meta.country", "meta.original_language", "meta.first_air_date", "meta.vote_count", "meta.popularity", "lines")
    head = L.filled(flat, ["key"], "merge_key", ("category", "sub_category", "matched", "cover", "overview", "provider", "confidence", "title", "site", *L.SCALARS))
    head = head.withColumns({"region": X.resolve_region(F.col("category"), F.col("matched"), F.col("country"), F.col("original_language"), F.col("sub_category"), rules), "group_name": X.resolve_group(F.col("matched"), F.col("genres"), F.col("sub_category"), rules)})
    series = flat.where("category <> 'movies'").select("key", F.col("seq").alias("season"), F.explode("lines").alias("l")).select("key", "season", "l.*")
    series = L.parsed_lines(series.withColumn("source", F.col("site")), "name", "place")
    nested = L.seasons(L.aligned_episodes(series, ["key", "season"], "place"), "key", "season")
    films = flat.where("category = 'movies'").groupBy("key").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("merge_key", "lines"))), lambda x: x["lines"])).alias("lines")).select("key", L.video_lines(F.col("lines")).alias("v")).select("key", "v.url", "v.url_type", "v.alt_urls")
    items = head.join(nested, "key", "left").join(films, "key", "left")
    bangou = F.when(F.col("key").startswith("b:"), F.substring("key", 3, 1000)).otherwise(F.concat(F.lit("v_"), F.md5("key")))
    return items.select(bangou.alias("bangou"), F.when(F.col("category") == "movies", "video").otherwise("series").alias("type"), *[c for c in items.columns if c not in ("key", "number_of_seasons", "number_of_episodes")], "number_of_seasons", "number_of_episodes"), audit


def run(raw: DataFrame, filters: Filters, registry: DataFrame, library: DataFrame, cache: DataFrame, providers: Sequence[V.Provider], now: int, this_year: int, quota: int = 200_000, settings=None) -> Outcome:
    """One run over harvested raw items (title, category, lines and so on). library: merge_key, payload (JSON) and state;
    cache: merge_key, status, expires, ts."""
    why = filters.reason(F.col("raw_title"), F.col("raw_title"), F.col("category"), F.col("sub_category"), F.col("lines"))
    judged = raw.withColumn("_why", why)
    reasons = judged.where("_why is not null").groupBy(F.col("_why").alias("reason")).agg(F.count("*").alias("n"))
    new = stored(entities(live_items(judged.where("_why is null").drop("_why"), registry)), "run-entities")
    payload = new.select("merge_key", F.to_json(F.struct(*new.columns)).alias("payload"), "last_updated", F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in L.WEIGHTS.items() for x in kv]), F.col("category")), F.lit(1.0)).alias("weight"))
    held = stored(K.library_after(library, payload, "merge_key", now).drop("branch"), "run-library")
    due = K.hot_batch(held, 500).select("merge_key").union(K.cold_batch(held, quota).select("merge_key")).distinct()
    pending = held.join(due, "merge_key", "left_semi").select(F.from_json("payload", new.schema).alias("p")).select("p.*")
    found = looked_up(K.to_look_up(pending, cache, "merge_key", now), providers, settings)
    results = pending.join(found, "merge_key", "left").withColumn("kind", F.when(F.col("provider").isNotNull(), "hit").otherwise("hard_miss"))
    results = stored(results, "run-results")
    after = K.merged_cache(cache, K.admitted_writes(results.select("merge_key", "kind", "year"), now, this_year).select("merge_key", "status", "expires", "ts"), "merge_key")
    outcome = results.select("merge_key", F.col("kind").alias("status"), "confidence", F.lit(None).cast("string").alias("payload"), F.lit(False).alias("backfilled"))
    items, unmatched = finished(results.drop("kind"), now)
    return Outcome(items, unmatched, K.advanced(held, outcome, "merge_key"), after, reasons)
