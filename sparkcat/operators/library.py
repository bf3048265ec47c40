"""The catalogue's own merges with their payload: coarse entities, episode alignment, final items, the quarantine.

Every order is explicit: lower `priority` is better (or higher, where asked), and `arrival` breaks ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import udf as U
from ..functions.episodes import KINDS
from .contract import EPISODE_TYPE, new_episode, new_season

#: Weights of categories in the cold lane's order (fixed values).
WEIGHTS = {"variety": 2.0}
#: The fields of an item that are filled from the first source that has them (fixed values).
SCALARS = ("source_provider", "provider", "canonical_title", "original_title", "year", "first_air_date", "overview", "rating", "rating_source", "vote_count", "runtime", "genres", "cast", "director", "country",
           "original_language", "studio", "logo", "certification", "popularity", "number_of_seasons", "number_of_episodes")


def coarse_entities(items: DataFrame, keys: Sequence[str], priority: str, lines: str, arrival: str, url: str = "url") -> DataFrame:
    """Per key: `primary`, the row with the least priority, most lines, first arrival; `siblings`, the others as they arrive;
    `lines`, the primary's and then the siblings', each URL once. Rows without lines are left out.

    Groups are assembled in one aggregate: a group's rows meet in one task, as they make one record.
    """
    rows = items.where(F.size(F.coalesce(F.col(lines), F.array().cast(items.schema[lines].dataType))) > 0)
    cols = [c for c in rows.columns if c not in keys]
    first = F.struct(F.coalesce(F.col(priority), F.lit(10)), -F.size(lines), F.col(arrival))
    grouped = rows.groupBy(*keys).agg(F.min_by(F.struct(*cols), first).alias("primary"), F.sort_array(F.collect_list(F.struct(F.col(arrival).alias("_a"), F.struct(*cols).alias("row")))).alias("_all"))
    others = F.transform(F.filter("_all", lambda x: x["_a"] != F.col(f"primary.{arrival}")), lambda x: x["row"])
    out = grouped.withColumn("siblings", others).drop("_all")
    every = F.concat(F.array(F.col(f"primary.{lines}")), F.transform("siblings", lambda s: s[lines]))
    return out.withColumn("lines", distinct_lines(F.flatten(every), url)).withColumn("line_count", F.size(F.col(f"primary.{lines}")))


def distinct_lines(lines: Column, url: str = "url") -> Column:
    """The first line of each URL (without scheme and closing slashes), in order; lines without a URL are left out."""
    there = F.filter(lines, lambda x: T.present(x[url]).isNotNull())
    # Sorted by URL, a line is its URL's first where the URL before it is another: no line is compared with all others, and
    # no lambda reads a whole array, which would be made anew for each line.
    by_key = F.array_sort(F.transform(there, lambda x, i: F.struct(T.url_key(F.trim(x[url])).alias("k"), i.alias("i"))))
    before = F.slice(F.concat(F.array(F.lit(None).cast("struct<k:string,i:int>")), by_key), F.lit(1), F.size(there))
    first = F.array_sort(F.zip_with(by_key, before, lambda x, b: F.struct(x["i"].alias("i"), (b.isNull() | (x["k"] != b["k"])).alias("first"))))
    kept = F.filter(F.zip_with(there, first, lambda x, f: F.struct(x.alias("line"), f["first"].alias("first"))), lambda z: z["first"])
    return F.transform(kept, lambda z: z["line"])


def parsed_lines(lines: DataFrame, name: str, order: str) -> DataFrame:
    """Add an episode name's parts and its alignment key (group of kinds, number, title)."""
    out = lines.withColumn("_e", U.parse_episode(name, order))
    group = F.when(F.col("_e.kind") == "episode", 0).when(F.col("_e.kind").isin("air_date", "air_date_extra"), 1).otherwise(2)
    title = F.when(F.col("_e.kind") == "unknown", F.coalesce(F.col(name), F.lit(""))).otherwise(F.col("_e.ep_title"))
    return out.select(*lines.columns, "_e.*", F.struct(group.alias("kind_group"), F.col("_e.ep_number").alias("number"), title.alias("title")).alias("align_key"))


def aligned_episodes(lines: DataFrame, keys: Sequence[str], arrival: str, alive: Column | None = None, higher_is_better: bool = False) -> DataFrame:
    """Per key and aligned episode: its main line and the others as alt_urls, each URL once.

    The main line is one whose domain is alive, then by priority, then by arrival. lines: url, url_type, priority, source,
    and what parsed_lines() adds.
    """
    rank = F.col("priority") * (-1 if higher_is_better else 1)
    order = F.struct(F.when(F.lit(True) if alive is None else alive, 0).otherwise(1).alias("dead"), rank.alias("rank"), F.col(arrival).alias("arrival"))
    seen = lines.where(T.present("url").isNotNull()).groupBy(*keys, "align_key", "url").agg(F.min_by(F.struct("url_type", "source", "kind", "ep_number", "ep_title", "air_date", "ep_end", order.alias("o")), order).alias("x"))
    every = F.sort_array(F.collect_list(F.struct(F.col("x.o"), "url", "x")))
    out = seen.groupBy(*keys, "align_key").agg(every.alias("l"))
    main = F.get("l", F.lit(0))
    alt = F.transform(F.slice("l", 2, F.greatest(F.size("l") - 1, F.lit(1))), lambda y: F.struct(F.coalesce(y["x"]["source"], F.lit("")).alias("source"), y["url"].alias("url"), F.coalesce(y["x"]["ep_title"], F.lit("")).alias("label"), F.lit("").alias("resolution"), F.coalesce(y["x"]["url_type"], F.lit("")).alias("url_type")))
    return out.select(*keys, *[main["x"][c].alias(c) for c in ("kind", "ep_number", "ep_title", "air_date", "ep_end")], main["url"].alias("url"), main["x"]["url_type"].alias("url_type"), main["x"]["source"].alias("source"), F.when(F.size("l") > 1, alt).otherwise(F.slice(alt, 1, 0)).alias("alt_urls"))


def kind_rank(kind: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), kind), F.lit(3))


def seasons(episodes: DataFrame, key: str, season: str) -> DataFrame:
    """Per item: `seasons` with their episodes in order (rank of kind, air date, number, title), and their numbers.

    A season of nothing but dated episodes is numbered 1 to n by date; number_of_episodes is the sum over seasons.
    """
    dated = F.col("kind").isin("air_date", "air_date_extra")
    e = F.struct(kind_rank(F.col("kind")).alias("r"), F.coalesce("air_date", F.lit("")).alias("d"), F.col("ep_number").cast("long").alias("n"), F.coalesce("ep_title", F.lit("")).alias("t"), "url", "url_type", "air_date", "alt_urls")
    per = episodes.groupBy(key, F.coalesce(F.col(season), F.lit(1)).alias("season_number")).agg(F.sort_array(F.collect_list(e)).alias("l"), F.min(dated.cast("int")).alias("dated"))
    built = F.transform("l", lambda x, i: new_episode(F.when(F.col("dated") == 1, i + 1).otherwise(x["n"]), x["url"], x["t"], x["url_type"], x["air_date"], x["alt_urls"]))
    per = per.select(key, "season_number", new_season(F.col("season_number"), episodes=built.cast(f"array<{EPISODE_TYPE}>")).alias("s"))
    out = per.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("season_number", "s"))).alias("l"))
    return out.select(key, F.transform("l", lambda x: x["s"]).alias("seasons"), F.size("l").alias("number_of_seasons"), F.aggregate("l", F.lit(0), lambda a, x: a + F.size(x["s"]["episodes"])).alias("number_of_episodes"))


def video_lines(lines: Column) -> Column:
    """(url, url_type, alt_urls, site) of an item without seasons: its line of least priority is the main one."""
    ranked = F.array_sort(F.transform(F.filter(lines, lambda x: T.present(x["url"]).isNotNull()), lambda x, i: F.struct(F.coalesce(x["priority"], F.lit(10)).alias("p"), i.alias("i"), x.alias("x"))))
    kind = lambda x: F.coalesce(T.present(x["url_type"]), T.url_type(x["url"]))
    first = F.get(ranked, F.lit(0))["x"]
    alt = F.transform(F.filter(ranked, lambda x, i: i > 0), lambda y: F.struct(F.coalesce(y["x"]["url_type"], F.lit("")).alias("source"), y["x"]["url"].alias("url"), F.coalesce(y["x"]["name"], F.lit("")).alias("label"), F.lit("").alias("resolution"), kind(y["x"]).alias("url_type")))
    return F.struct(first["url"].alias("url"), F.when(first.isNotNull(), kind(first)).alias("url_type"), alt.alias("alt_urls"), first["site"].alias("site"))


def is_missing(df: DataFrame, column: str) -> Column:
    """The catalogue's notion of a missing value: null, '', 0, or an empty list."""
    c, kind = F.col(column), df.schema[column].dataType.typeName()
    if kind in ("string", "varchar", "char"):
        return c.isNull() | (c == "")
    if kind == "array":
        return c.isNull() | (F.size(c) == 0)
    return c.isNull() | (c == 0) if kind in ("byte", "short", "integer", "long", "float", "double", "decimal") else c.isNull()


def filled(df: DataFrame, keys: Sequence[str], arrival: str, columns: Sequence[str] = SCALARS) -> DataFrame:
    """Per key, each column's first value in order of arrival that is not missing; columns the frame lacks are skipped."""
    there = [c for c in dict.fromkeys(columns) if c in df.columns]
    return df.groupBy(*keys).agg(*[F.min_by(F.when(~is_missing(df, c), F.col(c)), F.when(~is_missing(df, c), F.col(arrival))).alias(c) for c in there])


def overlaid(items: DataFrame, candidates: DataFrame, key: str, columns: Sequence[str], rewrite_title: Column) -> DataFrame:
    """Items with a candidate's values where it has some; canonical_title only if the title may be rewritten; a candidate's
    poster becomes the cover."""
    c = candidates.select(key, *[F.col(x).alias(f"_c_{x}") for x in candidates.columns if x != key])
    out = items.join(c, key, "left")
    there = lambda x: ~is_missing(out, f"_c_{x}")
    new = {x: F.when(there(x), F.col(f"_c_{x}")).otherwise(F.col(x)) if x in items.columns else F.col(f"_c_{x}") for x in columns if x in candidates.columns and x not in ("title", "poster")}
    if "title" in candidates.columns:
        new["canonical_title"] = F.when(rewrite_title & there("title"), F.col("_c_title"))
    if "poster" in candidates.columns:
        new["cover"] = F.when(there("poster"), F.col("_c_poster")).otherwise(F.col("cover") if "cover" in items.columns else F.lit(None).cast("string"))
    return out.withColumns(new).drop(*[f"_c_{x}" for x in candidates.columns if x != key])


def group_key(bangou: Column, tmdb: Column, douban: Column, merge_key: Column) -> Column:
    """What final items are merged by: the first of their ids."""
    part = lambda p, c: F.when(T.present(c.cast("string")).isNotNull(), F.concat(F.lit(p), F.trim(c.cast("string"))))
    return F.coalesce(part("b:", bangou), part("t:", tmdb), part("d:", douban), F.concat(F.lit("m:"), F.coalesce(merge_key, F.lit(""))))


def external_id(provider: Column, **ids: Column) -> Column:
    """provider_id by the provider's own id column: tmdb, tvdb, douban, bilibili or imdb; null where it has none."""
    p = F.lower(provider)
    ids = {k: T.present(v.cast("string")) for k, v in ids.items()}
    get = lambda n: ids.get(n, F.lit(None).cast("string"))
    return (
        F.when(p.isin("tmdb", "themoviedb"), F.concat(F.lit("tmdb_"), get("tmdb"))).when(p.isin("tvdb", "thetvdb"), F.concat(F.lit("tvdb_"), get("tvdb"))).when(p.isin("douban", "豆瓣"), F.concat(F.lit("douban_"), get("douban")))
        .when(p.isin("bilibili", "bili"), F.concat(F.lit("bili_"), get("bilibili"))).when(p.isin("omdb", "imdb"), F.concat(F.lit("imdb_"), get("imdb")))
    )


def unmatched(entities: DataFrame, reason: Column, as_of: Column) -> DataFrame:
    """Audit rows of entities with a reason to be kept out."""
    text = lambda *names: F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names if n in entities.columns], F.lit(""))
    there = lambda n, d: F.coalesce(F.col(n), F.lit(d)) if n in entities.columns else F.lit(d)
    lines = F.size(F.filter("lines", lambda x: T.present(x["url"]).isNotNull())) if "lines" in entities.columns else F.lit(0)
    rows = entities.withColumn("_reason", reason).where(F.coalesce("_reason", F.lit("")) != "")
    return rows.select(
        text("raw_title", "title").alias("raw_title"), text("search_title", "title").alias("search_title"), text("category").alias("category"), there("season", 1).cast("int").alias("season"), text("year").alias("year"), text("site").alias("site"),
        text("raw_id").alias("raw_id"), F.col("_reason").alias("reason"), text("provider", "source_provider").alias("provider"), (F.col("confidence") if "confidence" in entities.columns else F.lit(None)).cast("int").alias("confidence"),
        lines.alias("lines_count"), as_of.cast("double").alias("ts"),
    )
