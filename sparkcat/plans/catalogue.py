"""Queries on the catalogue's own operators: scoring, contract, taxonomy, merges with payload, state, sources, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import taxonomy as X
from ..functions import text as T
from ..functions import udf as U
from ..operators import admission as A
from ..operators import contract as C
from ..operators import library as L
from ..operators import prefilter as P
from ..operators import report as R
from ..operators import scoring as S
from ..operators import state as K
from ..session import shared_folder
from ..sources import providers as V
from ..sources import sinks
from .catalog import query, table
from .texts_streams import _values

NOW = 1_000_000_000

#: (title, category, year, seq, episodes), (candidate's title, original, year, media type, popularity, episodes), (score, kind, reject)
SCORES = [
    (("弗雷德有问题", "movies", None, 1, 0), ("Fred Has Problems", "Fred Has Problems", None, "movie", 0.0, 0), (79, "translation_pair", None)),
    (("新兵第四季", "tv", None, 4, 0), ("菜鸟炊事兵", "", None, "tv", 3.0, 0), (28, "", None)),
    (("诅咒2025", "movies", "2025", 1, 0), ("死神来了6", "Final", "2025", "movie", 9.0, 0), (0, "", "name_unrelated")),
    (("家1", "movies", None, 1, 0), ("屋下無人", "", None, "movie", 0.0, 0), (0, "", "name_unrelated")),
    (("无间道2", "movies", "2003", 2, 0), ("無間道2", "", "2003", "movie", 99.0, 0), (100, "exact", None)),
    (("无间道", "movies", "2003", 1, 0), ("无间道", "", "2008", "movie", 0.0, 0), (81, "exact", None)),
    (("无间道", "movies", "2003", 1, 0), ("无间道", "", None, "tv", 0.0, 0), (79, "exact", None)),
    (("无间道", "movies", "2003", 1, 0), ("有间道路", "", "2010", "movie", 0.0, 0), (0, "fuzzy", "year_far")),
    (("abc", "tv", "2003", 1, 10), ("xbz", "", "2003", "movie", 0.0, 12), (0, "", "type_mismatch")),
    (("庆余年", "tv", "2019", 2, 36), ("庆余年", "", "2020", "tv", 9.0, 36), (79, "exact", None)),
]


@query("q_scorer_golden", f"select title, cand_title, media_type, cand_year::varchar as cand_year, score::int as score, match_kind, reject::varchar as reject from (values {_values([(a[0], b[0], b[3], b[2], *c) for a, b, c in SCORES])}) t(title, cand_title, media_type, cand_year, score, match_kind, reject)")
def scorer_golden(spark, d):
    pairs = spark.createDataFrame([(*a, *b) for a, b, _ in SCORES], "title string, category string, year string, seq int, episodes int, cand_title string, cand_original string, cand_year string, media_type string, popularity double, cand_episodes int")
    return S.scored(pairs).select("title", "cand_title", "media_type", "cand_year", "score", "match_kind", "reject")


_PRIOR = "case when p_retailprice > 0 then least(5.0, log10(p_retailprice + 1)) else 0 end"


@query("q_candidate_best", f"""with c as (select p_name, p_partkey, p_retailprice, p_size, row_number() over (partition by p_name order by p_partkey) as pos from part),
 f as (select p_name, p_partkey, pos, round_even(100 * (40 + 8 + case when p_size % 2 = 0 then 10 else 0 end + {_PRIOR}) / 70 + 10, 0)::int as s from c where pos <= 5),
 g as (select p_name, p_partkey, pos, greatest(0, least(100, s)) as s from f)
 select p_name as item, arg_min(p_partkey, (-s, pos)) as best, max(s)::int as score from g group by 1""")
def candidate_best(spark, d):
    """Items and candidates of one name: full likeness, so the score is plain arithmetic."""
    p = table(spark, d, "part")
    cands = p.select(F.col("p_name").alias("item"), F.col("p_partkey").alias("id"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("cand_title"), F.col("p_retailprice").alias("popularity"), F.when(F.col("p_size") % 2 == 0, "movie").otherwise("tv").alias("media_type"))
    pairs = cands.withColumns({"title": F.col("item"), "category": F.lit("movies"), "year": F.lit(None).cast("string"), "seq": F.lit(1), "episodes": F.lit(0), "cand_original": F.lit(""), "cand_year": F.lit(None).cast("string"), "cand_episodes": F.lit(0), "source": F.lit("tmdb")})
    return S.best_candidates(pairs, "item", "source", "pos").select("item", F.col("id").alias("best"), "score")


@query("q_source_order", "select c_custkey, case when c_custkey % 2 = 0 then 'tmdb' when c_custkey % 3 = 0 then 'douban' else 'omdb' end as source from customer where c_custkey % 5 <> 0 or c_custkey % 2 = 0")
def source_order(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    k = F.col("c_custkey")
    best = c.select("c_custkey", F.explode(F.array(*[F.struct(F.lit(s).alias("source"), x.alias("score")) for s, x in (("omdb", F.when(k % 5 == 0, 50).otherwise(90)), ("douban", F.when((k % 3 == 0) & (k % 5 != 0), 60).otherwise(54)), ("tmdb", F.when(k % 2 == 0, 55).otherwise(10)))])).alias("x")).select("c_custkey", "x.*")
    return S.first_hits(best, "c_custkey", "source", V.ORDER).select("c_custkey", "source")


def _records(spark, d):
    """An item per order as JSON text, with flaws by its key."""
    k = F.col("o_orderkey")
    has = lambda n, when, other="null": F.when(when, F.lit(n)).otherwise(F.lit(other))
    episode = F.concat(F.lit('{"ep_number":'), has("1", k % 7 != 0, '"1"'), F.lit(',"url":"'), has("u", k % 11 != 0, ""), F.lit('","air_date":"'), has("2020-01-01", k % 13 != 0, "2020"), F.lit('"}'))
    season = F.concat(F.lit('{"season_number":'), (k % 3).cast("string"), F.lit(',"episodes":['), episode, F.lit("]}"))
    text = F.concat(
        F.lit('{"bangou":"b'), k.cast("string"), F.lit('","type":"'), has("series", k % 2 == 0, "video"), F.lit('","title":"t","cover":"'), has("c", k % 5 != 0, " "), F.lit('","overview":"o","region":"'), has("电影", k % 17 != 0, "x"),
        F.lit('","group_name":"g","site":"s","year":"'), has("2003", k % 19 != 0, "03"), F.lit('","status":"ongoing","tags":"a","genres":["x"],"rating":'), has("8.5", k % 23 != 0, '"x"'), F.lit(',"vote_count":'), has("3", k % 29 != 0, '"3"'),
        F.lit(',"url":"u","confidence":'), (k % 100).cast("string"), F.lit(',"seasons":['), season, F.lit(","), season, F.lit("]}"),
    )
    return table(spark, d, "orders").select("o_orderkey", F.parse_json(text).alias("v"))


_SEASON_FLAWS = "case when o_orderkey % 7 = 0 then 'seasons[{0}].episodes[0].ep_number: not an integer' end, case when o_orderkey % 11 = 0 then 'seasons[{0}].episodes[0].url: empty' end"
_ERRORS = f"""concat_ws(',', case when o_orderkey % 5 = 0 then 'cover: empty' end, case when o_orderkey % 19 = 0 then 'year: not a year' end, case when o_orderkey % 23 = 0 then 'rating: not a number' end, case when o_orderkey % 29 = 0 then 'vote_count: not an integer' end,
 case when o_orderkey % 2 = 0 then concat_ws(',', {_SEASON_FLAWS.format(0)}, 'seasons[1].season_number: repeated', {_SEASON_FLAWS.format(1)}) end,
 case when o_orderkey % 5 = 0 then 'gate: no_cover' when o_orderkey % 100 < 55 then 'gate: low_confidence' end)"""


@query("q_contract_validate", f"""select o_orderkey, {_ERRORS} as errors, concat_ws(',', case when o_orderkey % 17 = 0 then 'region: unusual' end,
 case when o_orderkey % 2 = 0 and o_orderkey % 13 = 0 then 'seasons[0].episodes[0].air_date: not a date,seasons[1].episodes[0].air_date: not a date' end) as warnings, {_ERRORS} = '' as ok from orders""")
def contract_validate(spark, d):
    r = _records(spark, d).select("o_orderkey", C.validated(F.col("v"), require_gate=True).alias("r"))
    return r.select("o_orderkey", F.array_join("r.errors", ",").alias("errors"), F.array_join("r.warnings", ",").alias("warnings"), "r.ok")


@query("q_contract_summary", "select count(*) as total, count(*) filter (where ok) as ok, count(*) filter (where not ok) as failed from (select o_orderkey % 5 <> 0 and o_orderkey % 19 <> 0 and o_orderkey % 23 <> 0 and o_orderkey % 29 <> 0 and o_orderkey % 17 <> 0 and o_orderkey % 2 <> 0 as ok from orders)")
def contract_summary(spark, d):
    return C.summary(_records(spark, d), F.col("v"), strict=True)


@query("q_contract_coerce", """select o_orderkey, case when o_orderkey % 23 = 0 then null else 8.5 end::double as rating, 3::bigint as vote_count, 1::bigint as ep_number, '' as backdrop, 2 as n_seasons,
 concat_ws(',', case when o_orderkey % 23 = 0 then 'rating: not a number, to null' end, case when o_orderkey % 29 = 0 then 'vote_count: to integer' end,
  case when o_orderkey % 7 = 0 then 'seasons[0].episodes[0].ep_number: to integer,seasons[1].episodes[0].ep_number: to integer' end) as changes from orders""")
def contract_coerce(spark, d):
    r = _records(spark, d).select("o_orderkey", C.coerced(F.col("v")).alias("r"))
    return r.select("o_orderkey", "r.item.rating", "r.item.vote_count", F.col("r.item.seasons")[1]["episodes"][0]["ep_number"].alias("ep_number"), "r.item.backdrop", F.size("r.item.seasons").alias("n_seasons"), F.array_join("r.changes", ",").alias("changes"))


@query("q_contract_template", "select c_custkey, c_name as bangou, 'video' as type, 'completed' as status, 0::bigint as runtime, null::double as rating, '第 ' || (c_custkey % 4) || ' 季' as season_title, '第' || c_custkey || '集' as ep_title, 'm3u8' as url_type from customer")
def contract_template(spark, d):
    k = F.col("c_custkey")
    x = table(spark, d, "customer").select("c_custkey", C.blank_item(F.col("c_name"), F.lit(""), F.lit("other")).alias("i"), C.new_season(k % 4).alias("s"), C.new_episode(k, F.lit("http://x/y.m3u8")).alias("e"))
    return x.select("c_custkey", "i.bangou", "i.type", "i.status", "i.runtime", "i.rating", "s.season_title", "e.ep_title", "e.url_type")


@query("q_category_authority", """with p as (select p_partkey, ['TMDB','豆瓣','OMDb','Bilibili','TheTVDB','other'][1 + p_size % 6] as provider, case when p_size % 7 = 0 then '' when p_size % 2 = 0 then 'movie' else case p_size % 6 when 2 then 'series' else 'tv' end end as signal,
  ['剧情','动画','真人秀','纪录'][1 + p_partkey % 4] as genre from part),
 s as (select *, case genre when '纪录' then null when '动画' then 'anime' when '真人秀' then 'variety' else 'tv' end as series from p)
 select p_partkey, case provider when 'TMDB' then case when signal = '' then '' when signal = 'movie' then case when genre = '纪录' then null else 'movies' end else series end
  when '豆瓣' then case when signal = '' then '' when genre = '纪录' then null when signal = 'tv' then series else 'movies' end
  when 'OMDb' then case when signal = '' then '' when genre = '纪录' then null when signal = 'series' then series when signal = 'movie' then case when genre = '动画' then 'anime' else 'movies' end else null end
  when 'Bilibili' then 'anime' when 'TheTVDB' then series else '' end as category from s""")
def category_authority(spark, d):
    size, k = F.col("p_size"), F.col("p_partkey")
    pick = lambda xs, i: F.get(F.array(*map(F.lit, xs)), i)
    provider = pick(["TMDB", "豆瓣", "OMDb", "Bilibili", "TheTVDB", "other"], size % 6)
    signal = F.when(size % 7 == 0, "").when(size % 2 == 0, "movie").otherwise(F.when(size % 6 == 2, "series").otherwise("tv"))
    genres = F.array(F.lit("剧情"), pick(["剧情", "动画", "真人秀", "纪录"], (k % 4).cast("int")))
    return table(spark, d, "part").select("p_partkey", X.authoritative_category(provider, signal, genres)["category"].alias("category"))


CATEGORIES = [("电影", None, "movies"), ("TV-Series", None, "tv"), ("国漫", None, "anime"), ("其他", "日韩综艺", "variety"), ("其他", "国产动画", "anime"), ("动作片", None, "movies"), ("???", None, "tv"), (None, "韩剧", "tv"), ("Talk_Show", "电影", "variety")]
REGIONS = [
    ("tv", True, "泰国", None, None, "海外剧"), ("tv", True, "Narnia, USA", None, None, "美剧"), ("tv", True, "", "ja,en", "国产", "日韩剧"), ("tv", False, "泰国", None, "韩国剧", "日韩剧"), ("tv", False, None, None, "港剧", "国产剧"), ("tv", False, None, None, "翡翠", "其他剧"),
    ("movies", True, "US", None, None, "电影"), ("anime", False, None, None, None, "动漫"), ("variety", False, None, None, None, "综艺"), ("", False, None, None, None, "电影"), ("tv", True, "Hong Kong", None, None, "其他剧"), ("tv", True, "香港、韩国", None, None, "国产剧"),
]
GROUPS = [(True, ["Sci-Fi", "动作"], None, "科幻"), (True, ["美剧", "Drama"], None, "剧情"), (False, ["Drama"], "国产爱情片", "爱情"), (False, [], "欧美 恐怖片", "恐怖"), (False, None, "热门推荐", "未分类"), (True, [], "古装剧", "古装"), (False, None, None, "未分类")]


def _q(x):
    return "null" if x is None else str(x).lower() if isinstance(x, bool) else "'" + x + "'"


@query("q_category_golden", f"select raw::varchar as raw, sub::varchar as sub, category from (values {', '.join('(' + ', '.join(map(_q, r)) + ')' for r in CATEGORIES)}) t(raw, sub, category)")
def category_golden(spark, d):
    return spark.createDataFrame([r[:2] for r in CATEGORIES], "raw string, sub string").select("raw", "sub", X.normalize_category(F.col("raw"), F.col("sub")).alias("category"))


@query("q_region_golden", f"select * from (values {', '.join('(' + ', '.join(map(_q, r)) + ')' for r in REGIONS)}) t(category, matched, country, lang, sub, region)")
def region_golden(spark, d):
    raw = spark.createDataFrame([r[:5] for r in REGIONS], "category string, matched boolean, country string, lang string, sub string")
    return raw.select("*", X.resolve_region(*[F.col(c) for c in raw.columns]).alias("region"))


@query("q_group_golden", f"select matched, genres, sub::varchar as sub, grp from (values {', '.join('(' + ', '.join((_q(m), _q('+'.join(g or [])), _q(s), _q(r))) + ')' for m, g, s, r in GROUPS)}) t(matched, genres, sub, grp)")
def group_golden(spark, d):
    raw = spark.createDataFrame([r[:3] for r in GROUPS], "matched boolean, genres array<string>, sub string")
    return raw.select("matched", F.array_join(F.coalesce("genres", F.array().cast("array<string>")), "+").alias("genres"), "sub", X.resolve_group(F.col("matched"), F.col("genres"), F.col("sub")).alias("grp"))


@query("q_region_overlay", "select n_nationkey, case when n_nationkey < 5 then 'near' when n_nationkey = 6 then '美剧' else '' end as region, case when n_nationkey % 3 = 0 then '国产剧' else n_name end as current from nation")
def region_overlay(spark, d):
    """Settings add countries and rename nothing else; old region names become present ones."""
    rules = X.Rules().overlaid({"REGION_RULES": {"country_map": {f"n{i}": "near" for i in range(5)}}})
    k = F.col("n_nationkey")
    country = F.when(k == 6, "France").otherwise(F.concat(F.lit("n"), k.cast("string")))
    return table(spark, d, "nation").select("n_nationkey", X.region_of(country, rules.countries).alias("region"), X.current_region(F.when(k % 3 == 0, "港台剧").otherwise(F.col("n_name"))).alias("current"))


FULL_TITLES = [
    ("XX第二系列", "xx", 2, None, "", "tv|xx|2"), ("abc part 2", "abc", 2, None, "", "tv|abc|2"), ("无间道III", "无间道", 3, None, "", "tv|无间道|3"), ("庆余年 无删减版 1080p", "庆余年", 1, None, "1080p,无删减,无删减版", "tv|庆余年|1"),
    ("某剧 更新至第12集", "某剧", 1, None, "更新", "tv|某剧|1"), ("某剧全40集", "某剧", 1, None, "", "tv|某剧|1"), ("[字幕组]某剧 S2", "某剧", 2, None, "", "tv|某剧|2"), ("2012", "2012", 1, None, "", "tv|2012|1"), ("", "", 1, None, "", "tv||1"), ("某剧12", "某剧", 12, None, "", "tv|某剧|12"),
    ("某剧第十二季（2020）", "某剧", 12, "2020", "", "tv|某剧|12"), ("CSI", "csi", 1, None, "", "tv|csi|1"), ("馀生", "余生", 1, None, "", "tv|余生|1"),
]
FULL_EPISODES = [
    ("00", 2, "extra", 0, "00", None, "预告/花絮"), ("第0集", 2, "extra", 0, "第0集", None, "预告/花絮"), ("SP1", 2, "extra", 0, "SP1", None, "衍生#1"), ("第01集 大结局", 2, "episode", 1, "第1集", None, "大结局"), ("更新至12集", 2, "unknown", 2, "更新至12集", None, ""),
    ("第1期上", 2, "episode", 1, "第1期上", None, "上"), ("2026-08-22 花絮", 2, "air_date_extra", 20260822, "2026-08-22 花絮", None, "花絮"), ("第12话 完结", 2, "episode", 12, "第12话", None, "完结"), ("第1-20集", 2, "episode", 1, "第1-20集", 20, ""), ("超前营业第1期", 2, "episode", 1, "超前营业第1期", None, "超前营业"),
    ("OVA", 2, "extra", 0, "OVA", None, "预告/花絮/衍生"), ("全集完结 1080p", 2, "episode", 1, "正片", None, "full"), ("20261345", 2, "unknown", 2, "20261345", None, ""), ("第五话", 2, "episode", 5, "第5话", None, ""), ("", 3, "unknown", 3, "", None, ""),
]


@query("q_title_full", f"select raw, norm_title, seq::int as seq, year::varchar as year, quality_tags, merge_key, regexp_replace(merge_key, '[|][0-9]+$', '') as merge_group from (values {_values(FULL_TITLES)}) t(raw, norm_title, seq, year, quality_tags, merge_key)")
def title_full(spark, d):
    raw = spark.createDataFrame([(t[0],) for t in FULL_TITLES], "raw string")
    return raw.select("raw", U.parse_title_fully("raw", F.lit("tv")).alias("p")).select("raw", "p.*").withColumn("quality_tags", F.array_join("quality_tags", ","))


@query("q_episode_full", f"select name, kind, ep_number::int as ep_number, ep_title, ep_end::int as ep_end, note from (values {_values([(a, *r) for a, _, *r in FULL_EPISODES])}) t(name, kind, ep_number, ep_title, ep_end, note)")
def episode_full(spark, d):
    raw = spark.createDataFrame([e[:2] for e in FULL_EPISODES], "name string, ord int")
    return raw.select("name", U.parse_episode("name", "ord").alias("p")).select("name", "p.kind", "p.ep_number", "p.ep_title", "p.ep_end", "p.note")


@query("q_seq_of_titles", "select p_partkey, case when p_size > 1 then p_size end::int as seq from part")
def seq_of_titles(spark, d):
    return table(spark, d, "part").select("p_partkey", U.parse_seq(F.concat(F.lit("show season "), F.col("p_size").cast("string"))).alias("seq"))


@query("q_prefilter_layers", """select p_partkey, case when p_type = 'ECONOMY' then 'L1|分类白名单外:ECONOMY' when p_size % 6 = 0 then 'L2|分类黑名单:anime' when p_size % 6 = 1 then 'L3|子分类黑词:短剧预告' when regexp_matches(p_name, '^[a-c]') then 'L4|标题命中正则:^[a-c]'
 when contains(p_name, 'green') then 'L4|标题黑词:green' when p_size % 6 = 2 then 'L5|空标题' when p_size % 6 = 3 then 'L5|无有效线路' when p_size % 6 = 4 then 'L5|线路无有效地址' end as reason from part where p_size % 6 <> 2 or p_type <> 'x'""".replace("regexp_matches(p_name", "p_size % 6 <> 2 and regexp_matches(p_name").replace("contains(p_name", "p_size % 6 <> 2 and contains(p_name"))
def prefilter_layers(spark, d):
    rules = P.Filters.of({"prefilter": {"skip_categories": ["anime"], "sub_category_blacklist": ["预告", "短剧预告"], "title_regex_blacklist": ["^[a-c]", "(bad"], "title_keywords": ["green"]}, "crawl_skip_type_keywords": ["预告"]})
    k = F.col("p_size") % 6
    lines = F.when(k == 3, F.array().cast("array<struct<episodes:array<struct<url:string>>>>")).otherwise(F.array(F.struct(F.array(F.struct(F.when(k == 4, "ftp://x").otherwise("https://x/y").alias("url"))).alias("episodes"))))
    category = F.when(F.col("p_type") == "ECONOMY", F.col("p_type")).when(k == 0, "anime").otherwise("movies")
    title = F.when(k == 2, "").otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", rules.reason(title, title, category, F.when(k == 1, "短剧预告片").otherwise(""), lines).alias("reason"))


@query("q_is_old", "select o_orderkey, case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y-%m-%d') < '1998-03-01' when 1 then year(o_orderdate) < 1998 when 2 then false else strftime(o_orderdate, '%Y-%m-%d') < '1998-03-01' end as old from orders")
def is_old(spark, d):
    k, day = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyy-MM-dd")
    first = F.when(k == 0, F.concat(F.lit("on "), day)).when(k == 1, F.date_format("o_orderdate", "yyyy")).when(k == 2, "soon").otherwise("")
    return table(spark, d, "orders").select("o_orderkey", P.is_old(F.lit("1998-03-01"), first, day).alias("old"))


@query("q_items_verified", """with l as (select l_orderkey, arg_min(l_suppkey, (l_linenumber, l_suppkey, l_partkey)) as first, string_agg(case when l_suppkey % 2 = 0 then l_suppkey end, ',' order by l_linenumber, l_suppkey, l_partkey) as up from lineitem group by 1)
 select l_orderkey, up is not null as alive, case when first % 2 = 0 then first when up is not null then split_part(up, ',', 1)::bigint else first end as main from l""")
def items_verified(spark, d):
    """Lines in order are a video's URL and alternatives; suppliers with even keys are alive."""
    l = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey"))).alias("l"))
    url = lambda x: F.concat(F.lit("https://x/"), x["l_suppkey"].cast("string"))
    number = lambda u: F.regexp_extract(u, "([0-9]+)$", 1).cast("long")
    alts = F.transform(F.filter("l", lambda x, i: i > 0), lambda x: F.struct(url(x).alias("url")))
    none = F.lit(None).cast("array<struct<episodes:array<struct<url:string,alt_urls:array<struct<url:string>>>>>>")
    v = l.select("l_orderkey", P.verified(F.lit("video"), url(F.col("l")[0]), alts, none, lambda u: number(u) % 2 == 0).alias("v"))
    return v.select("l_orderkey", "v.alive", number(F.col("v.url")).alias("main"))


@query("q_coarse_entities", """with i as (select p_type || '|' || p_name as k, p_partkey, p_size % 3 as prio, ['https://x/' || p_brand, 'http://y/' || p_size][1:1 + (p_size % 2 = 0)::int] as urls from part),
 m as (select k, arg_min(p_partkey, (prio, -len(urls), p_partkey)) as main from i group by 1),
 s as (select k, string_agg(case when p_partkey <> main then p_partkey end, ',' order by p_partkey) as siblings from i join m using (k) group by 1),
 u as (select k, (p_partkey <> main)::int as o, p_partkey, unnest(urls) as url, generate_subscripts(urls, 1) as idx from i join m using (k)),
 f as (select k, regexp_replace(url, '^[a-z]+://', '') as key, min((o, p_partkey, idx)) as w from u group by 1, 2), g as (select k, string_agg(key, ',' order by w) as lines from f group by 1)
 select k, main, coalesce(siblings, '') as siblings, lines from m join s using (k) join g using (k)""")
def coarse_entities(spark, d):
    line = lambda u: F.struct(u.alias("url"))
    urls = [line(F.concat(F.lit("https://x/"), "p_brand")), line(F.concat(F.lit("http://y/"), F.col("p_size").cast("string")))]
    p = table(spark, d, "part").select(F.concat_ws("|", "p_type", "p_name").alias("k"), "p_partkey", (F.col("p_size") % 3).alias("priority"), F.when(F.col("p_size") % 2 == 0, F.array(*urls)).otherwise(F.array(urls[0])).alias("lines"))
    e = L.coarse_entities(p, ["k"], "priority", "lines", "p_partkey")
    text = lambda a, f: F.array_join(F.transform(a, f), ",")
    return e.select("k", F.col("primary.p_partkey").alias("main"), text("siblings", lambda s: s["p_partkey"].cast("string")).alias("siblings"), text("lines", lambda x: T.url_key(x["url"])).alias("lines"))


@query("q_aligned_episodes", """with u as (select l_orderkey, l_linenumber, l_partkey, min(((l_returnflag = 'R')::int, l_quantity::int, l_suppkey)) as o from lineitem group by 1, 2, 3)
 select l_orderkey, l_linenumber::int as ep_number, arg_min(l_partkey, (o, l_partkey)) as main, string_agg(l_partkey, ',' order by o, l_partkey) as every from u group by 1, 2""")
def aligned_episodes(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", F.concat(F.lit("第"), F.col("l_linenumber").cast("string"), F.lit("集")).alias("name"), F.lpad(F.col("l_partkey").cast("string"), 9, "0").alias("url"), F.lit("m3u8").alias("url_type"), F.col("l_quantity").cast("int").alias("priority"), F.col("l_suppkey").alias("arrival"), F.lit("s").alias("source"), F.lit(1).alias("ord"))
    out = L.aligned_episodes(L.parsed_lines(x, "name", "ord"), ["l_orderkey"], "arrival", F.col("l_returnflag") != "R")
    number = lambda u: u.cast("long").cast("string")
    return out.select("l_orderkey", "ep_number", F.col("url").cast("long").alias("main"), F.array_join(F.concat(F.array(number(F.col("url"))), F.transform("alt_urls", lambda a: number(a["url"]))), ",").alias("every"))


@query("q_dated_seasons", """with e as (select o_custkey, year(o_orderdate)::int as y, strftime(o_orderdate, '%Y-%m-%d') as day, min(o_orderkey) as url from orders group by 1, 2, 3),
 n as (select *, row_number() over (partition by o_custkey, y order by day) as i from e)
 select o_custkey, count(distinct y)::int as number_of_seasons, count(*)::int as number_of_episodes, string_agg(y || '.' || i || ':' || day || ':' || url, ',' order by y, i) as episodes from n group by 1""")
def dated_seasons(spark, d):
    """Orders of a year are a season's dated episodes, numbered by date; orders of a day are lines of one."""
    o = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("season"), F.concat(F.lit("第"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("期")).alias("name"), F.col("o_orderkey").cast("string").alias("url"), F.col("o_orderkey").alias("arrival"), F.lit(1).alias("priority"), F.lit("m3u8").alias("url_type"), F.lit("s").alias("source"), F.lit(1).alias("ord"))
    s = L.seasons(L.aligned_episodes(L.parsed_lines(o, "name", "ord"), ["o_custkey", "season"], "arrival"), "o_custkey", "season")
    each = F.flatten(F.transform("seasons", lambda x: F.transform(x["episodes"], lambda e: F.concat(x["season_number"].cast("string"), F.lit("."), e["ep_number"].cast("string"), F.lit(":"), e["air_date"], F.lit(":"), e["url"]))))
    return s.select("o_custkey", "number_of_seasons", "number_of_episodes", F.array_join(each, ",").alias("episodes"))


@query("q_video_lines", "select l_orderkey, arg_min(l_partkey, (l_suppkey, l_linenumber, l_partkey)) as main, count(*)::int - 1 as others from lineitem group by 1")
def video_lines(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", F.col("l_suppkey").cast("int").alias("priority"), F.concat(F.lit("https://x/"), F.col("l_partkey").cast("string")).alias("url"), F.lit("").alias("url_type"), F.lit("n").alias("name"), F.lit("s").alias("site")))).alias("lines"))
    v = x.select("l_orderkey", L.video_lines(F.col("lines")).alias("v"))
    return v.select("l_orderkey", F.regexp_extract("v.url", "([0-9]+)$", 1).cast("long").alias("main"), F.size("v.alt_urls").alias("others"))


@query("q_fill_columns", """select o_custkey, arg_min(o_totalprice, o_orderkey) filter (where o_orderkey % 3 <> 0 and o_totalprice <> 0) as rating, arg_min(o_orderpriority, o_orderkey) filter (where o_orderkey % 5 <> 0) as overview,
 arg_min(o_orderkey, o_orderkey) filter (where o_orderkey % 2 = 0) as first_genre from orders group by 1""")
def fill_columns(spark, d):
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(k % 3 != 0, F.col("o_totalprice")).otherwise(0.0).alias("rating"), F.when(k % 5 != 0, F.col("o_orderpriority")).otherwise("").alias("overview"), F.when(k % 2 == 0, F.array(k)).otherwise(F.array().cast("array<bigint>")).alias("genres"))
    return L.filled(o, ["o_custkey"], "o_orderkey").select("o_custkey", "rating", "overview", F.col("genres")[0].alias("first_genre"))


@query("q_overlay_candidates", "select c_custkey, coalesce(nullif(case when c_custkey % 3 = 0 then '' else s_name end, ''), c_name) as overview, case when c_custkey % 2 = 0 then s_name end as canonical_title, coalesce(s_name, 'own') as cover from customer left join (select s_nationkey, min(s_name) as s_name from supplier group by 1) on s_nationkey = c_nationkey")
def overlay_candidates(spark, d):
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.min("s_name").alias("n"))
    c = table(spark, d, "customer")
    cand = c.join(s, "c_nationkey").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("n")).alias("overview"), F.col("n").alias("title"), F.col("n").alias("poster"))
    items = c.select("c_custkey", F.col("c_name").alias("overview"), F.lit("own").alias("cover"))
    return L.overlaid(items, cand, "c_custkey", ["overview", "title"], F.col("c_custkey") % 2 == 0).select("c_custkey", "overview", "canonical_title", "cover")


@query("q_external_ids", """select p_partkey, case p_size % 6 when 0 then 'tmdb_' || p_partkey when 1 then 'tvdb_' || p_partkey when 2 then 'douban_' || p_partkey when 3 then 'bili_' || p_partkey when 4 then 'imdb_tt' || p_partkey end as id,
 case when p_size % 4 = 0 then 'b:x' || p_partkey when p_size % 4 = 1 then 't:' || p_partkey when p_size % 4 = 2 then 'd:' || p_partkey else 'm:' || p_name end as key from part""")
def external_ids(spark, d):
    k, s = F.col("p_partkey"), F.col("p_size")
    provider = F.get(F.array(*map(F.lit, ["TMDB", "TheTVDB", "豆瓣", "Bilibili", "OMDb", "other"])), s % 6)
    when = lambda i, v: F.when(s % 4 == i, v)
    return table(spark, d, "part").select(
        "p_partkey", L.external_id(provider, tmdb=k, tvdb=k, douban=k, bilibili=k, imdb=F.concat(F.lit("tt"), k.cast("string"))).alias("id"),
        L.group_key(when(0, F.concat(F.lit("x"), k.cast("string"))), when(1, k), when(2, k), F.col("p_name")).alias("key"))


@query("q_unmatched_rows", "select c_name as raw_title, c_name as search_title, 'movies' as category, 1 as season, '' as year, '' as site, '' as raw_id, case when c_custkey % 3 = 0 then 'no_cover' else 'low_confidence' end as reason, 'tmdb' as provider, (c_custkey % 100)::int as confidence, 1 as lines_count, 5.0::double as ts from customer where c_custkey % 3 < 2")
def unmatched_rows(spark, d):
    k = F.col("c_custkey")
    e = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("title"), F.lit("movies").alias("category"), F.lit("tmdb").alias("provider"), (k % 100).alias("confidence"), F.array(F.struct(F.lit("u").alias("url")), F.struct(F.lit("").alias("url"))).alias("lines"))
    return L.unmatched(e, F.when(k % 3 == 0, "no_cover").when(k % 3 == 1, "low_confidence").otherwise(""), F.lit(5.0))


def _cache(spark, d):
    k = F.col("o_orderkey")
    kind = F.when(k % 3 == 0, "hit").when(k % 3 == 1, "soft_miss").otherwise("hard_miss")
    return table(spark, d, "orders").where("o_orderkey % 4 <> 3").select("o_orderkey", kind.alias("status"), (F.lit(NOW) + F.when(k % 5 == 0, -1).otherwise(1)).alias("expires"), F.lit(7).alias("ts"))


_STATUS = "case when o_orderkey % 4 = 3 then 'none' when o_orderkey % 5 = 0 then {} when o_orderkey % 3 = 0 then 'hit' when o_orderkey % 3 = 1 then 'soft_miss' else 'hard_miss' end"


@query("q_cache_kinds", f"select o_orderkey, {_STATUS.format(chr(39) + 'none' + chr(39))} as cache_status, {_STATUS.format(chr(39) + 'stale' + chr(39))} as with_stale, o_orderkey % 4 = 3 or o_orderkey % 5 = 0 as to_look_up from orders")
def cache_kinds(spark, d):
    o, cache = table(spark, d, "orders").select("o_orderkey"), _cache(spark, d)
    out = K.cache_lookup(o, cache, "o_orderkey", NOW).select("o_orderkey", "cache_status").join(K.cache_lookup(o, cache, "o_orderkey", NOW, True).select("o_orderkey", F.col("cache_status").alias("with_stale")), "o_orderkey")
    return out.join(K.to_look_up(o, cache, "o_orderkey", NOW).withColumn("to_look_up", F.lit(True)), "o_orderkey", "left").fillna(False, ["to_look_up"])


@query("q_cache_writes", f"""with r as (select o_orderkey, ['hit','soft_miss','hard_miss','retryable'][1 + o_orderkey % 4] as status, year(o_orderdate) as y from orders where o_orderkey % 2 = 0)
 select o_orderkey, status, ({NOW} + 86400 * case when status = 'hit' then 90 when status = 'soft_miss' then 14 when y <= 1998 then 90 else 45 end)::bigint as expires from r where status = 'hit' or (status <> 'retryable' and o_orderkey % 10 <> 0)""")
def cache_writes(spark, d):
    k = F.col("o_orderkey")
    r = table(spark, d, "orders").where("o_orderkey % 2 = 0").select("o_orderkey", F.get(F.array(*map(F.lit, ["hit", "soft_miss", "hard_miss", "retryable"])), (k % 4).cast("int")).alias("kind"), F.year("o_orderdate").cast("string").alias("year"))
    return K.admitted_writes(r, NOW, 2001, k % 10 != 0).select("o_orderkey", "status", "expires")


@query("q_cache_merge", f"select o_orderkey, case when o_orderkey % 2 = 0 then 'hit' when o_orderkey % 3 = 0 then 'hit' when o_orderkey % 3 = 1 then 'soft_miss' else 'hard_miss' end as status, case when o_orderkey % 2 = 0 then 5 when o_orderkey % 5 = 0 then {NOW} + 90 * 86400 else {NOW} + 1 end::bigint as expires from orders where o_orderkey % 2 = 0 or o_orderkey % 4 <> 3")
def cache_merge(spark, d):
    """New entries replace old ones; expired ones whose renewal failed stay a while longer."""
    o = table(spark, d, "orders")
    new = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("hit").alias("status"), F.lit(5).alias("expires"), F.lit(7).alias("ts"))
    kept = K.keep_stale(_cache(spark, d), o.where("o_orderkey % 2 = 1").select("o_orderkey"), "o_orderkey", NOW)
    return K.merged_cache(kept, new, "o_orderkey").select("o_orderkey", "status", F.col("expires").cast("long").alias("expires"))


@query("q_guard_reason", """with e as (select event_id, user_id, epoch(ts)::bigint as t, event_type in ('error', 'click') as bad, event_type = 'click' as limited from events),
 w as (select *, count(*) over r as n, count(*) filter (where bad) over r as b from e window r as (partition by user_id order by t range between 432000 preceding and current row)),
 x as (select *, bool_or(n >= 5 and b > 0.4 * n) over p as tripped, max(case when limited then t end) over p as last from w window p as (partition by user_id order by t range unbounded preceding))
 select event_id, case when coalesce(t < last + 86400, false) then '429_pause' when tripped then 'error_rate_exceeded' else '' end as reason from x""")
def guard_reason(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", T.epoch_seconds(F.col("ts")).alias("t"))
    out = K.guard_states(e, "t", ~F.col("event_type").isin("error", "click"), F.when(F.col("event_type") == "click", 429).otherwise(200), 432_000, 5, 0.4, 86_400, ("user_id",))
    return out.select("event_id", "reason")


@query("q_domain_registry", """with e as (select event_id, user_id, event_type not in ('error','click') as ok from events), l as (select user_id, max(event_id) filter (where ok) as last_ok, max(event_id) as last_check, min(event_id) as first_seen, count(*) filter (where ok) as ok_count from e group by 1),
 f as (select user_id, count(*) filter (where last_ok is null or event_id > last_ok) as fail_count from e join l using (user_id) group by 1)
 select user_id, case when fail_count = 0 then 'alive' when fail_count >= 4 then 'dead' else 'unknown' end as state, ok_count, fail_count::bigint as fail_count, first_seen, last_check, last_ok,
  case when fail_count = 0 then false when fail_count >= 4 then 20000 - last_check >= 900 else true end as probe from l join f using (user_id)""")
def domain_registry(spark, d):
    """Three batches of probes, each folded into the registry that the one before left."""
    e = table(spark, d, "events").select("user_id", "event_id", (~F.col("event_type").isin("error", "click")).alias("ok"))
    registry = spark.createDataFrame([], "user_id long, state string, ok_count long, fail_count long, first_seen long, last_check long, last_ok long")
    cut = [r[0] for r in e.agg(F.expr("percentile_approx(event_id, array(0.3, 0.6))").alias("q")).select(F.explode("q")).collect()]
    for where in (f"event_id <= {cut[0]}", f"event_id > {cut[0]} and event_id <= {cut[1]}", f"event_id > {cut[1]}"):
        registry = K.registry_after(registry, e.where(where), "user_id", "event_id", "ok")
    return registry.select("user_id", "state", "ok_count", F.col("fail_count").cast("long").alias("fail_count"), "first_seen", "last_check", "last_ok", K.should_probe(F.col("state"), F.col("last_check"), F.lit(20_000)).alias("probe"))


@query("q_retry_queue", """with q as (select user_id as qk, count(*) filter (where event_type = 'error')::int as attempts, max(event_id) filter (where event_type = 'error') as ts from events group by 1)
 select qk, attempts, ts from q where attempts > 0 and qk % 7 <> 0 and attempts <= 12 order by ts, qk limit 50""")
def retry_queue(spark, d):
    f = table(spark, d, "events").where("event_type = 'error'").select(F.col("user_id").alias("qk"), F.lit("{}").alias("item"), F.lit("e").alias("last_err"), F.col("event_id").alias("ts"), "event_id")
    queue = spark.createDataFrame([], "qk long, item string, attempts int, last_err string, ts long")
    done = f.where("qk % 7 = 0").select("qk").distinct()
    for part in (f.where("event_id <= 400"), f.where("event_id > 400")):
        queue = K.queue_after(queue, part, "qk", done)
    return K.due_retries(queue, 50, 12).select("qk", "attempts", "ts")


@query("q_change_detection", "select doc_id, case when doc_id % 5 = 0 then 'new' when doc_id % 3 = 0 then 'updated' else 'skipped' end as change from documents")
def change_detection(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text", "source")
    old = docs.where("doc_id % 5 <> 0").withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "xx").otherwise(F.col("lang")))
    seen = old.select("doc_id", K.content_hash("lang", "text").alias("content_hash"))
    return K.changes(docs, seen, ["doc_id"], ["text", "lang"]).select("doc_id", "change")


def _library(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").where("o_orderkey % 4 <> 0").select(
        "o_orderkey", F.lit("old").alias("payload"), k.alias("first_seen"), F.lit(1).cast("long").alias("last_updated"), (k % 3).cast("int").alias("scraped"), F.when(k % 3 > 0, "hit").alias("scrape_status"),
        F.when(k % 3 > 0, 80).alias("confidence"), F.when(k % 7 == 0, 3).otherwise(1).alias("attempts"), F.lit(2.0).alias("weight"), F.lit(0).alias("is_new"))


@query("q_library_upsert", f"""with j as (select o_orderkey as k, o_orderkey % 4 <> 0 as known, o_orderkey % 5 <> 0 as batch, o_orderkey % 3 > 0 as done, o_orderkey % 2 = 0 as hot from orders),
 b as (select *, case when not batch then 'keep' when not known then 'insert' when done and hot then 'requeue' when done then 'touch' else 'refresh' end as branch from j where known or batch)
 select k as o_orderkey, branch, case when branch in ('insert','requeue','refresh') then 'new' else 'old' end as payload, case when branch in ('insert','requeue') then 0 else k % 3 end::int as scraped,
  case when branch in ('insert','requeue') then 0 when k % 7 = 0 then 3 else 1 end::int as attempts, case when batch then hot::int else 0 end as is_new, case when known then k else {NOW} end::bigint as first_seen, case when known then 2.0 else 1.0 end::double as weight from b""")
def library_upsert(spark, d):
    k = F.col("o_orderkey")
    batch = table(spark, d, "orders").where("o_orderkey % 5 <> 0").select("o_orderkey", F.lit("new").alias("payload"), F.when(k % 2 == 0, NOW).otherwise(5).alias("last_updated"), F.lit(1.0).alias("weight"))
    return K.library_after(_library(spark, d), batch, "o_orderkey", NOW).select("o_orderkey", "branch", "payload", "scraped", "attempts", "is_new", "first_seen", "weight")


@query("q_library_advance", """with l as (select o_orderkey as k, (o_orderkey % 3)::int as scraped, case when o_orderkey % 7 = 0 then 3 else 1 end as attempts from orders where o_orderkey % 4 <> 0)
 select k as o_orderkey, case when k % 5 = 0 then scraped when k % 5 = 1 then scraped when k % 5 = 2 then 2 else 1 end::int as scraped, case when k % 5 = 0 then case when k % 3 > 0 then 'hit' end when k % 5 = 1 then 'retryable' else 'hit' end as scrape_status,
  (attempts + (k % 5 = 1)::int)::int as attempts, case when k % 5 = 3 then 'rich' else 'old' end as payload from l""")
def library_advance(spark, d):
    k = F.col("o_orderkey")
    out = table(spark, d, "orders").where("o_orderkey % 5 <> 0").select("o_orderkey", F.when(k % 5 == 1, "retryable").otherwise("hit").alias("status"), F.lit(90).alias("confidence"), F.when(k % 5 == 3, "rich").alias("payload"), (k % 5 == 2).alias("backfilled"))
    return K.advanced(_library(spark, d), out, "o_orderkey").select("o_orderkey", "scraped", "scrape_status", "attempts", "payload")


@query("q_library_batches", "select 'cold' as lane, o_orderkey from (select o_orderkey from orders where o_orderkey % 4 <> 0 and o_orderkey % 3 = 0 and o_orderkey % 7 <> 0 order by o_orderkey / 2.0 limit 200) union all select 'hot', o_orderkey from (select o_orderkey from orders where o_orderkey % 6 = 0 and o_orderkey % 7 <> 0 order by o_orderkey desc limit 100)")
def library_batches(spark, d):
    lib = _library(spark, d)
    hot = table(spark, d, "orders").select("o_orderkey", F.lit(0).alias("attempts0"), F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(1).alias("scraped"), (F.col("o_orderkey") % 2 == 0).cast("int").alias("is_new"), F.col("o_orderkey").alias("last_updated"), F.when(F.col("o_orderkey") % 7 == 0, 3).otherwise(0).alias("attempts"))
    return K.cold_batch(lib, 200).select(F.lit("cold").alias("lane"), "o_orderkey").unionByName(K.hot_batch(hot, 100).select(F.lit("hot").alias("lane"), "o_orderkey"))


@query("q_hit_items", "select o_orderkey, 80 as confidence, o_orderstatus as title, [o_orderkey, o_orderkey + 1][1:2][2] as second_line from orders where o_orderkey % 3 > 0")
def hit_items(spark, d):
    k = F.col("o_orderkey")
    lib = table(spark, d, "orders").select("o_orderkey", F.lit(80).alias("confidence"), F.when(k % 3 > 0, "hit").otherwise("hard_miss").alias("scrape_status"), F.to_json(F.struct(F.col("o_orderstatus").alias("title"), F.array(k, k + 1).alias("lines"))).alias("payload"))
    return K.hit_items(lib, "title string, lines array<bigint>", "o_orderkey").select("o_orderkey", "confidence", "title", F.col("lines")[1].alias("second_line"))


@query("q_outcome_counts", "select user_id, count(*) as total, count(*) filter (where event_type = 'purchase') as hit, count(*) filter (where event_type = 'error') as retryable, count(*) filter (where event_type = 'view') as soft_miss from events group by 1")
def outcome_counts(spark, d):
    kind = F.when(F.col("event_type") == "purchase", "hit").when(F.col("event_type") == "error", "retryable").when(F.col("event_type") == "view", "soft_miss").otherwise("skip")
    return K.outcome_counts(table(spark, d, "events").withColumn("status", kind), "user_id").select("user_id", "total", "hit", "retryable", "soft_miss")


def _sites(spark, d):
    folder = shared_folder(spark, "sites")
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("raw_id"), F.col("c_name").alias("raw_title"), F.lit(None).cast("timestamp").alias("update_time"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("raw_id"), F.col("s_name").alias("raw_title"), F.lit(None).cast("timestamp").alias("update_time"))
    c.union(c.where("raw_id < '2'")).write.parquet(f"{folder}/a")
    s.write.parquet(f"{folder}/b")
    return [{"name": "b", "type": "table", "api_url": f"{folder}/b", "priority": 1}, {"name": "a", "type": "table", "api_url": f"{folder}/a", "priority": 2}, {"name": "c", "type": "table", "api_url": "none", "enabled": False}, {"name": "d", "type": "table", "api_url": "none"}], c


@query("q_harvest", """select site, items, new, updated, skipped, total, added from (select 'a' as site, count(*) as items, count(*) filter (where c_custkey % 4 = 0) as new, count(*) filter (where c_custkey % 4 = 1) as updated, count(*) filter (where c_custkey % 4 > 1) as skipped, count(*) as total, count(*) filter (where c_custkey % 4 < 2) as added from customer)
 union all select 'b', count(*), count(*), 0, 0, count(*), count(*) from supplier""")
def harvest(spark, d):
    """Two sites by type, one switched off, one done before; unchanged rows are skipped, repeated ones come once."""
    sites, c = _sites(spark, d)
    old = c.where("raw_id % 4 <> 0").withColumn("raw_title", F.when(F.col("raw_id") % 4 == 1, "other").otherwise(F.col("raw_title"))).withColumn("site", F.lit("a"))
    seen = old.select("site", "raw_id", K.content_hash("raw_id", "raw_title", "site").alias("content_hash"))
    items, report = V.harvest(spark, sites, seen, V.advance({}, "d", 3, done=True))
    return report.join(V.legacy_report(report), "site")


@query("q_provider_search", """with i as (select distinct p_name as item_key from part), t as (select p_name as title, min(p_partkey) as pos from part group by 1), x as (select item_key, title, row_number() over (partition by item_key order by pos, title)::int as pos from i join t on left(item_key, 2) = left(title, 2))
 select provider, item_key, pos, title from x, (values ('omdb'), ('tmdb')) v(provider) where pos <= case provider when 'omdb' then 10 else 20 end""")
def provider_search(spark, d):
    """Candidates of two stored providers, in order; one that answers anime only gives none for films."""
    p = table(spark, d, "part")
    items = p.select(F.col("p_name").alias("item_key")).distinct().withColumns({"title": F.col("item_key"), "year": F.lit(None).cast("string"), "category": F.lit("movies")})
    found = p.groupBy(F.col("p_name").alias("title")).agg(F.min("p_partkey").cast("int").alias("pos")).withColumns({"original_title": F.lit(""), "year": F.lit("2000")})
    every = [V.StoredProvider(n, found) for n in ("bilibili", "omdb", "tmdb", "tvdb")]
    from functools import reduce

    return reduce(lambda a, b: a.unionByName(b), [x.search(items) for x in V.chain(every, {"tvdb": False})]).select("provider", "item_key", "pos", "title")


@query("q_details_ratings", "select c_custkey, case when c_custkey % 2 = 0 then 10 else 1 end as n_cast, case when c_custkey % 3 = 0 then 7.5 else 8.0 end::double as rating, case when c_custkey % 3 = 0 then 'imdb' else 'own' end as rating_source from customer")
def details_ratings(spark, d):
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("tt"), k.cast("string")).alias("imdb_id"), F.array(F.lit("x")).alias("cast"), F.when(k % 3 == 0, 0.0).otherwise(8.0).alias("rating"), F.lit("own").alias("rating_source"))
    details = c.where("c_custkey % 2 = 0").select("c_custkey", F.transform(F.sequence(F.lit(1), F.lit(15)), lambda i: i.cast("string")).alias("cast"))
    ratings = c.select("imdb_id", F.lit(7.5).alias("rating"), F.lit("imdb").alias("rating_source"))
    return V.with_ratings(V.with_details(c, details, "c_custkey"), ratings).select("c_custkey", F.size("cast").alias("n_cast"), "rating", "rating_source")


@query("q_transport", """select code::int as code, case when code between 200 and 399 then 'ok' when code in (403, 408, 429) or code >= 500 then 'retryable' else 'error' end as class, least(60.0, 0.5 * power(2, code % 10)) * 1.125 as delay,
 case when code % 3 = 0 then least(60.0, code::double) else least(60.0, 0.5 * power(2, code % 10)) * 1.125 end::double as asked from (select unnest(range(100, 600)) as code)""")
def transport(spark, d):
    c = F.col("id").cast("int")
    return spark.range(100, 600).select(c.alias("code"), V.transport_class(c).alias("class"), V.retry_delay(c % 10, F.lit(0.5)).alias("delay"), V.retry_delay(c % 10, F.lit(0.5), F.when(c % 3 == 0, c.cast("double"))).alias("asked"))


@query("q_text_parsers", "select 1 as id, 'A,B,C' as staff, 12 as episodes, '2003:剧情,犯罪' as abstract, '7:无间道:9.1' as hit, '5' as k, 'a é' as plain union all select 2, '', null, ':', '', null, '' union all select 3, 'D', 40, '2020:动画', '', null, 'x'")
def text_parsers(spark, d):
    page = '<div class="result"><h3><a href="/subject/7/">无间&#36947;</a></h3><span class="rating_nums">9.1</span><span class="subject-cast">2003 / 剧情</span></div>'.replace("&#36947;", "道")
    rows = [(1, "导演：A\n演员: B（甲）、C、A", "更新至12集", "2003 / 香港 / 剧情 犯罪 / 剧情", page, '﻿ cb({"k": 5});', "<p>a &lt; b&nbsp;&amp; c</p>​&eacute;"), (2, None, "x", None, None, "<html>", None), (3, "D", "全40集", "日本 / 2020 / 动画", "", "", " x ")]
    raw = spark.createDataFrame(rows, "id int, staff string, title string, abstract string, page string, body string, html string")
    a, h = V.abstract_parts(F.col("abstract")), F.get(V.search_hits(F.col("page")), F.lit(0))
    return raw.select(
        "id", F.array_join(V.staff(F.col("staff")), ",").alias("staff"), V.episode_count(F.col("title")).alias("episodes"), F.concat_ws(":", F.coalesce(a["year"], F.lit("")), F.array_join(a["genres"], ",")).alias("abstract"),
        F.coalesce(F.concat_ws(":", h["id"], h["title"], h["rating"].cast("string")), F.lit("")).alias("hit"), V.tolerant_json(F.col("body"), "k string")["k"].alias("k"), U.html_text("html").alias("plain"))


@query("q_epoch_variants", "select o_orderkey, case o_orderkey % 6 when 0 then epoch(date_trunc('second', o_orderdate)) when 1 then epoch(date_trunc('minute', o_orderdate)) when 2 then epoch(date_trunc('day', o_orderdate)) when 3 then 20000000 else 0 end::bigint as epoch from orders")
def epoch_variants(spark, d):
    k = F.col("o_orderkey") % 6
    text = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")).when(k == 2, F.date_format("o_orderdate", "yyyy/MM/dd")).when(k == 3, "20000000.7").when(k == 4, "9999999").otherwise("x")
    return table(spark, d, "orders").select("o_orderkey", T.epoch_of(text).alias("epoch"))


def _items(spark, d):
    # Episodes are made after their keys have met: a shuffled line is its three numbers.
    episode = lambda x: C.new_episode(x["l_linenumber"], F.concat(F.lit("https://x/"), x["l_partkey"].cast("string")))
    s = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("l"))
    seasons = F.array(C.new_season(F.lit(1), episodes=F.transform("l", episode)), C.new_season(F.lit(2)))
    return s.select(F.concat(F.lit("tm_"), F.col("l_orderkey").cast("string")).alias("bangou"), F.lit("t").alias("title"), F.lit("p").alias("poster"), F.lit("a, b/c").alias("tags"), F.when(F.col("l_orderkey") % 10 != 0, seasons).otherwise(F.array(C.new_season(F.lit(1)))).alias("seasons"), F.when(F.col("l_orderkey") % 2 == 0, "tv").otherwise("movies").alias("category"))


@query("q_product", "select part, rows, files > 0 as written, 64 as digest from (select 'items' as part, count(distinct l_orderkey) as rows, 1 as files from lineitem union all select 'episodes', count(distinct case when l_orderkey % 10 <> 0 then l_orderkey end), 1 from lineitem union all select 'unmatched', count(*), 1 from supplier)")
def product(spark, d):
    """A product of items, episode shards and unmatched rows is written; its manifest is read back."""
    m = sinks.write_product(_items(spark, d), table(spark, d, "supplier"), shared_folder(spark, "product"), "2.1", "2026-01-01 00:00:00")
    return m.select("part", "rows", (F.col("files") > 0).alias("written"), F.length("sha256").alias("digest"))


@query("q_playlist_files", "select case when l_orderkey % 2 = 0 then 'tv' else 'movies' end as category, count(distinct l_orderkey) as files, count(*) as entries from lineitem where l_orderkey % 10 <> 0 and l_orderkey <= 400 group by 1")
def playlist_files(spark, d):
    """A file for each item that has episodes, by category; all of them, as the sample shows that time allows."""
    one = sinks.eligible(_items(spark, d)).where("cast(substring(bangou, 4) as long) <= 400")
    entries = F.flatten(F.transform("seasons", lambda s: F.transform(s["episodes"], lambda e: F.struct(s["season_number"].alias("season"), e["ep_number"].alias("episode"), e["ep_title"].alias("title"), e["url"].alias("url")))))
    folder = shared_folder(spark, "m3u8")
    sinks.write_playlists_within(one.select("category", "bangou", sinks.playlist(F.col("bangou"), entries).alias("text")), folder, "category", "bangou", "text", 1e9, 20)
    lines = spark.read.option("basePath", folder).text(f"{folder}/*/*")
    return lines.where("value like '#EXTINF%'").groupBy("category").agg(F.countDistinct("bangou").alias("files"), F.count("*").alias("entries"))


@query("q_export_clean", "select l_orderkey, 'a+b+c' as tags, false as has_poster, count(*)::int as episodes from lineitem where l_orderkey % 10 <> 0 group by 1")
def export_clean(spark, d):
    clean = sinks.cleaned(_items(spark, d))
    rows = sinks.episode_rows(clean).join(clean.select("bangou", F.array_join("tags", "+").alias("tags")), "bangou")
    return rows.select(F.substring("bangou", 4, 20).cast("long").alias("l_orderkey"), "tags", F.lit("poster" in clean.columns).alias("has_poster"), F.size("episodes").alias("episodes"))


@query("q_progress", "select event_type, count(*) as done, count(*) filter (where value < 50) as ok, count(*) filter (where value >= 80) as failed, round(100.0 * count(*) / 5000, 2) as percent, least(20, count(distinct case when value >= 80 then event_id end))::int as n_errors, round(count(*) / 100.0, 4) as rate, round((5000 - count(*)) / (count(*) / 100.0), 2) as eta from events group by 1")
def progress(spark, d):
    status = F.when(F.col("value") < 50, "ok").when(F.col("value") >= 80, "failed").otherwise("skipped")
    e = table(spark, d, "events").withColumns({"status": status, "message": F.concat(F.lit("e"), F.col("event_id").cast("string"))})
    return R.progress(e, "status", F.lit(100.0), F.lit(5000.0), "event_type").select("event_type", "done", "ok", "failed", "percent", F.size("errors").alias("n_errors"), "rate", "eta")


@query("q_phase_budget", "select event_type as phase, round(sum(value), 4) as spent, round(greatest(0, 60000 - sum(value)), 4) as remaining from events group by 1")
def phase_budget(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("phase"), "value", F.lit(60_000.0).alias("quota"))
    return R.budget_totals(e, "phase", "value", "quota").select("phase", F.round("spent", 4).alias("spent"), F.round("left", 4).alias("remaining"))


@query("q_event_lines", "select event_id, event_type || ' level=' || case when event_id % 2 = 0 then 'INFO' else 'WARNING' end || ' user_id=' || user_id as line from events")
def event_lines(spark, d):
    e = table(spark, d, "events").withColumns({"level": F.when(F.col("event_id") % 2 == 0, "INFO").otherwise("WARNING"), "nothing": F.lit(None).cast("string")})
    lines = R.events(e, "event_type", "level", ["user_id", "nothing", "event_id"])
    return lines.select(F.get_json_object("json", "$.event_id").cast("long").alias("event_id"), F.regexp_replace("line", " event_id=[0-9]+$", "").alias("line"))


@query("q_stage_times", "select event_type as stage, (max(case when event_id % 2 = 1 then event_id end) - min(case when event_id % 2 = 0 then event_id end))::bigint as seconds from events group by 1")
def stage_times(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("stage"), "event_id", F.when(F.col("event_id") % 2 == 0, "start").otherwise("end").alias("mark"))
    return R.stage_times(e, "stage", "event_id", "mark").select("stage", "seconds")


@query("q_rule_counts", "select 'l3' as kind, 3 as rules, 2 as distinct_rules union all select 'l4', 1, 1")
def rule_counts(spark, d):
    rules = spark.createDataFrame([("l3", "a"), ("l3", "b"), ("l3", "a"), ("l4", "c")], "kind string, word string")
    out = R.rule_counts(rules, "kind")
    return out.select("kind", F.col("rules").cast("int").alias("rules"), F.col("distinct").cast("int").alias("distinct_rules"))


@query("q_scan_abort", """with a as (select event_id, user_id, (event_type not in ('error','click'))::int as ok, sum((event_type not in ('error','click'))::int) over (partition by user_id order by event_id) as island from events),
 b as (select event_id, user_id, sum(1 - ok) over (partition by user_id, island order by event_id) as run from a)
 select event_id, coalesce(max(run) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) >= 5, false) as aborted from b""")
def scan_abort(spark, d):
    return A.aborted(table(spark, d, "events"), ~F.col("event_type").isin("error", "click"), "event_id", ["user_id"]).select("event_id", "aborted")


@query("q_breaker_cooldown", """with b as (select event_id, user_id, epoch(ts)::bigint as t, count(*) over w >= 5 and count(*) filter (where event_type = 'error') over w > 0.3 * count(*) over w as open from events window w as (partition by user_id order by event_id rows between 199 preceding and current row))
 select event_id, coalesce(t < max(case when open then t end) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) + 90000, false) as refused from b""")
def breaker_cooldown(spark, d):
    e = table(spark, d, "events").withColumn("t", T.epoch_seconds(F.col("ts")))
    return A.cooled_down(A.breaker(e, F.expr("event_type = 'error'"), "event_id", 200, 5, 0.3, ["user_id"]), "t", "event_id", ["user_id"], 90_000).select("event_id", "refused")


@query("q_penalised_rate", "select event_id, greatest(0.25, 4 * power(0.5, coalesce(sum((event_type = 'error')::int) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 0)))::double as rate from events")
def penalised_rate(spark, d):
    return A.penalised_rate(table(spark, d, "events"), F.col("event_type") == "error", "event_id", 4.0, ["user_id"]).select("event_id", "rate")


_RUN = """with p as (select p_partkey, p_name, p_type, p_size, p_size % 7 = 0 as skipped, p_size % 5 = 0 as dead from part), kept as (select * from p where not skipped and not dead),
 n as (select distinct p_name, p_type <> 'ECONOMY' as film from kept), c as (select *, length(p_name) % 3 = 0 as bare, length(p_name) % 4 = 0 as unknown from n),
 f as (select case when unknown and not bare then 'no_cover' when unknown then 'no_cover' when bare then 'no_cover' else case when film then 'video' else 'series' end end as part from c)
 select part, count(*) as n from f group by 1 union all select 'L3|子分类黑词:skip', count(*) from p where skipped union all select 'library', count(*) from c union all select 'cache ' || case when unknown then 'hard_miss' else 'hit' end, count(*) from c group by 1"""


@query("q_catalogue_run", _RUN)
def catalogue_run(spark, d):
    """A whole run: parts are raw items, each a line on one of two domains, one of them dead; a stored provider knows most of
    their names, some without a cover."""
    from ..operators import composed

    p = table(spark, d, "part").withColumn("name", F.regexp_replace("p_name", "[^a-z ]", " "))
    url = F.concat(F.when(F.col("p_size") % 5 == 0, "https://dead.x/").otherwise("https://live.x/"), F.col("p_partkey").cast("string"), F.lit(".m3u8"))
    raw = p.select(
        F.col("p_partkey").cast("string").alias("raw_id"), F.lit("s").alias("site"), F.col("p_name").alias("raw_title"), F.when(F.col("p_type") == "ECONOMY", "tv").otherwise("movies").alias("category"), F.when(F.col("p_size") % 7 == 0, "skip it").otherwise("").alias("sub_category"),
        F.lit("").alias("year"), F.lit("").alias("poster"), F.lit("").alias("overview"), F.lit("").alias("douban_id"), F.lit("2026-01-01 00:00:00").alias("update_time"), F.array(F.struct(F.lit("l").alias("line_name"), F.array(F.struct(F.lit("第01集").alias("name"), url.alias("url"))).alias("episodes"))).alias("lines"), F.lit(1).alias("priority"))
    known = p.where("length(p_name) % 4 <> 0").groupBy(F.col("p_name").alias("title"), F.when(F.col("p_type") == "ECONOMY", "tv").otherwise("movie").alias("media_type")).agg(F.min("p_partkey").cast("int").alias("pos"))
    cand = known.select("title", "media_type", "pos", F.lit("").alias("original_title"), F.lit("o").alias("overview"), F.when(F.length("title") % 3 != 0, "c").otherwise("").alias("poster"), F.lit(None).cast("string").alias("year"), F.col("pos").cast("string").alias("tmdb_id"), F.lit(5.0).alias("popularity"))
    registry = spark.createDataFrame([("dead.x", "dead"), ("live.x", "alive")], "domain string, state string")
    library = spark.createDataFrame([], "merge_key string, payload string, first_seen long, last_updated long, scraped int, scrape_status string, confidence int, attempts int, weight double, is_new int")
    cache = spark.createDataFrame([], "merge_key string, status string, expires long, ts long")
    out = composed.run(raw, P.Filters.of({"prefilter": {"sub_category_blacklist": ["skip"]}}), registry, library, cache, [V.StoredProvider("tmdb", cand, block=64)], NOW, 2026)
    count = lambda df, name: df.groupBy(name.alias("part")).agg(F.count("*").alias("n"))
    parts = [count(out.items, F.col("type")), count(out.unmatched, F.col("reason")), out.reasons.select(F.col("reason").alias("part"), "n"), count(out.library, F.lit("library")), count(out.cache, F.concat(F.lit("cache "), "status"))]
    from functools import reduce

    return reduce(lambda a, b: a.unionByName(b), parts)


@query("q_listed_category", "select p_partkey, case when contains(p_type, 'PROMO') then null when contains(p_name, 'green') then 'anime' when contains(p_name, 're') then 'tv' end as category from part")
def listed_category(spark, d):
    """The longest listed word decides; words to discard come first."""
    text = F.concat_ws(" ", "p_name", "p_type")
    return table(spark, d, "part").select("p_partkey", X.listed_category(text, {"re": "tv", "green": "anime"}, ("PROMO",)).alias("category"))


@query("q_category_conflicts", "select p_name || p_partkey as title, 'movies' as entry_category, 'anime' as corrected_category, 'genres' as reason from part where p_size % 4 = 0 order by 1 limit 50")
def category_conflicts(spark, d):
    """A report of some rows whose category an authority corrected."""
    p = table(spark, d, "part").select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("title"), F.lit("movies").alias("entry"), F.when(F.col("p_size") % 4 == 0, "anime").when(F.col("p_size") % 4 == 1, "").otherwise("movies").alias("corrected"), F.lit("genres").alias("why"))
    return X.conflicts(p, "title", "entry", "corrected", "why", 50)


@query("q_lines_alive", """with h as (select l_orderkey, l_linenumber, l_suppkey, l_partkey, l_suppkey % 3 <> 0 as up from lineitem) select l_orderkey, count(*)::int as lines, count(*) filter (where up)::int as alive from h group by 1""")
def lines_alive(spark, d):
    """Of an order's lines those whose first episode lies on a live domain; one URL stands for its line."""
    url = F.concat(F.lit("https://h"), (F.col("l_suppkey") % 3).cast("string"), F.lit(".x:8080/"), F.col("l_partkey").cast("string"))
    dead = F.lit("https://h0.x:8080/other")
    line = F.struct(F.array(F.struct(url.alias("url")), F.struct(dead.alias("url"))).alias("episodes"))
    x = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    alive = F.array(F.lit("h1.x:8080"), F.lit("h2.x:8080"))
    return x.select("l_orderkey", F.size("lines").alias("lines"), F.size(P.kept_lines(F.col("lines"), alive)).alias("alive"))


@query("q_safe_casts", "select o_orderkey, case o_orderkey % 4 when 0 then o_orderkey when 1 then 12 else 0 end::bigint as number, case o_orderkey % 4 when 0 then o_orderkey::double when 1 then 12.7 else null end::double as rating from orders")
def safe_casts(spark, d):
    """Numbers out of texts: fractions are cut, what is none is 0, or null where a rating is asked for."""
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.col("o_orderkey").cast("string")).when(k == 1, " 12.7 ").when(k == 2, "x")
    number = F.coalesce(F.trim(text).try_cast("double").try_cast("bigint"), F.lit(0))
    return table(spark, d, "orders").select("o_orderkey", number.alias("number"), F.trim(text).try_cast("double").alias("rating"))
