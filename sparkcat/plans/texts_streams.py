"""Queries on scalar functions, goldens, streams and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import udf as U
from ..operators import merge as M
from ..session import shared_folder
from ..sources import sinks
from ..streaming import ops as S
from .catalog import query, table

TITLES = [
    ("无间道2", "无间道", 2, None), ("无间道Ⅱ", "无间道", 2, None), ("无间道第二部", "无间道", 2, None), ("无间道 2", "无间道", 2, None),
    ("无间道", "无间道", 1, None), ("无间道（2002）", "无间道", 1, "2002"), ("我和我的祖国", "我和我的祖国", 1, None), ("我和我的家乡", "我和我的家乡", 1, None),
    ("慶餘年", "庆余年", 1, None), ("死神 千年血战篇-祸进谭-", "死神千年血战篇祸进谭", 1, None), ("歌手2024 第3期", "歌手", 1, "2024"), ("乘风2024", "乘风", 1, "2024"),
]
EPISODES = [
    ("第01集", 1, "episode", 1, "第1集", None), ("第一集", 1, "episode", 1, "第1集", None), ("03", 1, "episode", 3, "第3集", None), ("121集", 1, "episode", 121, "第121集", None),
    ("EP12", 1, "episode", 12, "第12集", None), ("EP00", 1, "extra", 0, "EP00", None), ("第1-20集", 1, "episode", 1, "第1-20集", None), ("第20260822期", 1, "air_date", 20260822, "2026-08-22", "2026-08-22"),
    ("第20260905期纯享版", 1, "air_date_extra", 20260905, "2026-09-05 纯享版", "2026-09-05"), ("第3期", 1, "episode", 3, "第3期", None), ("预告", 1, "extra", 0, "预告", None),
    ("正片", 1, "episode", 1, "正片", None), ("HD中字", 1, "episode", 1, "正片", None), ("abc", 5, "unknown", 5, "abc", None),
]


def _values(rows: list[tuple]) -> str:
    lit = lambda x: "null" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)


@query("q_title_golden", f"select raw, norm_title, seq::int as seq, year::varchar as year from (values {_values(TITLES)}) t(raw, norm_title, seq, year)")
def title_golden(spark, d):
    raw = spark.createDataFrame([(t[0],) for t in TITLES], "raw string")
    return raw.select("raw", U.parse_title("raw").alias("p")).select("raw", "p.*")


@query("q_episode_golden", f"select name, kind, ep_number::int as ep_number, ep_title, air_date::varchar as air_date from (values {_values([(a, c, n, t, x) for a, _, c, n, t, x in EPISODES])}) t(name, kind, ep_number, ep_title, air_date)")
def episode_golden(spark, d):
    raw = spark.createDataFrame([(e[0], e[1]) for e in EPISODES], "name string, ord int")
    return raw.select("name", U.parse_episode("name", "ord").alias("p")).select("name", "p.kind", "p.ep_number", "p.ep_title", "p.air_date")


@query("q_candidate_score_ratio")
def candidate_ratio(spark, d):
    c, s = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("c_nationkey"))
    x = c.join(M.top_per_key(s, ["c_nationkey"], ["s_suppkey"], 5, "pos"), "c_nationkey")
    scored = x.withColumn("score", F.bround(100 * U.ratio(F.lower("c_name"), F.lower("s_name")), 0))
    return scored.groupBy("c_custkey").agg(F.min_by("s_suppkey", F.struct(-F.col("score"), "pos")).alias("best"), F.max("score").alias("score"))


@query("q_title_parts", "select p_partkey, nullif(regexp_extract(t, '(^|[^0-9])((19|20)[0-9]{2})([^0-9]|$)', 2), '') as year, regexp_replace(lower(t), '[^a-z0-9]+', '', 'g') as norm, p_type || '|' || regexp_replace(lower(t), '[^a-z0-9]+', '', 'g') as merge_group from (select *, p_name || ' (' || (1990 + p_size) || ')' as t from part)")
def title_parts(spark, d):
    t = F.concat("p_name", F.lit(" ("), (1990 + F.col("p_size")).cast("string"), F.lit(")"))
    norm = F.regexp_replace(F.lower(t), "[^a-z0-9]+", "")
    return table(spark, d, "part").select("p_partkey", T.year_of(t).alias("year"), norm.alias("norm"), F.concat_ws("|", "p_type", norm).alias("merge_group"))


_PLAIN = "regexp_replace(coalesce(html, ''), '<[^>]*>', ' ', 'g')"
for _a, _b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
    _PLAIN = f"replace({_PLAIN}, '{_a}', '{_b}')"


@query("q_html_clean", f"select page_id, md5(trim(regexp_replace({_PLAIN}, '[ \\t\\n\\r]+', ' ', 'g'))) as digest, length(trim(regexp_replace({_PLAIN}, '[ \\t\\n\\r]+', ' ', 'g')))::bigint as n, regexp_matches(html, '[一-鿿]') as has_cjk from pages")
def html_clean(spark, d):
    t = T.html_plain(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.md5(t).alias("digest"), F.char_length(t).cast("long").alias("n"), T.has_cjk(F.col("html")).alias("has_cjk"))


@query("q_play_urls", "select l_orderkey, l_returnflag as line_name, count(*) as n, min(l_partkey) as first from lineitem group by 1, 2")
def play_urls(spark, d):
    ep = F.concat(F.lit("第"), F.col("l_linenumber").cast("string"), F.lit("集$https://x.example/"), F.col("l_partkey").cast("string"), F.lit(".m3u8"))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.array_join(F.sort_array(F.collect_list(ep)), "#").alias("eps"))
    feed = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_returnflag", "eps"))).alias("x"))
    feed = feed.select("l_orderkey", F.array_join("x.l_returnflag", "$$$").alias("names"), F.array_join("x.eps", "$$$").alias("urls"))
    back = feed.select("l_orderkey", F.inline(T.play_lines(F.col("urls"), F.col("names"))))
    key = F.array_min(F.transform("episodes", lambda e: F.regexp_extract(e["url"], "/([0-9]+)[.]m3u8$", 1).cast("long")))
    return back.select("l_orderkey", "line_name", F.size("episodes").cast("long").alias("n"), key.alias("first"))


@query("q_category_normalize", "select p_partkey, case when p_type = 'STANDARD' then 'movies' when contains(lower(p_type), 'eco') then 'anime' when contains(lower(p_type), 'prom') then 'variety' else 'tv' end as category from part")
def category_normalize(spark, d):
    t = F.lower("p_type")
    return table(spark, d, "part").select("p_partkey", F.when(F.col("p_type") == "STANDARD", "movies").when(t.contains("eco"), "anime").when(t.contains("prom"), "variety").otherwise("tv").alias("category"))


@query("q_abstract_parse", "select 1::bigint as id, '2003' as year, '剧情,犯罪' as genres union all select 2, null, '' union all select 3, '2020', '动画'")
def abstract_parse(spark, d):
    rows = spark.createDataFrame([(1, "2003 / 香港 / 剧情 犯罪"), (2, ""), (3, "日本 / 2020 / 动画")], "id long, abstract string")
    tokens = F.split("abstract", "[ /]+")
    genres = F.slice(F.filter(tokens, lambda t: t.isin("剧情", "犯罪", "动画", "喜剧", "爱情")), 1, 6)
    return rows.select("id", T.year_of(F.col("abstract")).alias("year"), F.array_join(genres, ",").alias("genres"))


@query("q_multi_format_time", "select o_orderkey, case o_orderkey % 6 when 5 then null when 0 then date_trunc('second', o_orderdate) when 4 then date_trunc('second', o_orderdate) else date_trunc('day', o_orderdate) end::timestamp as parsed from orders")
def multi_format_time(spark, d):
    o = table(spark, d, "orders").withColumn("t", F.col("o_orderdate").cast("timestamp"))
    k = F.pmod("o_orderkey", F.lit(6))
    text = F.when(k == 0, F.date_format("t", "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format("t", "yyyy/MM/dd")).when(k == 2, F.date_format("t", "yyyy-MM-dd")).when(k == 3, F.date_format("t", "yyyyMMdd")).when(k == 4, F.unix_timestamp("t").cast("string")).otherwise("garbage")
    return o.select("o_orderkey", T.parse_time(text).cast("timestamp_ntz").alias("parsed"))


@query("q_item_document", "select o_orderkey, o_orderstatus as status, o_custkey as owner from orders")
def item_document(spark, d):
    docs = sinks.item_document(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"), "o_orderkey")
    return docs.select("o_orderkey", F.from_json("document", "o_orderstatus string, o_custkey long").alias("x")).select("o_orderkey", F.col("x.o_orderstatus").alias("status"), F.col("x.o_custkey").alias("owner"))


@query("q_playlist_text", """select l_orderkey, '#EXTM3U' || chr(10) || string_agg('#EXTINF:-1,o' || l_orderkey || ' S1E' || l_linenumber || ' p' || l_partkey || chr(10) || 'https://x.example/' || l_suppkey, chr(10) order by l_linenumber, l_partkey, l_suppkey) || chr(10) as text from lineitem group by 1""")
def playlist_text(spark, d):
    e = F.struct(F.lit(1).alias("season"), F.col("l_linenumber").alias("episode"), "l_partkey", "l_suppkey", F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("title"), F.concat(F.lit("https://x.example/"), F.col("l_suppkey").cast("string")).alias("url"))
    x = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(e)).alias("entries"))
    return x.select("l_orderkey", sinks.playlist(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")), F.col("entries")).alias("text"))


def _events(spark, d):
    return S.read_stream(spark, d, table(spark, d, "events"), "events.parquet")


def _staged(spark, events, parts) -> str:
    """Events in files of their own, one for each condition, in the order in which a stream reads them."""
    folder = shared_folder(spark, "stream-files")
    for where in parts:
        events.where(where).coalesce(1).write.mode("append").parquet(folder)
    return folder


@query("q_stream_window", "select date_trunc('day', ts)::timestamp as start, count(*) as n from events group by 1")
def stream_window(spark, d):
    base = shared_folder(spark, "stream")
    keep = S.versioned_upsert(spark, f"{base}/t", "start", "n")
    S.run_available(S.window_counts(_events(spark, d), "ts", "1 day", "2 days"), keep, f"{base}/c", "update")
    return _latest(spark, f"{base}/t").select(F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("q_stream_upsert", "select user_id, arg_max(event_type, event_id) as event_type, max(event_id) as event_id from events group by 1")
def stream_upsert(spark, d):
    """Files come newest first, so that later batches hold older rows."""
    base, e = shared_folder(spark, "stream"), table(spark, d, "events").select("user_id", "event_id", "event_type")
    folder = _staged(spark, e, [f"event_id % 4 = {i}" for i in (3, 1, 2, 0)])
    S.run_available(S.read_stream(spark, folder, e, files_per_trigger=1), S.versioned_upsert(spark, f"{base}/t", "user_id", "event_id"), f"{base}/c")
    return _latest(spark, f"{base}/t")


@query("q_stream_domain_state", "with a as (select event_id, user_id, (event_type not in ('error','click'))::int as ok from events), b as (select user_id, coalesce(max(event_id) filter (where ok = 1), -1) as last_ok from a group by 1), c as (select a.user_id, count(*) filter (where event_id > last_ok) as run from a join b using (user_id) group by 1) select user_id as key, run, case when run = 0 then 'alive' when run >= 4 then 'dead' else 'unknown' end as state from c")
def stream_state(spark, d):
    base = shared_folder(spark, "stream")
    e = table(spark, d, "events")
    cut = [r[0] for r in e.agg(F.expr("percentile_approx(event_id, array(0.3, 0.6))").alias("q")).select(F.explode("q")).collect()]
    folder = _staged(spark, e, [f"event_id <= {cut[0]}", f"event_id > {cut[0]} and event_id <= {cut[1]}", f"event_id > {cut[1]}"])
    states = S.liveness_states(S.read_stream(spark, folder, e, files_per_trigger=1), "user_id", "event_id", "event_type not in ('error','click')")
    S.run_available(states, S.versioned_upsert(spark, f"{base}/t", "key", "last"), f"{base}/c", "update")
    return _latest(spark, f"{base}/t").drop("last")


_DEDUPE_DAY = "date_diff('day', timestamp '2024-01-01', ts)"


@query("q_stream_dedupe", f"""with e as (select *, {_DEDUPE_DAY} as day from events where {_DEDUPE_DAY} in (0, 1, 2, 11, 12, 15, 16, 17))
 select distinct user_id, event_type, case when day in (11, 12) then 'between' when day < 11 then 'before' else 'after' end as part, case when day in (11, 12) then event_id else 0 end as id from e""")
def stream_dedupe(spark, d):
    """One row per user and type within three days of the first; a file a day, and two days of rows that repeat nothing, by
    whose end the first days' keys are forgotten."""
    base = shared_folder(spark, "stream")
    day = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) - 1_704_067_200) / 86_400).alias("day")
    e = table(spark, d, "events").select("ts", "user_id", "event_type", "event_id", day)
    between = F.col("day").isin(11, 12)
    e = e.select("ts", "user_id", "event_type", "day", F.when(between, "between").when(F.col("day") < 11, "before").otherwise("after").alias("part"), F.when(between, F.col("event_id")).otherwise(F.lit(0)).alias("id"))
    folder = _staged(spark, e, [f"day = {k}" for k in (0, 1, 2, 11, 12, 15, 16, 17)])
    unique = S.dedupe(S.read_stream(spark, folder, e, files_per_trigger=1), "ts", ["user_id", "event_type", "id"], "3 days")
    S.run_available(unique, lambda b, n: b.write.mode("overwrite").parquet(f"{base}/t/v{n}"), f"{base}/c")
    return spark.read.parquet(f"{base}/t/*").select("user_id", "event_type", "part", "id")


def _latest(spark, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return spark.read.parquet(f"{folder}/v{max(int(f.getPath().getName()[1:]) for f in found)}")
