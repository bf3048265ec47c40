"""Queries on filters, projections, validation and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import merge as M
from ..operators import rules as R
from .catalog import query, table

WORDS = ["worthless", "disgusting", "idiot", "%%%", "!!"]


def _chain():
    return R.reason_chain(
        (~F.col("lang").isin("en", "fr", "de"), F.concat(F.lit("L1|lang:"), F.col("lang"))), (F.col("source").isin("src3", "src7"), "L2|source"),
        *[(F.contains("text", F.lit(w)), f"L3|{w}") for w in sorted(WORDS, key=lambda w: (-len(w), w))],
        (F.col("text").rlike("[0-9]{3}-[0-9]{4}"), "L4|number"), (F.col("n_chars") < 50, "L5|short"),
    )


_CHAIN_SQL = """case when lang not in ('en','fr','de') then 'L1|lang:' || lang when source in ('src3','src7') then 'L2|source'
 when contains(text,'disgusting') then 'L3|disgusting' when contains(text,'worthless') then 'L3|worthless' when contains(text,'idiot') then 'L3|idiot'
 when contains(text,'%%%') then 'L3|%%%' when contains(text,'!!') then 'L3|!!'
 when regexp_matches(text,'[0-9]{3}-[0-9]{4}') then 'L4|number' when n_chars < 50 then 'L5|short' end"""


@query("q_prefilter_reason_chain", f"select doc_id, {_CHAIN_SQL} as reason from documents")
def prefilter(spark, d):
    return table(spark, d, "documents").select("doc_id", _chain().alias("reason"))


@query("q_prefilter_reason_counts", f"select coalesce({_CHAIN_SQL}, 'kept') as reason, count(*) as n from documents group by 1")
def prefilter_counts(spark, d):
    return R.reason_counts(table(spark, d, "documents"), _chain())


_RULES = [["预告", "解说", "短剧"], ["短剧", "体育赛事", ""], ["解说", "伦理片"]]


@query("q_rule_table_merge", """select word, row_number() over (order by length(word) desc, word) as rank from
 (select distinct word from (values ('预告'),('解说'),('短剧'),('短剧'),('体育赛事'),(''),('解说'),('伦理片')) t(word) where trim(word) <> '')""")
def rule_table(spark, d):
    return R.rule_table(*[spark.createDataFrame([(w,) for w in x], "word string") for x in _RULES])


@query("q_time_window_keep", """with e as (select event_id, case when event_id % 97 = 0 then null else ts end as t from events)
 select event_id, t is null as lenient from e where t is null or t >= (select max(t) from e) - interval 24 hour""")
def time_window(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 97 != 0, F.col("ts")).alias("t"))
    latest = F.lit(e.agg(F.max("t")).first()[0]).cast("timestamp_ntz")
    return e.where(F.col("t").isNull() | (F.col("t") >= latest - F.expr("interval 24 hours"))).select("event_id", F.col("t").isNull().alias("lenient"))


_DOMAIN = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1))"


@query("q_url_probeable", f"""select page_id, {_DOMAIN} as domain,
 lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) as host,
 regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '/+$', '') as dedupe_key,
 regexp_matches(url, '^(http|https)://') and regexp_matches({_DOMAIN}, '^[^:]+(:0*[1-9][0-9]{{0,4}})?$') as probeable,
 case when contains(lower(url), '.m3u8') then 'm3u8' when contains(lower(url), '.mp4') then 'mp4' else 'm3u8' end as url_type from pages""")
def url_probeable(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select(
        "page_id", T.domain(u).alias("domain"), T.domain(u, False).alias("host"), T.url_key(u).alias("dedupe_key"), T.probeable(u).alias("probeable"), T.url_type(u).alias("url_type"))


@query("q_line_liveness_semi", f"""with p as (select page_id, {_DOMAIN} as domain from pages),
 alive as (select distinct domain from p where domain not like '%.net')
 select page_id, domain, (select count(distinct domain) from p) as n_domains from p where domain in (select domain from alive)""")
def liveness(spark, d):
    p = table(spark, d, "pages").select("page_id", T.domain(F.col("url")).alias("domain"))
    registry = p.select("domain").distinct().withColumn("alive", ~F.col("domain").endswith(".net"))
    n = registry.count()
    return p.join(registry.where("alive"), "domain", "left_semi").select("page_id", "domain", F.lit(n).alias("n_domains"))


@query("q_gate_reason", """select d.doc_id, case when source in ('src1','src2') then 'no_cover' when n_chars < 30 then 'no_overview'
 when l.quality is null then 'all_sources_miss' when case when l.quality=1 then 80 else 45 end < 55 then 'low_confidence' else '' end as reason,
 case when l.quality = 1 then 'high' when l.quality = 0 then 'low' else 'miss' end as band from documents d left join labels l using (doc_id)""")
def gate_reason(spark, d):
    x = table(spark, d, "documents").select("doc_id", "source", "n_chars").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    conf = F.when(F.col("quality") == 1, 80).when(F.col("quality") == 0, 45)
    cover = F.when(~F.col("source").isin("src1", "src2"), "c")
    return x.select("doc_id", R.gate(cover, F.when(F.col("n_chars") >= 30, "o"), F.col("quality").isNotNull(), conf).alias("reason"), R.band(conf).alias("band"))


@query("q_quarantine_split", """select d.doc_id, case when l.quality is null then 'all_sources_miss' when l.quality = 0 then 'low_confidence' else 'kept' end as outcome
 from documents d left join labels l using (doc_id)""")
def quarantine(spark, d):
    x = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    kept, out = R.split_by_reason(x, R.reason_chain((F.col("quality").isNull(), "all_sources_miss"), (F.col("quality") == 0, "low_confidence")))
    return kept.select("doc_id", F.lit("kept").alias("outcome")).unionByName(out.select("doc_id", F.col("reason").alias("outcome")))


@query("q_category_gate", """select p_partkey, case when p_type like '%BRASS%' then 'movies' when p_type like '%STEEL%' then 'tv' when p_size <= 10 then 'anime' when p_size > 45 then null else 'variety' end as category,
 case when p_type like '%BRASS%' then 'type' when p_type like '%STEEL%' then 'type' when p_size <= 10 then 'size' when p_size > 45 then 'dropped' else 'default' end as reason from part""")
def category_gate(spark, d):
    brass, steel, small, big = F.col("p_type").contains("BRASS"), F.col("p_type").contains("STEEL"), F.col("p_size") <= 10, F.col("p_size") > 45
    return table(spark, d, "part").select(
        "p_partkey", F.when(brass, "movies").when(steel, "tv").when(small, "anime").when(~big, "variety").alias("category"),
        R.reason_chain((brass | steel, "type"), (small, "size"), (big, "dropped"), (F.lit(True), "default")).alias("reason"))


@query("q_age_filter", "select o_orderdate < timestamp '1997-06-01' as old, count(*) as n from orders group by 1")
def age_filter(spark, d):
    o = table(spark, d, "orders").select((F.col("o_orderdate") < F.lit("1997-06-01").cast("timestamp_ntz")).alias("old"))
    recent, old = o.where("not old"), o.where("old")
    return recent.unionByName(old).groupBy("old").agg(F.count("*").alias("n"))


@query("q_item_liveness", """select l_orderkey, bool_or(l_returnflag <> 'R') as alive,
 min(case when l_returnflag <> 'R' then l_linenumber end) as promoted from lineitem group by 1""")
def item_liveness(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("lines"))
    up = F.filter("lines", lambda x: x["l_returnflag"] != "R")
    return lines.select("l_orderkey", F.exists("lines", lambda x: x["l_returnflag"] != "R").alias("alive"), F.get(up, 0)["l_linenumber"].alias("promoted"))


@query("q_coalesce_projection", """select c_custkey, coalesce(nullif(trim(case when c_custkey % 3 = 0 then '' else c_name end), ''), c_mktsegment, 'none') as title,
 coalesce(n, 0) as n_orders, coalesce(n, 0) > 0 as eligible from customer left join (select o_custkey, count(*) n from orders group by 1) on o_custkey = c_custkey""")
def coalesce_projection(spark, d):
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    c = table(spark, d, "customer").join(n, "c_custkey", "left")
    name = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name"))
    k = F.coalesce("n", F.lit(0))
    return c.select("c_custkey", T.first_present(name, "c_mktsegment", F.lit("none")).alias("title"), k.alias("n_orders"), (k > 0).alias("eligible"))


@query("q_surrogate_keys", """select p_partkey, case when p_size % 5 <> 0 then 'tm_' || p_partkey || case when p_size % 3 + 1 > 1 then '_s' || (p_size % 3 + 1) else '' end
   else 'v_' || md5(p_name || '|' || p_brand) end as bangou,
 p_type || '|' || p_name || '|' || case when p_size % 4 = 0 then '1' else (p_size % 4)::varchar end as merge_key,
 'v6|' || p_type || '|' || p_name as cache_key from part""")
def surrogate_keys(spark, d):
    ext = F.when(F.col("p_size") % 5 != 0, F.col("p_partkey").cast("string"))
    return table(spark, d, "part").select(
        "p_partkey", R.surrogate_id(F.lit("tm"), ext, F.col("p_size") % 3 + 1, F.col("p_name"), F.col("p_brand")).alias("bangou"),
        R.merge_key(F.col("p_type"), F.col("p_name"), F.col("p_size") % 4).alias("merge_key"), F.concat_ws("|", F.lit("v6"), "p_type", "p_name").alias("cache_key"))


@query("q_tags_split", "select p_partkey, array_to_string(list_filter(string_split_regex(p_name || ', ' || p_brand || '/;x', '[,/|; ]+'), lambda t: t <> ''), '+') as tags from part")
def tags_split(spark, d):
    raw = F.concat("p_name", F.lit(", "), "p_brand", F.lit("/;x"))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.filter(F.split(raw, "[,/|; ]+"), lambda t: t != ""), "+").alias("tags"))


@query("q_coerce_types", """select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k, try_cast(value as bigint) is null as changed,
 case when json_extract_string(props, '$.k') is null then 'k:null' else '' end as log from events""")
def coerce_types(spark, d):
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").select("event_id", k.try_cast("long").alias("k"), F.col("value").isNull().alias("changed"), F.array_join(R.messages((k.isNull(), "k:null")), ",").alias("log"))


@query("q_overlay_vs_fill", """select c_custkey, coalesce(nullif(s_name,''), c_name) as overlaid, coalesce(nullif(case when c_custkey % 2 = 0 then '' else c_name end,''), s_name) as filled
 from customer left join (select s_nationkey, min(s_name) as s_name from supplier group by 1) on s_nationkey = c_nationkey""")
def overlay(spark, d):
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.min("s_name").alias("s_name"))
    own = F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_name"))
    return table(spark, d, "customer").join(s, "c_nationkey", "left").select("c_custkey", T.first_present("s_name", "c_name").alias("overlaid"), T.first_present(own, "s_name").alias("filled"))


_CHECKS = [("o_totalprice < 1000", "price_low"), ("o_orderstatus not in ('O','F')", "status"), ("n_lines = 0", "no_lines"), ("n_lines <> n_numbers", "duplicate_number")]


@query("q_validate_contract", """with l as (select l_orderkey, count(*) n, count(distinct l_linenumber) u from lineitem group by 1),
 x as (select o_orderkey, o_totalprice, o_orderstatus, coalesce(n,0) n_lines, coalesce(u,0) n_numbers from orders left join l on l_orderkey = o_orderkey)
 select o_orderkey, concat_ws(',', case when o_totalprice < 1000 then 'price_low' end, case when o_orderstatus not in ('O','F') then 'status' end,
 case when n_lines = 0 then 'no_lines' end, case when n_lines <> n_numbers then 'duplicate_number' end) as errors,
 case when o_totalprice > 300000 then 'price_high' else '' end as warnings from x""")
def validate(spark, d):
    l = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"), F.countDistinct("l_linenumber").alias("n_numbers"))
    x = table(spark, d, "orders").join(l, "o_orderkey", "left").fillna(0, ["n_lines", "n_numbers"])
    return x.select("o_orderkey", F.array_join(R.messages(*[(F.expr(c), m) for c, m in _CHECKS]), ",").alias("errors"), F.array_join(R.messages((F.col("o_totalprice") > 300000, "price_high")), ",").alias("warnings"))


@query("q_validate_summary", "select count(*) as total, count(*) filter (where o_orderstatus in ('O','F') and o_totalprice >= 1000) as ok, count(*) filter (where not (o_orderstatus in ('O','F') and o_totalprice >= 1000)) as failed from orders")
def validate_summary(spark, d):
    bad = F.size(R.messages((F.expr("o_totalprice < 1000"), "price"), (F.expr("o_orderstatus not in ('O','F')"), "status"))) > 0
    return table(spark, d, "orders").agg(F.count("*").alias("total"), F.count_if(~bad).alias("ok"), F.count_if(bad).alias("failed"))


_MAP = {"blue": "cold", "green": "cold", "red": "warm", "metallic": "shiny", "small": "size", "large": "size"}


@query("q_map_lookup_first_token", """with t as (select p_partkey, unnest(string_split(lower(p_name), ' ')) as tok, generate_subscripts(string_split(p_name, ' '), 1) as pos from part),
 m as (select * from (values ('blue','cold'),('green','cold'),('red','warm'),('metallic','shiny'),('small','size'),('large','size')) v(key, value))
 select p_partkey, coalesce(b, 'other') as bucket from part left join (select p_partkey, arg_min(value, pos) as b from t join m on key = tok group by 1) using (p_partkey)""")
def map_lookup(spark, d):
    return table(spark, d, "part").select("p_partkey", F.coalesce(R.map_lookup(F.split(F.lower("p_name"), " "), _MAP), F.lit("other")).alias("bucket"))


@query("q_cache_lookup", """with c as (select o_custkey, max(o_orderdate) as ts from orders group by 1)
 select c_custkey, case when ts is null then 'none' when ts + interval 90 day >= timestamp '2001-07-01' then 'hit' when ts + interval 365 day >= timestamp '2001-07-01' then 'stale' else 'expired' end as status
 from customer left join c on o_custkey = c_custkey""")
def cache_lookup(spark, d):
    c = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("ts"))
    left = lambda days: F.col("ts") + F.expr(f"interval {days} days") >= F.lit("2001-07-01").cast("timestamp_ntz")
    return table(spark, d, "customer").select("c_custkey").join(c, "c_custkey", "left").select(
        "c_custkey", F.when(F.col("ts").isNull(), "none").when(left(90), "hit").when(left(365), "stale").otherwise("expired").alias("status"))


@query("q_changed_rows", """with s as (select doc_id, md5(case when doc_id % 5 = 0 then text || 'x' else text end) as h from documents where doc_id % 7 <> 0)
 select case when h is null then 'new' when h <> md5(text) then 'changed' else 'unchanged' end as kind, count(*) as n from documents left join s using (doc_id) group by 1""")
def changed_rows(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("now"), F.md5(F.concat("text", F.lit("x"))).alias("other"))
    seen = docs.where("doc_id % 7 <> 0").select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.col("other")).otherwise(F.col("now")).alias("h"))
    kind = F.when(F.col("h").isNull(), "new").when(F.col("h") != F.col("now"), "changed").otherwise("unchanged")
    return docs.join(seen, "doc_id", "left").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("q_index_lookup", "select c_custkey, n_name, r_name from customer left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey")
def index_lookup(spark, d):
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    return c.join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(r, F.col("r_regionkey") == F.col("n_regionkey"), "left").select("c_custkey", "n_name", "r_name")


@query("q_nested_rebuild", """select o_orderkey, coalesce(s, '') as lines from orders left join
 (select l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' order by l_linenumber, l_partkey) as s from lineitem group by 1) on l_orderkey = o_orderkey""")
def nested_rebuild(spark, d):
    lines = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    l = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(lines.alias("x"))
    text = F.array_join(F.transform("x", lambda e: F.concat_ws(":", e["l_linenumber"].cast("string"), e["l_partkey"].cast("string"))), ",")
    return table(spark, d, "orders").select("o_orderkey").join(l, "o_orderkey", "left").select("o_orderkey", F.coalesce(text, F.lit("")).alias("lines"))


@query("q_merge_upsert", """with s as (select o_orderkey k, o_totalprice p, o_orderkey % 2 as scraped from orders where o_orderdate < timestamp '1999-01-01'),
 b as (select o_orderkey k, o_totalprice + 1 as p from orders where o_orderkey % 3 = 0),
 j as (select coalesce(s.k, b.k) as key, case when s.k is null then 'insert' when b.k is null then 'keep' when s.scraped = 0 then 'refresh' when coalesce(s.k, b.k) % 5 = 0 then 'requeue' else 'touch' end as branch, s.p sp, b.p bp, s.scraped from s full join b on s.k = b.k)
 select key, branch, case when branch in ('insert','refresh','requeue') then bp else sp end as price, case when branch in ('insert','requeue') then 0 else scraped end as scraped from j""")
def merge_upsert(spark, d):
    o = table(spark, d, "orders")
    state = o.where("o_orderdate < timestamp_ntz '1999-01-01'").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"), (F.col("o_orderkey") % 2).alias("scraped"))
    batch = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("key"), (F.col("o_totalprice") + 1).alias("price"), F.lit(True).alias("_in_batch"))
    return M.upsert(state, batch, "key", ["price"], hot=F.col("key") % 5 == 0)


@query("q_id_verify", "select p_partkey, count(l_partkey) as n from part left join lineitem on ltrim(lpad(p_partkey::varchar, 8, '0'), '0') = ltrim(l_partkey::varchar, '0') group by 1")
def id_verify(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.ltrim(F.lpad(F.col("p_partkey").cast("string"), 8, "0"), F.lit("0")).alias("k"))
    l = table(spark, d, "lineitem").select(F.ltrim(F.col("l_partkey").cast("string"), F.lit("0")).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    return p.join(l, "k", "left").select("p_partkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("q_source_chain", """select c_custkey, case when c_acctbal > 5000 then 'rich' when o.k is not null then o.s when c_nationkey < 5 then 'near' end as value,
 case when c_acctbal > 5000 then 'balance' when o.k is not null then 'orders' when c_nationkey < 5 then 'nation' else 'miss' end as source
 from customer left join (select o_custkey k, min(o_orderpriority) s from orders group by 1) o on k = c_custkey""")
def source_chain(spark, d):
    c = table(spark, d, "customer")
    a = c.where("c_acctbal > 5000").select("c_custkey", F.lit("rich").alias("v"))
    b = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias("v"))
    e = c.where("c_nationkey < 5").select("c_custkey", F.lit("near").alias("v"))
    return M.priority_chain([(a, "balance"), (b, "orders"), (e, "nation")], c.select("c_custkey"), "c_custkey", "v")


@query("q_positional_zip", """with u as (select conv_id, turn, row_number() over (partition by conv_id order by turn) i from conversations where role = 'user'),
 a as (select conv_id, turn, row_number() over (partition by conv_id order by turn) i from conversations where role = 'assistant')
 select conv_id, i, u.turn as asked, a.turn as answered from u join a using (conv_id, i)""")
def positional_zip(spark, d):
    c = table(spark, d, "conversations")
    u, a = c.where("role = 'user'").select("conv_id", F.col("turn").alias("asked")), c.where("role = 'assistant'").select("conv_id", F.col("turn").alias("answered"))
    from pyspark.sql import Window
    at = lambda o: F.row_number().over(Window.partitionBy("conv_id").orderBy(o))
    return u.withColumn("i", at("asked")).join(a.withColumn("i", at("answered")), ["conv_id", "i"]).withColumn("i", F.col("i").cast("long"))


@query("q_backfill_join", """select p_partkey, round(coalesce(case when p_size % 2 = 0 then p_retailprice end, q), 4) as rating
 from part left join (select l_partkey, max(l_quantity) q from lineitem group by 1) on l_partkey = p_partkey""")
def backfill(spark, d):
    q = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_quantity").alias("q"))
    return table(spark, d, "part").join(q, "p_partkey", "left").select("p_partkey", F.round(F.coalesce(F.when(F.col("p_size") % 2 == 0, F.col("p_retailprice")), "q"), 4).alias("rating"))


@query("q_union_sites", "select 'customer' as site, c_nationkey as nation, count(*) as n from customer group by 2 union all select 'supplier', s_nationkey, count(*) from supplier group by 2")
def union_sites(spark, d):
    c = table(spark, d, "customer").select(F.lit("customer").alias("site"), F.col("c_nationkey").alias("nation"))
    return c.unionByName(table(spark, d, "supplier").select(F.lit("supplier").alias("site"), F.col("s_nationkey").alias("nation"))).groupBy("site", "nation").agg(F.count("*").alias("n"))


@query("q_set_difference", "select c_custkey, c_custkey in (select o_custkey from orders) as ordered from customer")
def set_difference(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(o, "c_custkey", "left_semi").select("c_custkey", F.lit(True).alias("ordered")).unionByName(c.join(o, "c_custkey", "left_anti").select("c_custkey", F.lit(False).alias("ordered")))


@query("q_candidate_score", """with x as (select c_custkey, c_name, s_suppkey, s_name, row_number() over (partition by c_custkey order by s_suppkey) pos from customer join supplier on s_nationkey = c_nationkey),
 y as (select *, round(100 * (1 - levenshtein(lower(c_name), lower(s_name))::double / greatest(length(c_name), length(s_name)))) as score from x where pos <= 5)
 select c_custkey, arg_min(s_suppkey, (-score, pos)) as best, max(score)::bigint as score from y group by 1""")
def candidate_score(spark, d):
    c, s = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("c_nationkey"))
    # The first five suppliers don't depend on the customer: cut them per nation, then join.
    x = c.join(M.top_per_key(s, ["c_nationkey"], ["s_suppkey"], 5, "pos"), "c_nationkey")
    score = F.round(100 * (1 - F.levenshtein(F.lower("c_name"), F.lower("s_name")) / F.greatest(F.length("c_name"), F.length("s_name")))).cast("long")
    return x.withColumn("score", score).groupBy("c_custkey").agg(F.min_by("s_suppkey", F.struct(-F.col("score"), "pos")).alias("best"), F.max("score").alias("score"))
