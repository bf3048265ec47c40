"""Queries on aggregation, order-dependent algorithms, top-k and admission."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import admission as A
from ..operators import merge as M
from .catalog import query, table

BAD = "event_type = 'error'"


@query("q_coarse_group", """select p_type, p_name, arg_min(p_partkey, (p_size, -p_retailprice, p_partkey)) as representative, count(*) - 1 as n_siblings,
 arg_min(p_brand, p_partkey) as first_p_brand, arg_min(p_size, p_partkey) as first_p_size from part group by 1, 2""")
def coarse_group(spark, d):
    return M.coarse_merge(table(spark, d, "part"), ["p_type", "p_name"], "p_partkey", [F.col("p_size"), -F.col("p_retailprice")], "p_partkey", ["p_brand", "p_size"])


@query("q_line_union", """select l_orderkey, string_agg(l_partkey, ',' order by k, l_partkey) as parts from (select l_orderkey, l_partkey, min((l_linenumber, l_suppkey)) as k from lineitem group by 1, 2) group by 1""")
def line_union(spark, d):
    one = table(spark, d, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.min(F.struct("l_linenumber", "l_suppkey")).alias("at"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("at", "l_partkey"))), lambda x: x["l_partkey"].cast("string"))
    # Rows that share a place are ordered by part, as the text of the oracle's equal keys cannot differ then.
    return one.groupBy("l_orderkey").agg(F.array_join(parts, ",").alias("parts"))


@query("q_fine_group_key", """select case when c_acctbal > 6000 then 'b:' || c_custkey when c_nationkey < 8 then 't:' || c_nationkey when c_mktsegment <> 'BUILDING' then 'd:' || c_mktsegment else 'm:' || c_name end as key,
 count(*) as n, min(c_custkey) as first from customer group by 1""")
def fine_group_key(spark, d):
    part = lambda p, c, when: F.when(when, F.concat(F.lit(p), F.col(c).cast("string")))
    key = F.coalesce(part("b:", "c_custkey", F.col("c_acctbal") > 6000), part("t:", "c_nationkey", F.col("c_nationkey") < 8), part("d:", "c_mktsegment", F.col("c_mktsegment") != "BUILDING"), F.concat(F.lit("m:"), "c_name"))
    return table(spark, d, "customer").groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min("c_custkey").alias("first"))


@query("q_first_non_missing", """select o_custkey, arg_min(o_orderpriority, o_orderkey) filter (where o_orderstatus <> 'F') as o_orderpriority,
 arg_min(o_totalprice, o_orderkey) filter (where o_totalprice > 50000) as o_totalprice from orders group by 1""")
def first_non_missing(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(*M.first_non_missing(["o_orderpriority", "o_totalprice"], "o_orderkey", {"o_orderpriority": F.col("o_orderstatus") != "F", "o_totalprice": F.col("o_totalprice") > 50000}))


@query("q_season_episode_nest", """select o_custkey, string_agg(s, ';' order by y) as seasons, sum(n)::bigint as episodes from
 (select o_custkey, year(o_orderdate) y, year(o_orderdate) || ':' || string_agg(o_orderkey, ',' order by o_orderdate, o_orderkey) as s, count(*) n from orders group by 1, 2) group by 1""")
def season_nest(spark, d):
    o = table(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    season = o.groupBy("o_custkey", "y").agg(F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey"))).alias("episodes"))
    item = season.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("y", "episodes"))).alias("seasons"))
    text = F.transform("seasons", lambda s: F.concat(s["y"].cast("string"), F.lit(":"), F.array_join(F.transform(s["episodes"], lambda e: e["o_orderkey"].cast("string")), ",")))
    return item.select("o_custkey", F.array_join(text, ";").alias("seasons"), F.aggregate("seasons", F.lit(0).cast("long"), lambda a, s: a + F.size(s["episodes"])).alias("episodes"))


@query("q_align_lines", """select l_orderkey, l_linenumber, arg_min(l_suppkey, (l_returnflag, -l_quantity, l_suppkey, l_partkey)) as main, count(*) - 1 as alternates from lineitem group by 1, 2""")
def align_lines(spark, d):
    order = F.struct("l_returnflag", -F.col("l_quantity"), "l_suppkey", "l_partkey")
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min_by("l_suppkey", order).alias("main"), (F.count("*") - 1).alias("alternates"))


@query("q_status_zero_fill", "select s as status, count(o_orderkey) as n from (values ('O'),('F'),('P'),('X'),('retryable')) v(s) left join orders on o_orderstatus = s group by 1")
def status_zero_fill(spark, d):
    counts = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    return M.zero_filled(counts, spark.createDataFrame([(s,) for s in ("O", "F", "P", "X", "retryable")], "status string"), "status")


@query("q_library_stats", "select count(*) as total, count(*) filter (where o_orderstatus='F') as done, count(*) filter (where o_orderstatus='O' and o_orderpriority like '1%') as hot_pending, count(distinct o_custkey) as owners from orders")
def library_stats(spark, d):
    return table(spark, d, "orders").agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if((F.col("o_orderstatus") == "O") & F.col("o_orderpriority").like("1%")).alias("hot_pending"), F.countDistinct("o_custkey").alias("owners"))


@query("q_site_report", "select event_type as site, count(*) as items, count(*) filter (where value > 50) as kept, count(*) filter (where value <= 50) as skipped, max(event_id) as pages, round(100.0 * count(*) filter (where value > 50) / count(*), 4) as percent from events group by 1")
def site_report(spark, d):
    kept = F.count_if(F.col("value") > 50)
    return table(spark, d, "events").groupBy(F.col("event_type").alias("site")).agg(F.count("*").alias("items"), kept.alias("kept"), F.count_if(F.col("value") <= 50).alias("skipped"), F.max("event_id").alias("pages"), F.round(100.0 * kept / F.count("*"), 4).alias("percent"))


@query("q_stage_timing", "select event_type as stage, count(*) as n, round(sum(value), 4) as total, round(avg(value), 4) as mean from events group by 1")
def stage_timing(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").alias("stage")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.round(F.avg("value"), 4).alias("mean"))


@query("q_cleanup_totals", "select o_orderpriority as category, count(*) as inspected, count(*) filter (where o_orderdate < timestamp '1997-01-01') as old, count(*) filter (where o_orderdate < timestamp '1997-01-01' and o_orderstatus <> 'F') as retained, count(*) filter (where o_orderdate < timestamp '1997-01-01' and o_orderstatus = 'F') as purged from orders group by 1")
def cleanup_totals(spark, d):
    old = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    return table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("category")).agg(F.count("*").alias("inspected"), F.count_if(old).alias("old"), F.count_if(old & (F.col("o_orderstatus") != "F")).alias("retained"), F.count_if(old & (F.col("o_orderstatus") == "F")).alias("purged"))


@query("q_content_digest", "select doc_id, md5(lang || '|' || source || '|' || text) as md5, sha1(lang || '|' || text) as sha1, sha256(text) as sha256 from documents")
def content_digest(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(F.concat_ws("|", "lang", "source", "text")).alias("md5"), F.sha1(F.concat_ws("|", "lang", "text")).alias("sha1"), F.sha2("text", 256).alias("sha256"))


@query("q_first_wins", "select md5(text) as k, min(doc_id) as doc_id, arg_min(lang, doc_id) as lang from documents group by text")
def first_wins(spark, d):
    return M.first_wins(table(spark, d, "documents").select(F.md5("text").alias("k"), "doc_id", "lang"), ["k"], ["doc_id"])


@query("q_argmax_candidate", "select l_orderkey, arg_min(l_partkey, (-l_extendedprice, l_linenumber, l_partkey)) as best, max(l_extendedprice) as score from lineitem group by 1 having max(l_extendedprice) >= 40")
def argmax(spark, d):
    best = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min_by("l_partkey", F.struct(-F.col("l_extendedprice"), "l_linenumber", "l_partkey")).alias("best"), F.max("l_extendedprice").alias("score"))
    return best.where("score >= 40")


@query("q_promotion_order", """with a as (select p_partkey, p_type, p_name, p_size, min(p_size) over (partition by p_type, p_name order by p_partkey rows between unbounded preceding and 1 preceding) as before from part),
 b as (select *, before is null or p_size < before as led from a)
 select p_partkey, case when led then min(case when led then p_partkey end) over (partition by p_type, p_name order by p_partkey rows between 1 following and unbounded following) else p_partkey end as event from b""")
def promotion(spark, d):
    return M.promotion_order(table(spark, d, "part"), ["p_type", "p_name"], "p_size", "p_partkey").select("p_partkey", "event")


@query("q_renumber_kinds", "select event_id, case when event_type in ('view','click') then sum(case when event_type in ('view','click') then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) else 0 end::bigint as number from events")
def renumber_kinds(spark, d):
    counted = F.col("event_type").isin("view", "click")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, d, "events").select("event_id", F.when(counted, F.sum(counted.cast("int")).over(w)).otherwise(0).cast("long").alias("number"))


@query("q_renumber_dated", "select event_id, case when bool_and(value < 99) over (partition by user_id) then row_number() over (partition by user_id order by ts, event_id) end as number from events")
def renumber_dated(spark, d):
    every = F.min((F.col("value") < 99).cast("int")).over(Window.partitionBy("user_id")) == 1
    return table(spark, d, "events").select("event_id", F.when(every, F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))).cast("long").alias("number"))


_ROLL = "count(*) over w as n_window, count(*) filter (where event_type = 'error') over w as n_bad"


@query("q_rolling_error_rate", f"select event_id, n_window, n_bad, n_window >= 50 and n_bad > 0.2 * n_window as trip from (select event_id, {_ROLL} from events window w as (order by ts range between interval 6 hour preceding and current row))")
def rolling(spark, d):
    return A.rolling_rate(table(spark, d, "events"), F.expr(BAD), "ts", 6 * 3600, 50, 0.2).select("event_id", "n_window", "n_bad", "trip")


@query("q_sticky_trip", f"select event_id, bool_or(n_window >= 20 and n_bad > 0.25 * n_window) over (partition by day order by ts, event_id rows unbounded preceding) as tripped from (select event_id, ts, date_trunc('day', ts) as day, {_ROLL} from events window w as (partition by date_trunc('day', ts) order by ts range between interval 2 hour preceding and current row))")
def sticky(spark, d):
    e = table(spark, d, "events").withColumn("day", F.date_trunc("day", "ts"))
    return A.sticky(A.rolling_rate(e, F.expr(BAD), "ts", 7200, 20, 0.25, ["day"]), "trip", ["ts", "event_id"], ["day"]).select("event_id", "tripped")


@query("q_consecutive_failures", """with a as (select event_id, user_id, (event_type not in ('error','click'))::int as ok, sum((event_type not in ('error','click'))::int) over (partition by user_id order by event_id) as island from events),
 b as (select event_id, sum(1 - ok) over (partition by user_id, island order by event_id) as run from a) select event_id, run::bigint as run, case when run = 0 then 'alive' when run >= 4 then 'dead' else 'unknown' end as state from b""")
def failures(spark, d):
    return A.failure_runs(table(spark, d, "events"), ~F.col("event_type").isin("error", "click"), "event_id", ["user_id"]).select("event_id", F.col("run").cast("long").alias("run"), "state")


@query("q_token_bucket", """with a as (select event_id, user_id, epoch_us(ts) as a0, row_number() over (partition by user_id order by event_id) - 1 as i from events)
 select event_id, (i * 2000000000 + max(a0 - i * 2000000000) over (partition by user_id order by event_id rows unbounded preceding) - a0)::double as wait from a""")
def token_bucket(spark, d):
    at = F.unix_micros(F.col("ts").cast("timestamp")).cast("double")  # one grant in 2000 s
    return A.token_bucket(table(spark, d, "events"), at, "event_id", 1 / 2_000_000_000, ["user_id"]).select("event_id", "wait")


@query("q_budget_prefix", "select o_orderkey, sum(o_totalprice::decimal(18,2)) over (partition by o_orderpriority order by o_orderdate, o_orderkey rows unbounded preceding) <= 5000000 as admitted from orders")
def budget(spark, d):
    cost = F.col("o_totalprice").cast("decimal(18,2)")
    return A.budget_prefix(table(spark, d, "orders"), cost, ["o_orderdate", "o_orderkey"], 5_000_000, ["o_orderpriority"], F.date_trunc("month", "o_orderdate")).select("o_orderkey", "admitted")


@query("q_breaker", "select event_id, n_calls >= 5 and n_failed > 0.25 * n_calls as open from (select event_id, count(*) over w n_calls, count(*) filter (where event_type = 'error') over w n_failed from events window w as (partition by user_id order by event_id rows between 199 preceding and current row))")
def breaker(spark, d):
    return A.breaker(table(spark, d, "events"), F.expr(BAD), "event_id", 200, 5, 0.25, ["user_id"]).select("event_id", "open")


@query("q_weighted_fifo", "select o_orderkey, row_number() over (order by epoch(o_orderdate) / (1 + o_orderkey % 3), o_orderkey) as rank from orders where o_orderstatus = 'O' order by rank limit 200")
def weighted_fifo(spark, d):
    at = (F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) / (1 + F.col("o_orderkey") % 3)).alias("at")
    top = table(spark, d, "orders").where("o_orderstatus = 'O'").select("o_orderkey", at).orderBy("at", "o_orderkey").limit(200)
    return top.select("o_orderkey", F.row_number().over(Window.orderBy("at", "o_orderkey")).cast("long").alias("rank"))


@query("q_hot_batch", "select o_orderkey from orders where o_orderpriority like '1%' order by o_orderdate desc, o_orderkey limit 500")
def hot_batch(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderpriority").like("1%")).orderBy(F.desc("o_orderdate"), "o_orderkey").select("o_orderkey").limit(500)


@query("q_retry_page", "select event_id from events where event_type = 'error' and user_id % 4 < 3 order by ts, event_id limit 100")
def retry_page(spark, d):
    return table(spark, d, "events").where("event_type = 'error' and user_id % 4 < 3").orderBy("ts", "event_id").select("event_id").limit(100)


@query("q_recheck_list", "with k as (select user_id, max(case when event_type = 'purchase' then ts end) as last_check from events group by 1) select user_id, last_check is null as never from k where last_check is null or last_check <= timestamp '2024-01-28'")
def recheck(spark, d):
    k = table(spark, d, "events").groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("t"))
    return k.where("t is null or t <= timestamp_ntz '2024-01-28'").select("user_id", F.col("t").isNull().alias("never"))


@query("q_topk_slice", "select l_orderkey, l_partkey, l_linenumber, rank from (select l_orderkey, l_partkey, l_linenumber, row_number() over (partition by l_partkey order by l_extendedprice desc, l_orderkey, l_linenumber, l_suppkey, l_quantity) as rank from lineitem) where rank <= 5")
def topk(spark, d):
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"]
    return M.top_per_key(table(spark, d, "lineitem"), ["l_partkey"], order, 5).select("l_orderkey", "l_partkey", "l_linenumber", F.col("rank").cast("long").alias("rank"))


@query("q_two_lanes", "select o_orderkey, case when o_orderdate >= timestamp '2001-07-01' then 'hot' else 'cold' end as lane, case when o_orderdate >= timestamp '2001-07-01' then 'AB' else 'A' end as tier, row_number() over (partition by o_orderdate >= timestamp '2001-07-01', o_orderpriority order by o_orderdate, o_orderkey) as rank from orders")
def two_lanes(spark, d):
    hot = F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz")
    lane = F.when(hot, "hot").otherwise("cold")
    ranked = A.running_total(table(spark, d, "orders").withColumn("lane", lane), F.lit(1), ["o_orderdate", "o_orderkey"], F.date_trunc("month", "o_orderdate"), ["lane", "o_orderpriority"], "rank")
    return ranked.select("o_orderkey", "lane", F.when(hot, "AB").otherwise("A").alias("tier"), "rank")


@query("q_ttl_expiry", "select o_orderkey, o_orderdate + case when o_orderstatus = 'F' then interval 90 day when o_orderstatus = 'P' then interval 14 day when year(o_orderdate) <= 1998 then interval 90 day else interval 45 day end as expires from orders")
def ttl(spark, d):
    days = F.when(F.col("o_orderstatus") == "F", 90).when(F.col("o_orderstatus") == "P", 14).when(F.year("o_orderdate") <= 1998, 90).otherwise(45)
    return table(spark, d, "orders").select("o_orderkey", (F.col("o_orderdate") + F.make_dt_interval(days)).alias("expires"))


@query("q_backoff", "select a::bigint as attempt, least(60.0, 0.5 * power(2, a))::double as delay from range(10) t(a)")
def backoff(spark, d):
    return spark.range(10).select(F.col("id").alias("attempt"), F.least(F.lit(60.0), 0.5 * F.pow(F.lit(2.0), F.col("id"))).alias("delay"))


@query("q_manifest", " union all ".join(f"select '{t}' as name, count(*) as n from {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")))
def manifest(spark, d):
    from functools import reduce

    from pyspark.sql import DataFrame

    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")
    return reduce(DataFrame.unionByName, [table(spark, d, t).agg(F.lit(t).alias("name"), F.count("*").alias("n")) for t in names])
