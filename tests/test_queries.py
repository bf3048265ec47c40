"""Every query with an oracle gives DuckDB's rows, and goldens and state machines behave."""

import glob
import json
import os
import time

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkcat.functions import udf as U
from sparkcat.operators import admission as A
from sparkcat.operators import merge as M
from sparkcat.plans import catalog
from sparkcat.sources import feeds
from sparkcat.streaming import ops as S

DATA = "/root/testdata/sf0.001"
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def rows(df: pd.DataFrame) -> list:
    def one(x):
        if pd.isna(x):
            return "NULL"
        if isinstance(x, bool) or type(x).__name__ == "bool":
            return str(bool(x))
        if type(x).__name__.startswith(("int", "float", "Dec")):
            return repr(round(float(x), 4))
        return str(x)

    df = df[sorted(df.columns)]
    return sorted(tuple(map(one, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    got, want = catalog.queries()[name](spark, DATA).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("parts", ["1", "8"])
def test_partitioning_does_not_matter(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = rows(catalog.queries()["q_promotion_order"](spark, DATA).toPandas())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == rows(catalog.queries()["q_promotion_order"](spark, DATA).toPandas())


def test_guard_trips_above_threshold_only(spark):
    def trips(errors, n):
        log = spark.range(n).select("id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"))
        return A.rolling_rate(log, F.col("id") < errors, "ts", 300, 50, 0.30).where("trip").count()

    assert trips(16, 50) == 1 and trips(15, 50) == 0 and trips(30, 49) == 0


def test_rolling_counts_do_not_grow_with_the_window(spark):
    """100,000 rows in one window; windows reach over a block's end and hold rows at both of their own."""
    log = spark.range(100_000).select("id", F.timestamp_millis(F.lit(1_700_000_000_000) + 10 * F.col("id")).alias("ts"))
    began = time.time()
    got = A.rolling_rate(log, F.col("id") % 2 == 0, "ts", 600, 50, 0.30).agg(F.count_if((F.col("n_window") == F.least(F.col("id") + 1, F.lit(60_001))) & (F.col("n_bad") == F.expr("id div 2 + 1 - greatest(0, (id - 60000 + 1) div 2)"))).alias("n")).first()["n"]
    assert got == 100_000 and time.time() - began < 20


@pytest.mark.parametrize("name, kind, seconds", [("q_breaker_cooldown", "error", 90_000), ("q_guard_reason", "click", 86_400)])
def test_epoch_seconds_round_as_in_sql(spark, tmp_path, name, kind, seconds):
    """Calls just before and after a pause ends, by fractions of a second on both sides."""
    at = lambda i: 0.1 * (i % 10)
    log = [(u * 10 + i, u, 1_700_000_000 + (i if i < 6 else seconds + 5) + at(u if i < 6 else u // 10), kind if i < 6 else "view") for u in range(100) for i in range(7)]
    events = spark.createDataFrame(log, "event_id long, user_id long, s double, event_type string").select("event_id", "user_id", F.timestamp_micros(F.round(F.col("s") * 1_000_000).cast("long")).cast("timestamp_ntz").alias("ts"), "event_type")
    events.write.parquet(f"{tmp_path}/events.parquet")
    c = duckdb.connect()
    c.sql(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert rows(catalog.queries()[name](spark, str(tmp_path)).toPandas()) == rows(c.sql(ORACLES[name]).df())


def test_sticky_goes_by_time_before_id(spark, tmp_path):
    """30 errors of a day, the later ones with the smaller ids."""
    events = spark.range(30).select((100 - F.col("id")).alias("event_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).cast("timestamp_ntz").alias("ts"), F.lit("error").alias("event_type"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    got = catalog.queries()["q_sticky_trip"](spark, str(tmp_path)).where("tripped").toPandas()["event_id"]
    assert sorted(got) == list(range(71, 82))


def test_token_bucket_grants(spark):
    got = A.token_bucket(spark.range(8), F.lit(0.0), "id", 4.0).orderBy("id").toPandas()["grant_at"].tolist()
    assert got == [0, 0.25, 0.5, 0.75, 1.0, 1.25, 1.5, 1.75]


def test_failure_states(spark):
    log = spark.createDataFrame([(1, i, x) for i, x in enumerate([True, False, False, False, False, True])], "k int, i int, ok boolean")
    got = A.failure_runs(log, F.col("ok"), "i", ["k"]).orderBy("i").toPandas()["state"].tolist()
    assert got == ["alive", "unknown", "unknown", "unknown", "dead", "alive"]


def test_upsert_is_idempotent(spark):
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "key long, v string").withColumn("_in_batch", F.lit(True))
    state = spark.createDataFrame([(2, "old", 1), (3, "c", 0)], "key long, v string, scraped int")
    once = M.upsert(state, batch, "key", ["v"])
    assert {r["key"]: (r["branch"], r["v"], r["scraped"]) for r in once.collect()} == {1: ("insert", "a", 0), 2: ("touch", "old", 1), 3: ("keep", "c", 0)}
    twice = M.upsert(once.drop("branch"), batch, "key", ["v"])
    assert {(r["key"], r["v"], r["scraped"]) for r in twice.collect()} == {(r["key"], r["v"], r["scraped"]) for r in once.collect()}


def test_numerals_and_brackets():
    assert [U.numeral(x) for x in ("十二", "二十", "一百零三", "两", "7", "x")] == [12, 20, 103, 2, 7, None]
    assert U.without_brackets("a（b[c]d）e】f").split() == ["a", "e】f"] and U.without_brackets("e【f").strip() == "e"  # an open bracket hides the rest
    assert U.title_parts("2012")[0] == "2012" and U.title_parts(None) == ("", 1, None)


def test_paged_feed(spark, tmp_path):
    good = {"vod_id": "101", "vod_name": "无间道2", "type_name": "动作片", "vod_year": "2003", "vod_play_from": "a$$$b", "vod_content": "<p>a&nbsp;b</p>", "vod_time": "2026-09-08 12:33:45",
            "vod_play_url": "第01集$https://x.example/1.m3u8#第02集$https://x.example/2.m3u8$$$第01集$https://y.example/1.m3u8"}
    blank = {**good, "vod_id": "102", "vod_name": " "}
    dead = {**good, "vod_id": "103", "vod_play_url": "x$ftp://z"}
    for root, page, items in (("main", 1, [good, blank]), ("spare", 2, [dead, {**good, "vod_id": "104", "vod_time": "garbage"}])):
        os.makedirs(tmp_path / root / "s1", exist_ok=True)
        (tmp_path / root / "s1" / f"{page}.json").write_text(json.dumps({"pagecount": 2, "limit": 20, "list": items}))
    feed = feeds.read_feed(spark, str(tmp_path / "main"), "s1", pages="2", mirrors=str(tmp_path / "spare"))
    items = {r["raw_id"]: r for r in feeds.raw_items(feed, F.lit("movies")).collect()}
    assert set(items) == {"101", "104"}
    assert [len(x["episodes"]) for x in items["101"]["lines"]] == [2, 1] and items["101"]["overview"] == "a b"
    assert items["101"]["year"] == "2003" and items["104"]["update_time"] is None


def test_settings_layers():
    base = {"rate": 4, "on": True, "maps": {"a": 1}, "words": ["x"]}
    got = feeds.layered(base, {"maps": {"b": 2}}, env={"SPARKCAT_RATE": "7", "SPARKCAT_ON": "no", "SPARKCAT_WORDS": '["y"]', "OTHER": "1"})
    assert got == {"rate": 7, "on": False, "maps": {"a": 1, "b": 2}, "words": ["y"]}
    assert [s["name"] for s in feeds.enabled_sites([{"name": "b"}, {"name": "a", "priority": 5}, {"name": "c", "enabled": False}])] == ["a", "b"]


def test_traditional_titles_meet_simplified_ones():
    from sparkcat.functions.udf import title_parts

    assert [title_parts(x)[0] for x in ("為動華園傳體", "龜優傷偵傑億")] == ["为动华园传体", "龟优伤侦杰亿"]
