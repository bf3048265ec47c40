"""The catalogue's rules against plain-Python restatements, edge cases, and files that are written and read back."""

import json
import random
import time
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from sparkcat.functions import episodes, titles
from sparkcat.functions import udf as U
from sparkcat.operators import contract as C
from sparkcat.operators import library as L
from sparkcat.operators import prefilter as P
from sparkcat.operators import report as R
from sparkcat.operators import scoring as S
from sparkcat.operators import state as K
from sparkcat.plans import catalog
from sparkcat.sources import feeds, providers, sinks
from sparkcat.streaming import ops

DATA = "/root/testdata/sf0.001"


def plain_score(item, cand):
    """The score from its definition, without Spark."""
    form = lambda x: "".join(c for c in titles.simplified((x or "").strip().lower()) if c not in " \t-_·・:：/()（）[]【】《》\"'“”‘’,，.。")
    like = lambda a, b: SequenceMatcher(None, a, b).ratio() if a and b else 0.0
    s, c, o = form(item["title"]), form(cand["title"]), form(cand["original"])
    letters = lambda x: any("a" <= y <= "z" for y in (x or "").lower())
    name = like(s, c)
    pair = name < 0.3 and any("一" <= y <= "鿿" for y in item["title"]) and o and like(c, o) >= 0.6 and (letters(cand["title"]) or letters(cand["original"]))
    parts = [(30.0 if pair else 40 * name, 40)]
    if o and letters(item["title"]):
        parts.append((20 * like(s, o), 20))
    years = (item["year"] or "", cand["year"] or "")
    known = all(y.isdigit() for y in years)
    far = abs(int(years[0]) - int(years[1])) if known else None
    parts.append(({0: 15, 1: 10, 2: 5}.get(far, 0) if known else 8, 15))
    same = cand["kind"] == ("movie" if item["category"] == "movies" else "tv")
    parts.append((10 * same, 10))
    if item["category"] in ("tv", "anime") and item["episodes"] and cand["episodes"]:
        r = item["episodes"] / cand["episodes"]
        parts.append((10 if 0.5 <= r <= 2 else 5 if 0.25 <= r <= 4 else 0, 10))
    import math

    parts.append((min(5.0, math.log10(cand["popularity"] + 1)) if cand["popularity"] > 0 else 0, 5))
    total = 100 * sum(p for p, _ in parts) / sum(m for _, m in parts) + (10 if (item["seq"] or 1) == (titles.extract_seq(cand["title"]) or 1) else -10)
    if not same and name < 0.5 or known and far > 2 and name < 0.8 or name < 0.15 and not pair:
        return 0
    return max(0, min(100, round(total)))


def test_scores_equal_the_definition(spark):
    rng = random.Random(5)
    names = ["无间道", "无间道2", "Infernal Affairs", "庆余年", "慶餘年 第二季", "Joy of Life", "abc def", "abc", "", "家"]
    rows = []
    for _ in range(300):
        item = {"title": rng.choice(names), "category": rng.choice(["movies", "tv", "anime"]), "year": rng.choice([None, "", "2003", "2004", "2010"]), "seq": rng.choice([None, 0, 1, 2]), "episodes": rng.choice([0, 10, 40])}
        cand = {"title": rng.choice(names), "original": rng.choice(["", *names]), "year": rng.choice([None, "2003", "2005", "x"]), "kind": rng.choice(["movie", "tv"]), "popularity": rng.choice([0.0, 3.0, 1e7]), "episodes": rng.choice([0, 10, 30])}
        rows.append((*item.values(), *cand.values(), plain_score(item, cand)))
    pairs = spark.createDataFrame(rows, "title string, category string, year string, seq int, episodes int, cand_title string, cand_original string, cand_year string, media_type string, popularity double, cand_episodes int, want int")
    assert S.scored(pairs).where("score <> want").count() == 0


def test_title_and_episode_rules_never_fail():
    rng = random.Random(7)
    alphabet = "无间道第一二十百季部集期话sSeEpP0123456789()（[【】》 .-_年20022ⅡⅻHD更新至全SPOVA预告\t　"
    for _ in range(3000):
        x = "".join(rng.choice(alphabet) for _ in range(rng.randrange(14)))
        t, e = titles.title(x, "tv"), episodes.episode(x, 3)
        assert t.seq >= 1 and t.merge_key == f"tv|{t.norm_title}|{t.seq}" and (t.year is None or len(t.year) == 4)
        assert e.kind in episodes.KINDS and e.ep_number >= 0 and (e.air_date is None) == (not e.kind.startswith("air_date"))
    assert titles.title(None).norm_title == "" and episodes.episode(None, 0)[:3] == ("unknown", 1, "")


def test_align_keys():
    key = lambda x: episodes.align_key(episodes.episode(x), x)
    assert key("第01集") == key("第1集") == key("EP1") and key("正片") == key("HD中字") and key("第1期上") != key("第1期下") and key("abc") != key("abd")


def test_udfs_serve_sql(spark):
    U.register(spark)
    r = spark.sql("select parse_title('无间道2').norm_title t, parse_episode('EP12', 1).ep_number e, ratio('abcd', 'bcde') r, html_text('<b>x</b>&amp;') h, parse_seq('x season 4') s").first()
    assert (r["t"], r["e"], r["r"], r["h"], r["s"]) == ("无间道", 12, 0.75, "x &", 4)


def test_contract_on_odd_records(spark):
    rows = ['{"type":"video"}', "[1]", "null", '"x"', "{}", '{"seasons":5,"type":"series"}', '{"seasons":[],"type":"series"}', '{"alt_urls":"x","tags":["a",1],"rating":11,"type":"series","seasons":[{"season_number":1}]}']
    got = spark.createDataFrame([(x,) for x in rows], "j string").select(C.validated(F.parse_json("j")).alias("r"), C.coerced(F.parse_json("j")).alias("c")).collect()
    errors = [set(r["r"]["errors"]) for r in got]
    assert not any(r["r"]["ok"] for r in got)
    assert "url: empty" in errors[0] and errors[1] == errors[2] == errors[3] == {"record: not an object"} and "seasons: not a list" in errors[5] and "seasons: empty" in errors[6]
    assert {"alt_urls: not a list", "tags: not text"} <= errors[7] and {"rating: out of range", "seasons[0].episodes: missing"} <= set(got[7]["r"]["warnings"])
    assert all(r["c"]["item"]["status"] == "completed" and r["c"]["item"]["vote_count"] == 0 for r in got)


def test_blank_items_have_all_fields(spark):
    row = spark.range(1).select(C.blank_item(F.lit("b"), F.lit("t"), F.lit("series")).alias("i")).first()["i"].asDict()
    assert list(row) == list(C.ITEM) and row["type"] == "series" and row["rating"] is None and row["seasons"] == []


def test_prefilter_switches(spark):
    lines = F.array(F.struct(F.array(F.struct(F.lit("http://x").alias("url"))).alias("episodes")))
    one = spark.range(1)
    reason = lambda f, title, lines=lines: one.select(f.reason(F.lit(title), F.lit(None).cast("string"), F.lit("tv"), F.lit(""), lines).alias("r")).first()["r"]
    assert reason(P.Filters.of({}, require_cjk=True), "abc") == "L5|无中文字符" and reason(P.Filters.of({}, require_cjk=True), "中") is None
    assert reason(P.Filters.of({"prefilter": {"enable": False, "title_keywords": ["a"]}}), "abc") is None
    assert P.Filters.of({"prefilter": {"title_regex_blacklist": ["(", "a+"]}}).counts()["title_patterns"] == 1
    empty = one.select(P.Filters().reason(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(""), F.lit(None).cast("string"), F.lit(None).cast("array<struct<episodes:array<struct<url:string>>>>")).alias("r")).first()["r"]
    assert empty == "L5|empty_item"


def test_lines_and_series_liveness(spark):
    alive = F.array(F.lit("a.b"))
    line = lambda u: F.struct(F.array(F.struct(F.lit(u).alias("url"))).alias("episodes"))
    assert spark.range(1).select(F.size(P.kept_lines(F.array(line("https://a.b/1"), line("https://c.d/1")), alive)).alias("n")).first()["n"] == 1
    schema = "k int, seasons array<struct<episodes:array<struct<url:string,alt_urls:array<struct<url:string>>>>>>"
    rows = [(1, [([("http://dead", [("http://live",)])],)]), (2, [([("http://dead", [])],)]), (3, []), (4, [([],), ([("http://live", None)],)])]
    v = spark.createDataFrame(rows, schema).select("k", P.verified(F.lit("series"), F.lit(""), F.lit(None).cast("array<struct<url:string>>"), F.col("seasons"), lambda u: u == "http://live")["alive"].alias("up"))
    assert {r["k"]: r["up"] for r in v.collect()} == {1: True, 2: False, 3: False, 4: True}


def test_registry_by_hand(spark):
    probes = lambda *rows: spark.createDataFrame(list(rows), "d string, t long, ok boolean")
    registry = spark.createDataFrame([], "d string, state string, ok_count long, fail_count long, first_seen long, last_check long, last_ok long")
    states = []
    for batch in (probes(("a", 1, True)), probes(("a", 2, False), ("a", 3, False), ("a", 4, False)), probes(("a", 5, False), ("b", 5, True)), probes(("a", 910, True))):
        registry = K.registry_after(registry, batch, "d", "t", "ok")
        states.append({r["d"]: r["state"] for r in registry.collect()})
    assert states == [{"a": "alive"}, {"a": "unknown"}, {"a": "dead", "b": "alive"}, {"a": "alive", "b": "alive"}]
    ask = lambda state, last, now: spark.range(1).select(K.should_probe(F.lit(state), F.lit(last), F.lit(now)).alias("p")).first()["p"]
    assert [ask("dead", 5, 904), ask("dead", 5, 905), ask("alive", 5, 9999), ask("unknown", 5, 6), ask(None, None, 1)] == [False, True, False, True, True]


def test_library_keeps_null_states(spark):
    """A known row with a null state is no new one."""
    from sparkcat.operators import merge

    state = spark.createDataFrame([(1, "old", None)], "key long, v string, scraped int")
    batch = spark.createDataFrame([(1, "new"), (2, "x")], "key long, v string").withColumn("_in_batch", F.lit(True))
    assert {r["key"]: r["branch"] for r in merge.upsert(state, batch, "key", ["v"]).collect()} == {1: "refresh", 2: "insert"}


def test_distinct_lines_keep_order(spark):
    rows = [([("http://a/",), ("https://b",), ("https://a",), ("",), (None,), ("b",)],)]
    out = spark.createDataFrame(rows, "l array<struct<url:string>>").select(L.distinct_lines(F.col("l")).alias("l")).first()["l"]
    assert [x["url"] for x in out] == ["http://a/", "https://b"]


def test_distinct_lines_of_many_take_linear_time(spark):
    """Twice 10,000 URLs: comparing each with all others would take minutes."""
    lines = F.transform(F.sequence(F.lit(0), F.lit(19_999)), lambda i: F.struct(F.concat(F.lit("https://x/"), (i % 10_000).cast("string")).alias("url")))
    began = time.time()
    out = spark.range(1).select(L.distinct_lines(lines).alias("l")).first()["l"]
    assert [x["url"] for x in out] == [f"https://x/{i}" for i in range(10_000)] and time.time() - began < 20


def test_coarse_entity_of_many_rows_takes_linear_time(spark):
    rows = spark.range(8_000).select(F.lit("k").alias("k"), F.col("id").alias("arrival"), (F.col("id") % 3).cast("int").alias("priority"), F.array(F.struct(F.concat(F.lit("https://x/"), F.col("id").cast("string")).alias("url")), F.struct(F.lit("http://y/").alias("url"))).alias("lines"))
    began = time.time()
    e = L.coarse_entities(rows, ["k"], "priority", "lines", "arrival").first()
    assert e["primary"]["arrival"] == 0 and len(e["siblings"]) == 7_999 and time.time() - began < 20
    assert [x["url"] for x in e["lines"]] == ["https://x/0", "http://y/", *(f"https://x/{i}" for i in range(1, 8_000))]


def test_items_shuffle_lines_not_episodes(spark):
    """Episodes are made of a line's numbers where its item is, so that a line's numbers are all that is shuffled."""
    from sparkcat.plans import catalogue

    sc = spark.sparkContext

    def shuffled():
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = shuffled()
    catalogue._items(spark, "/root/testdata/sf0.01").write.format("noop").mode("overwrite").save()
    time.sleep(1)  # figures of the last tasks come in late
    assert 0 < shuffled() - before < 25 * 60_000


def test_product_is_written_whole(spark, tmp_path):
    items = spark.createDataFrame([("a", "t", "x, y", "p", [(1, [(1, "u")]), (2, [])]), ("b", "t", None, "p", [])], "bangou string, title string, tags string, poster string, seasons array<struct<season_number:int,episodes:array<struct<ep_number:int,poster:string>>>>")
    got = {r["part"]: r for r in sinks.write_product(items, spark.createDataFrame([(1,)], "k int"), f"file://{tmp_path}/p", "2.1", "now").collect()}
    assert {k: r["rows"] for k, r in got.items()} == {"items": 2, "episodes": 1, "unmatched": 1} and all(len(r["sha256"]) == 64 for r in got.values())
    back = [json.loads(line) for f in (tmp_path / "p" / "items").glob("part-*") for line in f.read_text().splitlines()]
    assert not any("poster" in json.dumps(x) for x in back) and {x["bangou"]: x.get("tags") for x in back} == {"a": ["x", "y"], "b": []}
    assert not (tmp_path / "p" / "items.new").exists() and sinks.shard_count(4001) == 3


def test_playlists_are_all_or_nothing(spark, tmp_path):
    df = spark.createDataFrame([("tv", f"b{i}", f"#EXTM3U\nu{i}") for i in range(6)], "category string, bangou string, text string")
    ticks = iter(range(0, 1000, 10))
    assert sinks.write_playlists_within(df, f"file://{tmp_path}/m", "category", "bangou", "text", 10.0, 2, lambda: next(ticks)) == (0, True) and not (tmp_path / "m").exists()
    assert sinks.write_playlists_within(df, f"file://{tmp_path}/m", "category", "bangou", "text", 100.0, 2, lambda: next(ticks)) == (6, False)
    files = list((tmp_path / "m").glob("category=tv/bangou=*/part-*"))
    assert len(files) == 6 and sorted(f.read_text() for f in files)[0] == "#EXTM3U\nu0\n" and sinks.projected_seconds(100, 0, 1.0) == 0


def test_sites_plug_in(spark):
    @providers.crawler("demo")
    def demo(spark, site):
        return spark.createDataFrame([("1", "t", site["name"], None)], "raw_id string, raw_title string, site string, update_time timestamp").withColumn("priority", F.lit(1))

    items, report = providers.harvest(spark, [{"name": "x", "type": "demo"}, {"name": "y", "type": "demo"}], progress={"y": {"page": 3, "done": True}})
    assert [r["site"] for r in items.collect()] == ["x"] and report.first()["new"] == 1
    with pytest.raises(ValueError, match="no crawler"):
        providers.site_items(spark, {"name": "z", "type": "none"})
    assert providers.advance(providers.advance({}, "a", 5), "a", 3, True) == {"a": {"page": 5, "done": True}}


def test_paged_site_resumes(spark, tmp_path):
    row = {"vod_id": "1", "vod_name": "t", "vod_play_url": "第01集$https://x/1.m3u8", "vod_remarks": "更新至12集", "vod_actor": "A", "vod_time": "2026-09-08 12:33:45"}
    (tmp_path / "s").mkdir()
    for page in (1, 2, 3):
        (tmp_path / "s" / f"{page}.json").write_text(json.dumps({"list": [{**row, "vod_id": str(page)}]}))
    site = {"name": "s", "api_url": str(tmp_path), "start_page": 2, "priority": 4}
    got = providers.site_items(spark, site).collect()
    assert sorted(r["raw_id"] for r in got) == ["2", "3"] and got[0]["episode"] == 12 and got[0]["actor"] == "A" and got[0]["priority"] == 4
    assert providers.site_items(spark, {**site, "since": "2027-01-01"}).count() == 0 and feeds.enabled_sites([site]) == [site]


def test_newer_rows_survive_older_batches(spark, tmp_path):
    write = ops.versioned_upsert(spark, f"file://{tmp_path}/t", "k", "o")
    for n, o in enumerate((9, 3, 12, 5)):
        write(spark.createDataFrame([(1, o)], "k long, o long"), n)
    assert [r["o"] for r in spark.read.parquet(f"file://{tmp_path}/t/v3").collect()] == [12] and sorted(x.name for x in (tmp_path / "t").iterdir()) == ["v2", "v3"]


def test_reports():
    assert R.lookup_budget(1000, 600, 4.0) == (600, 2160) and R.lookup_budget(50, 600, 4.0) == (0.0, 0)
    assert R.summary_text({"a": 1}) == "a: 1" and "&lt;" in R.summary_html("x", {"<": 2})


def test_all_queries_have_oracles():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) <= {"q_candidate_score_ratio"}


def test_ratio_scores_by_hand(spark):
    got = {r["c_custkey"]: (r["best"], r["score"]) for r in catalog.queries()["q_candidate_score_ratio"](spark, DATA).collect()}
    customers = [r for r in spark.read.parquet(f"{DATA}/customer.parquet").collect()]
    suppliers = sorted((r["s_suppkey"], r["s_name"], r["s_nationkey"]) for r in spark.read.parquet(f"{DATA}/supplier.parquet").collect())
    want = {}
    for c in customers:
        near = [(k, n) for k, n, nation in suppliers if nation == c["c_nationkey"]][:5]
        scores = [(-round(100 * SequenceMatcher(None, c["c_name"].lower(), n.lower()).ratio()), i, k) for i, (k, n) in enumerate(near)]
        if scores:
            want[c["c_custkey"]] = (min(scores)[2], -min(scores)[0])
    assert got == want
