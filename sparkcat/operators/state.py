"""Keyed state as tables: the lookup cache with its kinds of misses, guards on what may be written, the domain registry,
the retry queue, change detection, and the library's cursor. Each step maps a table and a batch to the next table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400
#: Seconds that an entry of each kind is good for (fixed values).
TTL = {"hit": 90 * DAY, "soft_miss": 14 * DAY, "hard_miss": 45 * DAY, "old_hard_miss": 90 * DAY}
#: Consecutive failures that make a domain dead, and seconds until it is tried once more.
DEAD_AFTER, HALF_OPEN = 4, 900


def ttl_seconds(kind: Column, year: Column, this_year: int) -> Column:
    """Misses of titles that are three years old or more last longer, as nothing new will come."""
    y = year.try_cast("int")
    old = (kind == "hard_miss") & (y > 0) & (y <= this_year - 3)
    return F.when(kind == "hit", TTL["hit"]).when(old, TTL["old_hard_miss"]).when(kind == "hard_miss", TTL["hard_miss"]).otherwise(TTL["soft_miss"])


def cache_key(category: Column, title: Column, seq: Column, year: Column, version: str = "v6") -> Column:
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat_ws("|", F.lit(version), text(category), text(title), F.coalesce(F.nullif(text(seq), F.lit("")), F.lit("1")), text(year))


def cache_lookup(items: DataFrame, cache: DataFrame, key: str, now: int, include_stale: bool = False) -> DataFrame:
    """Items with the cache's `cache_status`: hit, soft_miss, hard_miss, none; expired entries are stale if asked, else none."""
    c = cache.select(key, F.col("status").alias("_status"), "expires", *[x for x in cache.columns if x not in (key, "status", "expires", *items.columns)])
    expired = F.when(F.lit(include_stale), "stale").otherwise("none")
    status = F.when(F.col("_status").isNull(), "none").when(F.col("expires") <= now, expired).otherwise(F.col("_status"))
    return items.join(c, key, "left").withColumn("cache_status", status).drop("_status", "expires")


def to_look_up(items: DataFrame, cache: DataFrame, key: str, now: int) -> DataFrame:
    """Items that no valid entry answers: an anti join, before any candidate is scored."""
    return items.join(cache.where(F.col("expires") > now).select(key), key, "left_anti")


def admitted_writes(results: DataFrame, now: int, this_year: int, negative: Column | None = None) -> DataFrame:
    """Cache entries (with expires) of lookup results: hits always; misses only if confirmed and `negative` (the guard: not
    tripped, paused or switched off) holds; retryable ones never. results: kind, year."""
    open_ = F.coalesce(negative if negative is not None else F.lit(True), F.lit(False))
    kept = results.where((F.col("kind") == "hit") | (F.col("kind").isin("soft_miss", "hard_miss") & open_))
    return kept.withColumn("expires", (F.lit(now) + ttl_seconds(F.col("kind"), F.col("year"), this_year)).cast("long")).withColumnRenamed("kind", "status").withColumn("ts", F.lit(now).cast("long"))


def merged_cache(cache: DataFrame, writes: DataFrame, key: str, order: str = "ts") -> DataFrame:
    """The cache after writes: the newest entry per key, writes before older entries of the same time."""
    both = cache.withColumn("_new", F.lit(0)).unionByName(writes.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in both.columns if c not in (key, "_new")]
    return both.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(order, "_new")).alias("r")).select(key, "r.*")


def keep_stale(cache: DataFrame, failed: DataFrame, key: str, now: int, seconds: int = TTL["hit"]) -> DataFrame:
    """Expired entries whose renewal failed stay good for another while (stale while error)."""
    hit = failed.select(key).distinct().withColumn("_failed", F.lit(True))
    return cache.join(hit, key, "left").withColumn("expires", F.when(F.col("_failed") & (F.col("expires") <= now), F.lit(now + seconds)).otherwise(F.col("expires"))).drop("_failed")


def guard_states(log: DataFrame, ts: str, ok: Column, code: Column, seconds: int = 300, least: int = 50, most: float = 0.30, pause: int = 30, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per request, whether misses may still be cached after it, and why not: error_rate_exceeded (sticky) or 429_pause.

    log: one row per request in order of `ts` (epoch seconds) within its keys; use keys that split the log, such as the run.
    """
    w = Window.partitionBy(*keys).orderBy(ts)
    window = w.rangeBetween(-seconds, 0)
    n, bad = F.count("*").over(window), F.sum((~ok).cast("long")).over(window)
    out = log.withColumn("_trip", ((n >= least) & (bad > most * n)).cast("int"))
    out = out.withColumn("_tripped", F.max("_trip").over(w.rangeBetween(Window.unboundedPreceding, 0)) == 1)
    limited = F.max(F.when(code == 429, F.col(ts))).over(w.rangeBetween(Window.unboundedPreceding, 0))
    paused = F.coalesce(F.col(ts) < limited + pause, F.lit(False))
    return out.withColumn("reason", F.when(paused, "429_pause").when(F.col("_tripped"), "error_rate_exceeded").otherwise("")).withColumn("negative", F.col("reason") == "").drop("_trip", "_tripped")


def registry_after(registry: DataFrame, probes: DataFrame, domain: str, order: str, ok: str) -> DataFrame:
    """The domain registry after a batch of probes in order: state, ok_count, fail_count (in a row), last_check, last_ok.

    One aggregate per domain: failures after its last success, on top of the earlier run if there was no success.
    """
    good = F.col(ok)
    batch = probes.groupBy(domain).agg(
        F.count_if(good).alias("_oks"), F.max(order).alias("_last"), F.max(F.when(good, F.col(order))).alias("_last_ok"), F.collect_list(F.when(~good, F.col(order))).alias("_fails"), F.min(order).alias("_first"),
    )
    run = F.size(F.filter("_fails", lambda t: F.col("_last_ok").isNull() | (t > F.col("_last_ok"))))
    both = registry.join(batch.withColumn("_run", run).drop("_fails"), domain, "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    fails = F.when(F.col("_last").isNull(), zero("fail_count")).otherwise(F.col("_run") + F.when(F.col("_last_ok").isNull(), zero("fail_count")).otherwise(0))
    state = F.when(F.col("_last").isNull(), F.col("state")).when(fails == 0, "alive").when(fails >= DEAD_AFTER, "dead").otherwise("unknown")
    return both.select(
        domain, state.alias("state"), (zero("ok_count") + zero("_oks")).alias("ok_count"), fails.alias("fail_count"), F.coalesce("first_seen", "_first").alias("first_seen"),
        F.greatest("last_check", "_last").alias("last_check"), F.greatest("last_ok", "_last_ok").alias("last_ok"),
    )


def should_probe(state: Column, last_check: Column, now: Column) -> Column:
    """New and unknown domains always, live ones never, dead ones once HALF_OPEN seconds have passed."""
    return F.when(state.isNull() | (state == "unknown"), True).when(state == "alive", False).otherwise(now - F.coalesce(last_check, F.lit(0)) >= HALF_OPEN)


def queue_after(queue: DataFrame, failures: DataFrame, key: str, done: DataFrame | None = None) -> DataFrame:
    """The retry queue (key, item, attempts, last_err, ts) after failures: one attempt more for each, the newest kept; what is
    done leaves it."""
    new = failures.groupBy(key).agg(F.max_by(F.struct("item", "last_err", "ts"), "ts").alias("n"), F.count("*").cast("int").alias("more"))
    both = queue.join(new, key, "full_outer")
    pick = lambda c: F.when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(c)).alias(c)
    out = both.select(key, pick("item"), (F.coalesce("attempts", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("attempts"), pick("last_err"), pick("ts"))
    return out if done is None else out.join(done.select(key), key, "left_anti")


def due_retries(queue: DataFrame, limit: int = 100, max_attempts: int = 0) -> DataFrame:
    """The oldest entries, of at most so many attempts (0: any)."""
    return (queue.where(F.col("attempts") <= max_attempts) if max_attempts else queue).orderBy("ts").limit(limit)


def changes(rows: DataFrame, seen: DataFrame, keys: list[str], content: list[str]) -> DataFrame:
    """Rows with `change`: new, updated (other content) or skipped; times are no content. seen: keys, content_hash."""
    out = rows.withColumn("content_hash", content_hash(*content))
    old = seen.select(*keys, F.col("content_hash").alias("_old"))
    return out.join(old, keys, "left").withColumn("change", F.when(F.col("_old").isNull(), "new").when(F.col("_old") != F.col("content_hash"), "updated").otherwise("skipped")).drop("_old")


def content_hash(*columns: str) -> Column:
    """sha1 of the columns' values as JSON with sorted names."""
    return F.sha1(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}))


def library_after(library: DataFrame, batch: DataFrame, key: str, now: int, hot_days: float = 7.0) -> DataFrame:
    """The library after coarse entities (key, payload, last_updated, weight): new keys are inserted; of known ones those not
    yet looked up take the new payload, looked-up ones that are hot start over, other looked-up ones keep theirs; the times
    are renewed in every case."""
    cutoff = now - int(hot_days * DAY)
    b = batch.select(key, F.struct("payload", F.greatest(F.coalesce("last_updated", F.lit(0)), F.lit(0)).cast("long").alias("last_updated"), F.coalesce("weight", F.lit(1.0)).alias("weight")).alias("b"))
    both = library.withColumn("_known", F.lit(True)).join(b, key, "full_outer")
    new, known = F.col("b").isNotNull(), F.col("_known").isNotNull()
    hot = F.when(new, (F.col("b.last_updated") >= cutoff).cast("int")).otherwise(F.col("is_new"))
    done = known & (F.coalesce("scraped", F.lit(0)) > 0)
    fresh, again = new & ~done, new & done & (hot == 1)
    reset = lambda c, v, kind: F.when(again | (new & ~known), F.lit(v).cast(kind)).otherwise(F.col(c)).alias(c)
    return both.select(
        key, F.when(fresh | again, F.col("b.payload")).otherwise(F.col("payload")).alias("payload"), F.coalesce("first_seen", F.lit(now)).cast("long").alias("first_seen"),
        F.when(new, F.col("b.last_updated")).otherwise(F.col("last_updated")).alias("last_updated"), reset("scraped", 0, "int"), reset("scrape_status", None, "string"), reset("confidence", None, "int"), reset("attempts", 0, "int"),
        F.when(known, F.col("weight")).otherwise(F.col("b.weight")).alias("weight"), hot.alias("is_new"),
        F.when(~new, "keep").when(~known, "insert").when(again, "requeue").when(done, "touch").otherwise("refresh").alias("branch"),
    )


def advanced(library: DataFrame, outcomes: DataFrame, key: str) -> DataFrame:
    """The library after lookups (key, status, confidence, payload, backfilled): retryable ones stay pending with an attempt
    more; others are done (1, or 2 if details were filled in), with the new payload where there is one."""
    o = outcomes.select(key, F.struct("status", "confidence", "payload", "backfilled").alias("o"))
    both = library.join(o, key, "left")
    hit, retry = F.col("o").isNotNull(), F.coalesce(F.col("o.status") == "retryable", F.lit(False))
    took = lambda c, value: F.when(hit, value).otherwise(F.col(c))
    return both.withColumns({
        "scraped": F.when(hit & ~retry, F.when(F.coalesce("o.backfilled", F.lit(False)), 2).otherwise(1)).otherwise(F.col("scraped")), "scrape_status": took("scrape_status", F.col("o.status")),
        "confidence": took("confidence", F.col("o.confidence").cast("int")), "attempts": F.col("attempts") + F.when(retry, 1).otherwise(0), "payload": F.coalesce(F.when(hit & ~retry, F.col("o.payload")), F.col("payload")),
    }).drop("o")


def cold_batch(library: DataFrame, quota: int, max_attempts: int = 3) -> DataFrame:
    """Pending entries by first_seen / weight, so that heavy categories come first."""
    return library.where((F.col("scraped") == 0) & (F.col("attempts") < max_attempts)).orderBy(F.col("first_seen") / F.col("weight"), F.col("first_seen")).limit(quota)


def hot_batch(library: DataFrame, limit: int = 500, max_attempts: int = 3) -> DataFrame:
    return library.where((F.col("scraped") == 0) & (F.col("is_new") == 1) & (F.col("attempts") < max_attempts)).orderBy(F.desc("last_updated")).limit(limit)


def hit_items(library: DataFrame, schema: str, key: str) -> DataFrame:
    """Entries that were found, their JSON payload decoded, with confidence; a payload that is no JSON gives nulls."""
    return library.where("scrape_status = 'hit'").select(key, "confidence", F.from_json("payload", schema).alias("x")).select(key, "confidence", "x.*")


def outcome_counts(outcomes: DataFrame, *by: str) -> DataFrame:
    kinds = ("hit", "soft_miss", "hard_miss", "retryable", "category_discard", "skip")
    return outcomes.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(F.col("status") == k).alias(k) for k in kinds])
