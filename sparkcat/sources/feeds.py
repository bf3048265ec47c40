"""Sources: paged JSON feeds as a Python data source, JSON documents and JSON lines, layered settings."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FEED_FIELDS = ["vod_id", "vod_name", "type_name", "vod_year", "vod_play_from", "vod_play_url", "vod_pic", "vod_content", "vod_douban_id", "vod_douban_score", "vod_actor", "vod_director", "vod_remarks", "vod_time"]
FEED_SCHEMA = "site string, page int, " + ", ".join(f"{c} string" for c in FEED_FIELDS)


class PagePartition(InputPartition):
    def __init__(self, page: int):
        self.page = page


class PagedFeed(DataSource):
    """Pages of a site's feed, one partition each: <path>/<site>/<page>.json, or mirrors of it tried in order.

    Options: path, site, pages (how many; else the folder's), start (the first page to read), mirrors (comma-separated other
    paths).
    """

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return FEED_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(dict(self.options))


class PagedReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.site = options["site"]
        self.roots = [options["path"], *filter(None, options.get("mirrors", "").split(","))]
        self.pages = int(options["pages"]) if "pages" in options else None
        self.start = int(options.get("start", 1))

    def partitions(self) -> list[InputPartition]:
        n = self.pages
        if n is None:
            n = len([f for f in os.listdir(f"{self.roots[0]}/{self.site}") if f.endswith(".json")])
        return [PagePartition(i) for i in range(self.start, n + 1)]

    def read(self, partition: PagePartition) -> Iterator[tuple]:
        for root in self.roots:  # ordered mirrors: the first that answers counts
            try:
                with open(f"{root}/{self.site}/{partition.page}.json", encoding="utf-8") as f:
                    page = json.load(f)
                break
            except (OSError, ValueError):
                continue
        else:
            raise RuntimeError(f"no mirror has page {partition.page} of {self.site}")
        for row in page.get("list") or []:
            yield (self.site, partition.page, *[None if row.get(c) is None else str(row[c]) for c in FEED_FIELDS])


def read_feed(spark: SparkSession, path: str, site: str, **options: str) -> DataFrame:
    spark.dataSource.register(PagedFeed)
    return spark.read.format("paged_feed").options(path=path, site=site, **options).load()


def raw_items(feed: DataFrame, category: Column) -> DataFrame:
    """Feed rows as catalogue items: rows without a title or without a playable line are dropped."""
    from ..functions import text as T
    from . import providers

    out = feed.withColumn("lines", T.play_lines(F.col("vod_play_url"), F.col("vod_play_from")))
    return out.where(T.present("vod_name").isNotNull() & (F.size("lines") > 0)).select(
        F.col("vod_id").alias("raw_id"), "site", T.present("vod_name").alias("raw_title"), category.alias("category"), F.col("type_name").alias("sub_category"),
        T.year_of(F.coalesce("vod_year", F.lit(""))).alias("year"), F.col("vod_pic").alias("poster"), T.html_plain(F.col("vod_content")).alias("overview"),
        F.col("vod_douban_id").alias("douban_id"), F.col("vod_douban_score").try_cast("double").alias("douban_score"), T.parse_time(F.col("vod_time")).alias("update_time"), "lines",
        *[T.html_plain(F.col(f"vod_{c}")).alias(c) for c in ("actor", "director", "remarks")], providers.episode_count(F.concat_ws(" ", "vod_remarks", "vod_name")).alias("episode"),
    )


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, plain or gzip."""
    return spark.read.schema(schema).json(path)


def read_json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def layered(defaults: Mapping, *layers: Mapping, env: Mapping[str, str] | None = None, prefix: str = "SPARKCAT_") -> dict:
    """Defaults, then each layer, then environment values coerced to the default's type."""
    out = dict(defaults)
    for layer in layers:
        for k, v in layer.items():
            out[k] = {**out[k], **v} if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    for k, v in (env or {}).items():
        name = k.removeprefix(prefix).lower()
        if k.startswith(prefix) and name in out:
            kind = type(out[name])
            out[name] = v.lower() in ("1", "true", "yes", "on") if kind is bool else kind(v) if kind in (int, float, str) else json.loads(v)
    return out


def enabled_sites(sites: list[Mapping]) -> list[Mapping]:
    return sorted((s for s in sites if s.get("enabled", True)), key=lambda s: (s.get("priority", 99), s["name"]))
