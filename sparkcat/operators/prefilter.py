"""The catalogue's five filters of raw items, cheapest first, and its maintenance rules: age and liveness of items."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import taxonomy
from ..functions import text as T


def _long_first(*lists: Sequence[str]) -> list[str]:
    return sorted({str(w) for some in lists for w in some if w}, key=lambda w: (-len(w), w))


@dataclass(frozen=True)
class Filters:
    """The rules in force; lists come from several places of the settings and are joined without repeats, longest first."""

    skip_categories: tuple[str, ...] = ()
    sub_category_words: tuple[str, ...] = ()
    title_patterns: tuple[str, ...] = ()
    title_words: tuple[str, ...] = ()
    require_cjk: bool = False
    enabled: bool = True

    @classmethod
    def of(cls, settings: Mapping, config: Mapping | None = None, require_cjk: bool = False) -> Filters:
        """From settings; a pattern that is no regular expression is left out."""
        own, get = settings.get("prefilter") or {}, lambda m, k: list(m.get(k) or [])
        patterns = []
        for p in get(own, "title_regex_blacklist"):
            try:
                re.compile(str(p))
                patterns.append(str(p))
            except re.error:
                continue
        return cls(
            tuple(sorted({*get(own, "skip_categories"), *get(settings, "crawl_skip_categories")})),
            tuple(_long_first(get(own, "sub_category_blacklist"), get(settings, "crawl_skip_type_keywords"), get(config or {}, "sub_category_blacklist"))), tuple(patterns),
            tuple(_long_first(get(own, "title_keywords"), get(settings, "crawl_skip_title_keywords"))), require_cjk, bool(own.get("enable", True)),
        )

    def counts(self) -> dict[str, object]:
        return {"enabled": self.enabled, "require_cjk": self.require_cjk, "skip_categories": list(self.skip_categories), "sub_category_words": len(self.sub_category_words), "title_words": len(self.title_words), "title_patterns": len(self.title_patterns)}

    def reason(self, raw_title: Column, title: Column, category: Column, sub_category: Column, lines: Column) -> Column:
        """Why a raw item is left out, or null: the first of L1 to L5 that objects. A missing category is told by the
        sub-category or title. lines: an array of structs with `episodes`, an array of structs with `url`."""
        if not self.enabled:
            return F.lit(None).cast("string")
        text = lambda c: F.trim(F.coalesce(c, F.lit("")))
        name, sub = F.coalesce(F.nullif(text(raw_title), F.lit("")), text(title)), text(sub_category)
        kind = F.coalesce(F.nullif(text(category), F.lit("")), taxonomy.normalize_category(F.coalesce(F.nullif(sub, F.lit("")), text(raw_title))))
        any_ = lambda xs, f: F.coalesce(F.exists(xs, lambda x: F.coalesce(f(x), F.lit(False))), F.lit(False))
        playable = any_(lines, lambda l: any_(l["episodes"], lambda e: e["url"].rlike("^https?://")))
        # The texts of reasons are fixed values, which reports are counted by.
        none = (name == "") & (sub == "") & (text(category) == "") & lines.isNull()
        rules: list[tuple[Column, Column | str]] = [
            (none, "L5|empty_item"), (~kind.isin(*taxonomy.CATEGORIES), F.concat(F.lit("L1|分类白名单外:"), kind)), (kind.isin(*self.skip_categories) if self.skip_categories else F.lit(False), F.concat(F.lit("L2|分类黑名单:"), kind)),
            *[(F.contains(sub, F.lit(w)), f"L3|子分类黑词:{w}") for w in self.sub_category_words], *[(name.rlike(p), f"L4|标题命中正则:{p}") for p in self.title_patterns], *[(F.contains(name, F.lit(w)), f"L4|标题黑词:{w}") for w in self.title_words],
            (name == "", "L5|空标题"), (F.lit(self.require_cjk) & ~T.has_cjk(name), "L5|无中文字符"), (F.coalesce(F.size(lines), F.lit(0)) <= 0, "L5|无有效线路"), (~playable, "L5|线路无有效地址"),
        ]
        out = F.lit(None).cast("string")
        for hit, why in reversed(rules):
            out = F.when(F.coalesce(hit, F.lit(False)), why).otherwise(out)
        return out


def is_old(threshold: Column, *dates: Column) -> Column:
    """Whether the first of some texts that is not empty names a day before the threshold (ISO), or else a year that ends
    before it; false where it names neither."""
    text = F.coalesce(*[F.nullif(d.cast("string"), F.lit("")) for d in dates], F.lit(""))
    day, year = F.regexp_extract(text, r"(\d{4}-\d{2}-\d{2})", 1), F.regexp_extract(text, r"\b((?:19|20)\d{2})\b", 1)
    return F.when(day != "", day < threshold).when(year != "", F.concat(year, F.lit("-12-31")) < threshold).otherwise(False)


def kept_lines(lines: Column, alive: Column) -> Column:
    """Lines whose first episode's domain is among the live ones (an array): one URL stands for its line."""
    return F.filter(lines, lambda l: F.array_contains(alive, T.domain(F.get(l["episodes"], F.lit(0))["url"])))


def verified(kind: Column, url: Column, alt_urls: Column, seasons: Column, alive) -> Column:
    """(alive, url, alt_urls) of an item. A video lives by its own URL or by the first live alternative, which takes its
    place; only live alternatives stay. A series lives if any season's first episode has a live URL. alive: of a URL."""
    live = lambda u: F.coalesce(u.rlike("^https?://"), F.lit(False)) & F.coalesce(alive(u), F.lit(False))
    alts = F.filter(alt_urls, lambda a: live(a["url"]))
    own, n = live(url), F.coalesce(F.size(alts), F.lit(0))
    video = F.struct((own | (n > 0)).alias("alive"), F.when(own, url).otherwise(F.coalesce(F.get(alts, F.lit(0))["url"], url)).alias("url"), F.when(own, alts).otherwise(F.slice(alts, F.lit(2), F.greatest(n, F.lit(1)))).alias("alt_urls"))
    first = lambda s: F.get(s["episodes"], F.lit(0))
    up = F.coalesce(F.exists(seasons, lambda s: live(first(s)["url"]) | F.coalesce(F.exists(first(s)["alt_urls"], lambda a: live(a["url"])), F.lit(False))), F.lit(False))
    return F.when(kind == "video", video).otherwise(F.struct(up.alias("alive"), url.alias("url"), alt_urls.alias("alt_urls")))
