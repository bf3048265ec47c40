"""Native text, URL and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd"]


def present(c: Column | str) -> Column:
    """The trimmed text, null where it is empty: the engine's notion of a missing text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.trim(c), F.lit(""))


def first_present(*cols: Column | str) -> Column:
    return F.coalesce(*[present(c) for c in cols])


def domain(url: Column, port: bool = True) -> Column:
    """Lower-case authority of a URL, with or without its port; '' where there is none."""
    stop = "/?#" if port else "/:?#"
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), f"^[A-Za-z][A-Za-z0-9+.-]*://([^{stop}]+)", 1))


def url_key(url: Column) -> Column:
    """A URL without scheme and trailing slashes, for deduplication."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://", ""), "/+$", "")


def probeable(url: Column) -> Column:
    """http(s), with a host, and a port that is absent or a positive number."""
    d = domain(url)
    return F.coalesce(url.rlike("^(?i)https?://"), F.lit(False)) & d.rlike("^[^:]+(:0*[1-9][0-9]{0,4})?$")


def url_type(url: Column) -> Column:
    u = F.lower(F.coalesce(url, F.lit("")))
    return F.when(F.contains(u, F.lit(".m3u8")), "m3u8").when(F.contains(u, F.lit(".mp4")), "mp4").otherwise("m3u8")


def parse_time(c: Column) -> Column:
    """Several text formats, or epoch seconds or milliseconds; null where none fits."""
    n = F.try_to_number(c, F.lit("9999999999999")).cast("long")
    number = F.when(c.rlike("^[0-9]{13}$"), F.timestamp_millis(n)).when(c.rlike("^[0-9]{9,10}$"), F.timestamp_seconds(n))
    iso = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"), c.try_cast("timestamp"))
    return F.coalesce(number, *[F.try_to_timestamp(c, F.lit(f)) for f in TIME_FORMATS], iso)


def epoch_of(c: Column) -> Column:
    """A time as epoch seconds: text in several formats, or a number above 10,000,000; 0 where neither fits."""
    text = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    formats = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd"]
    times = [F.unix_timestamp(F.try_to_timestamp(F.left(text, F.lit(19)), F.lit(f))) for f in formats]
    number = text.try_cast("double").try_cast("bigint")
    return F.coalesce(*times, F.when(number > 10_000_000, number), F.lit(0)).cast("long")


def epoch_seconds(ts: Column) -> Column:
    """A timestamp as whole epoch seconds, to the nearest and at halves to the even one, as a cast rounds in SQL."""
    return F.rint(F.unix_micros(ts.cast("timestamp")) / 1_000_000).cast("long")


def year_of(title: Column) -> Column:
    return F.nullif(F.regexp_extract(title, "(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])", 1), F.lit(""))


def has_cjk(c: Column) -> Column:
    return F.coalesce(c.rlike("[一-鿿]"), F.lit(False))


def html_plain(c: Column) -> Column:
    """Tags to spaces, the five common references decoded, white space collapsed."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]*>", " ")
    for ref, to in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        t = F.replace(t, F.lit(ref), F.lit(to))
    return F.trim(F.regexp_replace(t, "[ \\t\\n\\r]+", " "))


def play_lines(urls: Column, names: Column) -> Column:
    """'$$$' parts lines, '#' episodes, '$' name and URL: an array of (line, episodes of (name, url)), http(s) only."""
    groups, labels = F.split(F.coalesce(urls, F.lit("")), "[$]{3}"), F.split(F.coalesce(names, F.lit("")), "[$]{3}")

    def episode(e: Column, i: Column) -> Column:
        cut = F.locate("$", e)
        name = F.when(cut > 0, F.substring(e, F.lit(1), cut - 1)).otherwise(F.lit(""))
        url = F.when(cut > 0, F.substring(e, cut + 1, F.length(e))).otherwise(e)
        label = F.format_string("第%02d集", i + 1)
        return F.struct(F.coalesce(present(name), label).alias("name"), F.trim(url).alias("url"))

    def line(g: Column, i: Column) -> Column:
        eps = F.filter(F.transform(F.split(g, "#"), episode), lambda e: e["url"].rlike("^(?i)https?://"))
        return F.struct(F.coalesce(present(F.get(labels, i)), F.concat(F.lit("line"), (i + 1).cast("string"))).alias("line_name"), eps.alias("episodes"))

    return F.filter(F.transform(groups, line), lambda x: F.size(x["episodes"]) > 0)
