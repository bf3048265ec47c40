"""The record contract: templates, type coercion with a change log, validation with a path in each message.

Records come as VARIANT, so wrong types are seen as they are; everything is built-in functions in one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The fields of an item, season and episode in order, with the values they have while nothing is known (fixed values).
ITEM = {
    "bangou": "", "type": "video", "title": "", "original_title": "", "cover": "", "backdrop": "", "overview": "", "region": "", "group_name": "", "year": "", "date": "", "site": "", "tags": "", "genres": [],
    "status": "completed", "rating": None, "rating_source": "", "vote_count": 0, "first_air_date": "", "runtime": 0, "original_language": "", "homepage": "", "certification": "", "country": "", "studio": "", "logo": "",
    "popularity": 0.0, "cast": [], "director": [], "url": "", "url_type": "", "alt_urls": [], "seasons": [], "number_of_seasons": 0, "number_of_episodes": 0,
}
ALT_URL = "struct<source:string,url:string,label:string,resolution:string,url_type:string>"
EPISODE_TYPE = f"struct<ep_id:string,ep_number:bigint,ep_title:string,air_date:string,duration:string,ep_overview:string,ep_rating:double,ep_rating_source:string,ep_still:string,url:string,url_type:string,alt_urls:array<{ALT_URL}>>"
SEASON_TYPE = f"struct<season_number:bigint,season_title:string,season_cover:string,season_overview:string,season_date:string,episodes:array<{EPISODE_TYPE}>>"
TYPES = {"genres": "array<string>", "cast": "array<string>", "director": "array<string>", "rating": "double", "alt_urls": f"array<{ALT_URL}>", "seasons": f"array<{SEASON_TYPE}>"}
#: Allowed values, and the fields that are required texts (fixed values).
KINDS, STATUSES = ("video", "series"), ("completed", "ongoing")
REGIONS = ("电影", "国产剧", "日韩剧", "欧美剧", "其他剧", "动漫", "综艺")
REQUIRED = ("title", "cover", "overview", "region", "group_name", "site")
INTEGERS = ("vote_count", "runtime", "number_of_seasons", "number_of_episodes", "confidence")
LEAST_CONFIDENCE = 55


def _type(name: str) -> str:
    d = ITEM.get(name)
    return TYPES.get(name) or ("bigint" if isinstance(d, int) else "double" if isinstance(d, float) else "string")


def blank_item(bangou: Column, title: Column, kind: Column) -> Column:
    """A record with every field, of the right type, and nothing known but these three."""
    own = {"bangou": bangou, "title": title, "type": F.when(kind.isin(*KINDS), kind).otherwise("video")}
    empty = lambda n: F.array() if isinstance(ITEM[n], list) else F.lit(ITEM[n])
    return F.struct(*[own.get(n, empty(n)).cast(_type(n)).alias(n) for n in ITEM])


def new_season(number: Column, title: Column | None = None, episodes: Column | None = None) -> Column:
    n = F.coalesce(number.try_cast("bigint"), F.lit(0))
    default = F.concat(F.lit("第 "), n.cast("string"), F.lit(" 季"))
    named = default if title is None else F.coalesce(F.nullif(title, F.lit("")), default)
    text = F.lit("")
    return F.struct(n.alias("season_number"), named.alias("season_title"), text.alias("season_cover"), text.alias("season_overview"), text.alias("season_date"), (F.array() if episodes is None else episodes).cast(f"array<{EPISODE_TYPE}>").alias("episodes"))


def new_episode(number: Column, url: Column, title: Column | None = None, url_type: Column | None = None, air_date: Column | None = None, alt_urls: Column | None = None) -> Column:
    n = F.coalesce(number.try_cast("bigint"), F.lit(0))
    default = F.concat(F.lit("第"), n.cast("string"), F.lit("集"))
    kind = F.when(F.contains(url, F.lit(".m3u8")), "m3u8").otherwise("")
    none = F.lit(None)
    return F.struct(
        F.lit("").alias("ep_id"), n.alias("ep_number"), (default if title is None else F.coalesce(F.nullif(title, F.lit("")), default)).alias("ep_title"), (none if air_date is None else air_date).alias("air_date"), none.alias("duration"),
        none.alias("ep_overview"), none.alias("ep_rating"), none.alias("ep_rating_source"), none.alias("ep_still"), url.alias("url"), (kind if url_type is None else F.coalesce(F.nullif(url_type, F.lit("")), kind)).alias("url_type"),
        (F.array() if alt_urls is None else alt_urls).alias("alt_urls"),
    ).cast(EPISODE_TYPE)


def _at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", "variant")


def _kind(v: Column) -> Column:
    """MISSING, VOID (null), BOOLEAN, BIGINT, DECIMAL(..), DOUBLE, STRING, ARRAY<..> or OBJECT<..>."""
    return F.coalesce(F.schema_of_variant(v), F.lit("MISSING"))


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _gone(v: Column) -> Column:
    return _kind(v).isin("MISSING", "VOID")


def _is_text(v: Column) -> Column:
    return (_kind(v) == "STRING") & (F.trim(F.coalesce(_text(v), F.lit(""))) != "")


def _is_number(v: Column) -> Column:
    return _kind(v).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")


def _items(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))


def _is_list(v: Column) -> Column:
    return _kind(v).startswith("ARRAY<")


def _texts_only(v: Column) -> Column:
    return _is_list(v) & F.forall(_items(v), lambda x: _kind(x) == "STRING")


def _messages(*checks: tuple[Column, Column | str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), m if isinstance(m, Column) else F.lit(m)) for bad, m in checks]))


def _each(v: Column, path: Column, check) -> Column:
    """The messages of every element of a list, with its place in the path."""
    return F.flatten(F.transform(_items(v), lambda x, i: check(x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))


def _say(path: Column, what: str) -> Column:
    return F.concat(path, F.lit(what))


def _alt_urls(v: Column, path: Column) -> Column:
    bad = _each(v, path, lambda x, p: _messages((~_kind(x).startswith("OBJECT<"), _say(p, ": not an object")), (_kind(x).startswith("OBJECT<") & ~_is_text(_at(x, "url")), _say(p, ".url: empty"))))
    return F.concat(_messages((~_gone(v) & ~_is_list(v), _say(path, ": not a list"))), bad)


def _episodes(v: Column, path: Column) -> Column:
    def one(x: Column, p: Column) -> Column:
        own = _messages((_kind(_at(x, "ep_number")) != "BIGINT", _say(p, ".ep_number: not an integer")), (~_is_text(_at(x, "url")), _say(p, ".url: empty")))
        return F.when(~_kind(x).startswith("OBJECT<"), F.array(_say(p, ": not an object"))).otherwise(F.concat(own, _alt_urls(_at(x, "alt_urls"), _say(p, ".alt_urls"))))

    return F.concat(_messages((~_is_list(v), _say(path, ": not a list"))), _each(v, path, one))


def _episode_warnings(v: Column, path: Column) -> Column:
    odd = lambda d: ~_gone(d) & ~((_kind(d) == "STRING") & F.coalesce(_text(d), F.lit("")).rlike(r"^(\d{4}-\d{2}-\d{2})?$"))
    return _each(v, path, lambda x, p: _messages((odd(_at(x, "air_date")), _say(p, ".air_date: not a date"))))


def _seasons(v: Column) -> Column:
    path = F.lit("seasons")
    numbers = F.transform(_items(v), lambda s: F.when(_kind(_at(s, "season_number")) == "BIGINT", F.try_variant_get(s, "$.season_number", "bigint")))

    def one(s: Column, p: Column, i: Column) -> Column:
        n = F.get(numbers, i)
        again = F.coalesce(F.array_contains(F.slice(numbers, 1, i), n), F.lit(False))
        own = _messages((n.isNull(), _say(p, ".season_number: not an integer")), (n.isNotNull() & again, _say(p, ".season_number: repeated")))
        eps = _at(s, "episodes")
        return F.when(~_kind(s).startswith("OBJECT<"), F.array(_say(p, ": not an object"))).otherwise(F.concat(own, F.when(_gone(eps), F.array().cast("array<string>")).otherwise(_episodes(eps, _say(p, ".episodes")))))

    each = F.flatten(F.transform(_items(v), lambda s, i: one(s, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), i)))
    return F.concat(_messages((~_is_list(v), "seasons: not a list")), each)


def _season_warnings(v: Column) -> Column:
    return _each(v, F.lit("seasons"), lambda s, p: F.concat(_messages((_kind(s).startswith("OBJECT<") & _gone(_at(s, "episodes")), _say(p, ".episodes: missing"))), _episode_warnings(_at(s, "episodes"), _say(p, ".episodes"))))


def gate_reason(v: Column) -> Column:
    """Why a record may not enter the product: no_cover, no_overview, all_sources_miss, low_confidence, or '' if it may.
    A missing confidence counts as just enough, one that is no number as 0."""
    confidence = _at(v, "confidence")
    value = F.when(_gone(confidence), LEAST_CONFIDENCE).otherwise(F.coalesce(F.try_variant_get(confidence, "$", "double").try_cast("int"), F.lit(0)))
    matched = _at(v, "matched")
    missed = F.when(_kind(matched) == "MISSING", _gone(confidence)).otherwise(F.coalesce(F.try_variant_get(matched, "$", "boolean"), F.lit(True)) == F.lit(False))
    return (
        F.when(~_kind(v).startswith("OBJECT<"), "not_in_whitelist").when(~_is_text(_at(v, "cover")), "no_cover").when(~_is_text(_at(v, "overview")), "no_overview")
        .when(missed, "all_sources_miss").when(value < LEAST_CONFIDENCE, "low_confidence").otherwise("")
    )


def validated(v: Column, require_gate: bool = False, strict: bool = False) -> Column:
    """(ok, errors, warnings) of a record; strict counts warnings as errors."""
    at = {n: _at(v, n) for n in {*ITEM, "poster"}}
    text = lambda n: F.coalesce(_text(at[n]), F.lit(""))
    year_ok = lambda c: F.trim(c).rlike(r"^(19|20)\d{2}$")
    has_year, by_date = _is_text(at["year"]), _is_text(at["date"]) & year_ok(F.substring(F.trim(text("date")), 1, 4))
    rating = F.try_variant_get(at["rating"], "$", "double")
    series, seasons = text("type") == "series", at["seasons"]
    no_seasons = _gone(seasons) | (_is_list(seasons) & (F.size(_items(seasons)) == 0))
    number = lambda n: F.try_variant_get(at[n], "$", "bigint")
    errors = F.concat(
        _messages(
            (_kind(at["poster"]) != "MISSING", "poster: not allowed"), (~_is_text(at["bangou"]), "bangou: empty"), (~text("type").isin(*KINDS), "type: unknown"),
            *[(~_is_text(at[n]), f"{n}: empty") for n in REQUIRED],
            (has_year & ~year_ok(text("year")), "year: not a year"), (~has_year & ~by_date, "year: missing"),
            (~_gone(at["tags"]) & (_kind(at["tags"]) != "STRING") & ~_texts_only(at["tags"]), "tags: not text"), (~_gone(at["genres"]) & ~_texts_only(at["genres"]), "genres: not texts"),
            (~text("status").isin(*STATUSES), "status: unknown"), (~_gone(at["rating"]) & ~_is_number(at["rating"]), "rating: not a number"),
            *[(~_gone(at[n]) & (_kind(at[n]) != "BIGINT"), f"{n}: not an integer") for n in ("vote_count", "runtime")],
            *[((_kind(at[n]) == "BIGINT") & (number(n) < 0), f"{n}: negative") for n in ("vote_count", "runtime")],
            *[(~_gone(at[n]) & (_kind(at[n]) != "STRING"), f"{n}: not text") for n in ("rating_source", "first_air_date")],
            ((text("type") == "video") & ~_is_text(at["url"]), "url: empty"), (series & no_seasons, "seasons: empty"),
            *[(series & ~_gone(at[n]) & (_kind(at[n]) != "BIGINT"), f"{n}: not an integer") for n in ("number_of_seasons", "number_of_episodes")],
        ),
        F.when(series & ~no_seasons, _seasons(seasons)).otherwise(F.array().cast("array<string>")), _alt_urls(at["alt_urls"], F.lit("alt_urls")),
        F.when(F.lit(require_gate) & (gate_reason(v) != ""), F.array(F.concat(F.lit("gate: "), gate_reason(v)))).otherwise(F.array().cast("array<string>")),
    )
    warnings = F.concat(
        _messages(
            (~has_year & by_date, "year: taken from date"), (_gone(at["tags"]), "tags: missing"), (_gone(at["genres"]), "genres: missing"),
            (_is_number(at["rating"]) & (rating == 0), "rating: zero"), (_is_number(at["rating"]) & (rating != 0) & ~rating.between(0, 10), "rating: out of range"),
            (_is_text(at["region"]) & ~text("region").isin(*REGIONS), "region: unusual"),
        ),
        F.when(series & _is_list(seasons), _season_warnings(seasons)).otherwise(F.array().cast("array<string>")),
    )
    is_object = _kind(v).startswith("OBJECT<")
    errors = F.when(is_object, errors).otherwise(F.array(F.lit("record: not an object")))
    warnings = F.when(is_object, warnings).otherwise(F.array().cast("array<string>"))
    if strict:
        errors, warnings = F.concat(errors, warnings), F.array().cast("array<string>")
    return F.struct((F.size(errors) == 0).alias("ok"), errors.alias("errors"), warnings.alias("warnings"))


def summary(records, v: Column, **options):
    """total, ok and failed of a frame of records, in one aggregate."""
    ok = validated(v, **options)["ok"]
    return records.select(ok.alias("ok")).agg(F.count("*").alias("total"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed"))


def _integer(v: Column) -> tuple[Column, Column]:
    """A value as an integer (digits in texts and fractions are cut, the rest is 0), and what was done, if anything."""
    kind, text = _kind(v), F.coalesce(_text(v), F.lit(""))
    empty, cut = kind.isin("VOID") | ((kind == "STRING") & (text == "")), F.trim(text).try_cast("double").try_cast("bigint")
    value = F.when(kind == "BIGINT", F.try_variant_get(v, "$", "bigint")).when(empty, 0).otherwise(F.coalesce(cut, F.lit(0)))
    change = F.when(kind.isin("BIGINT", "MISSING"), None).when(empty, "empty to 0").when(cut.isNotNull(), "to integer").otherwise("not a number, to 0")
    return F.coalesce(value, F.lit(0)), change


def coerced(v: Column) -> Column:
    """(item, changes): the record with every field of the contract in its type, and a line for each repair."""
    fields, changes = [], []
    for n, default in ITEM.items():
        x = _at(v, n)
        if isinstance(default, list):
            fields.append(F.coalesce(F.try_variant_get(v, f"$.{n}", _type(n)), F.array().cast(_type(n))).alias(n) if n != "seasons" else _coerced_seasons(x).alias(n))
        elif n == "rating":
            value = F.when(_is_number(x), F.try_variant_get(x, "$", "double")).otherwise(F.trim(F.coalesce(_text(x), F.lit(""))).try_cast("double"))
            fields.append(value.alias(n))
            changes.append((~_gone(x) & ~_is_number(x), F.when(value.isNull(), "rating: not a number, to null").otherwise("rating: to number")))
        elif n == "popularity":
            fields.append(F.coalesce(F.try_variant_get(x, "$", "double"), F.lit(0.0)).alias(n))
        elif isinstance(default, int):
            value, change = _integer(x)
            fields.append(value.cast("bigint").alias(n))
            changes.append((change.isNotNull(), F.concat(F.lit(f"{n}: "), change)))
        else:
            value = F.when(_kind(x) == "MISSING", default).otherwise(F.coalesce(_text(x), F.lit("")))
            if n == "cover":  # the old name of the field
                poster = _at(v, "poster")
                moved = ~_is_text(x) & _is_text(poster)
                value = F.when(moved, _text(poster)).otherwise(value)
                changes.insert(0, (_kind(poster) != "MISSING", F.when(moved, "poster: to cover").otherwise("poster: removed")))
            fields.append(value.alias(n))
            changes.append((~_kind(x).isin("MISSING", "STRING"), f"{n}: to text"))
    nested = _each(_at(v, "seasons"), F.lit("seasons"), _season_changes)
    return F.struct(F.struct(*fields).alias("item"), F.concat(_messages(*changes), nested).alias("changes"))


def _season_changes(s: Column, p: Column) -> Column:
    def one(x: Column, path: Column, name: str) -> Column:
        change = F.when(_kind(_at(x, name)) == "MISSING", "not a number, to 0").otherwise(_integer(_at(x, name))[1])
        return _messages((_kind(x).startswith("OBJECT<") & change.isNotNull(), F.concat(path, F.lit(f".{name}: "), change)))

    return F.concat(one(s, p, "season_number"), _each(_at(s, "episodes"), _say(p, ".episodes"), lambda e, q: one(e, q, "ep_number")))


def _coerced_seasons(v: Column) -> Column:
    def episode(e: Column) -> Column:
        typed = F.try_variant_get(e, "$", EPISODE_TYPE.replace("ep_number:bigint", "ep_number:string"))
        return F.struct(*[(_integer(_at(e, "ep_number"))[0] if n == "ep_number" else typed[n]).alias(n) for n in [f.split(":")[0] for f in _names(EPISODE_TYPE)]]).cast(EPISODE_TYPE)

    def season(s: Column) -> Column:
        text = lambda n: F.coalesce(_text(_at(s, n)), F.lit("")).alias(n)
        return F.struct(_integer(_at(s, "season_number"))[0].cast("bigint").alias("season_number"), *[text(n) for n in ("season_title", "season_cover", "season_overview", "season_date")], F.transform(_items(_at(s, "episodes")), episode).alias("episodes"))

    return F.transform(_items(v), season).cast(TYPES["seasons"])


def _names(struct: str) -> list[str]:
    """The top-level fields of a struct's type text."""
    out, depth, start = [], 0, 7
    for i, c in enumerate(struct[7:-1], 7):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(struct[start:i])
            start = i + 1
    return [*out, struct[start:-1]]
