"""Categories, regions and genres: rule tables, which settings may overlay, and native expressions that apply them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

CATEGORIES = ("movies", "tv", "anime", "variety")
#: Category names and their aliases (fixed values).
ALIASES = {
    "movies": "movies movie 电影 电影片 院线 片 film",
    "tv": "tv tvseries teleplay 电视剧 剧集 国产剧 港剧 台剧 日韩剧 美剧 海外剧 泰剧 网剧 短剧 short_tv shorttv 微短剧 竖屏短剧 series",
    "anime": "anime 动漫 动画 动画片 番剧 国漫 animation cartoon",
    "variety": "variety 综艺 综艺节目 真人秀 脱口秀 talkshow talk_show reality 晚会 音乐节目",
}
#: Words in a sub-category that tell its category, in order of trial (fixed values).
CATEGORY_WORDS = {
    "variety": "综艺 真人秀 脱口秀 访谈 晚会 音乐节目 选秀 搞笑",
    "anime": "动漫 动画 卡通 番剧 国漫 二次元",
    "movies": "电影 院线 大片 动作片 喜剧片 爱情片 科幻片 恐怖片 剧情片 战争片 悬疑片 惊悚片 犯罪片 片",
    "tv": "电视剧 国产剧 港剧 台剧 日剧 韩剧 美剧 泰剧 网剧 短剧 剧集 连续剧 海外剧",
}
#: Countries by region, names of several words in a list of their own (fixed values).
COUNTRIES = {
    "国产剧": ("cn 中国大陆 大陆 中国 china prc 中华人民共和国 hk 中国香港 香港 tw 中国台湾 台湾 taiwan", ["mainland china", "hong kong"]),
    "日韩剧": ("kr 韩国 korea jp 日本 japan", ["south korea"]),
    "海外剧": ("th 泰国 thailand vn 越南 vietnam my 马来西亚 malaysia sg 新加坡 singapore id 印度尼西亚 印尼 indonesia ph 菲律宾 philippines kh 柬埔寨 mm 缅甸 in 印度 india pk 巴基斯坦 lk 斯里兰卡 np 尼泊尔 mn 蒙古 tr 土耳其 turkey turkiye", []),
    "美剧": (
        "us 美国 usa gb uk 英国 fr 法国 france de 德国 germany it 意大利 italy es 西班牙 spain ca 加拿大 canada au 澳大利亚 australia ru 俄罗斯 russia nl 荷兰 be 比利时 se 瑞典 no 挪威 dk 丹麦 fi 芬兰 pl 波兰 "
        "cz 捷克 at 奥地利 ch 瑞士 ie 爱尔兰 nz 新西兰 br 巴西 mx 墨西哥 ar 阿根廷 za 南非", ["united states", "united kingdom"]),
}
#: Languages by region (fixed values).
LANGUAGES = {
    "国产剧": "zh cn 普通话 汉语 国语 粤语 闽南语 中文 汉语普通话",
    "日韩剧": "ko ja 韩语 日语",
    "海外剧": "th vi id ms si ta hi bn tl km my ne tr 泰语 越南语 印尼语 马来语 印地语 土耳其语 泰卢固语 泰米尔语",
    "美剧": "en fr de es it ru pt sv no da fi nl pl cs el 英语 法语 德语 西班牙语 意大利语 俄语 葡萄牙语 瑞典语 荷兰语 波兰语 丹麦语 挪威语",
}
#: Words in a sub-category that tell its region, in order of trial (fixed values).
REGION_WORDS = {"日韩剧": "韩 日 日本 日剧", "美剧": "美 欧美 欧 英 西方", "海外剧": "泰 马泰 海外 马 新 越 印 印尼 俄", "国产剧": "内地 国产 大陆 港台 香港 台湾 港剧 台剧"}
REGION_DEFAULT = {"movies": "电影", "tv": "其他剧", "anime": "动漫", "variety": "综艺"}
LEGACY_REGIONS = {"港台剧": "国产剧", "内地剧": "国产剧", "国产": "国产剧"}
#: Genre words by the genre they mean, and the genres there are (fixed values).
SYNONYMS = {
    "动作": "动作片 action", "喜剧": "喜剧片 comedy", "爱情": "爱情片 romance", "科幻": "科幻片 sci-fi", "恐怖": "恐怖片 horror", "剧情": "剧情片 故事片 drama", "战争": "战争片 war", "悬疑": "悬疑片 mystery",
    "惊悚": "惊悚片 thriller", "犯罪": "犯罪片 crime", "奇幻": "奇幻片 fantasy", "灾难": "灾难片", "冒险": "冒险片 动作冒险 adventure", "纪录": "纪录片 纪录 documentary", "动画": "动画片 animation", "古装": "古装剧",
    "武侠": "武侠剧", "偶像": "偶像剧", "都市": "都市剧 肥皂剧", "家庭": "家庭剧 儿童 family", "历史": "历史剧 history", "军事": "军旅剧", "谍战": "谍战剧", "刑侦": "刑侦剧", "仙侠": "仙侠剧", "权谋": "权谋剧",
    "真人秀": "现实 Reality reality-tv", "脱口秀": "Talk talk-show", "音乐": "music", "歌舞": "musical", "传记": "biography", "运动": "sport sports", "西部": "western", "新闻": "news", "游戏": "game-show", "短片": "short",
}
GENRES = "剧情 喜剧 动作 爱情 科幻 动画 悬疑 惊悚 恐怖 犯罪 冒险 历史 战争 奇幻 音乐 歌舞 家庭 灾难 西部 传记 运动 纪录 古装 武侠 偶像 都市 军事 谍战 刑侦 仙侠 权谋 真人秀 脱口秀 游戏 新闻 短片".split()
#: Words of regions: never part of a genre (fixed values).
REGION_MARKS = "内地 国产 港 台 泰 韩 日 美 欧 海外 大陆".split()
REGION_PREFIX = "^(内地|国产|大陆|港台|香港|台湾|港|台|泰国|韩|日|美|欧美|海外|马泰|马|新|越|印)+"
GENRE_SUFFIX = "(片|剧|大全|推荐|热门)+$"
UNSORTED = "未分类"


def _inverted(table: Mapping) -> dict[str, str]:
    return {w: k for k, v in table.items() for w in (v.split() if isinstance(v, str) else [*v[0].split(), *v[1]])}


@dataclass(frozen=True)
class Rules:
    """The rule tables in force."""

    countries: dict[str, str] = field(default_factory=lambda: _inverted(COUNTRIES))
    languages: dict[str, str] = field(default_factory=lambda: _inverted(LANGUAGES))
    region_words: dict[str, list[str]] = field(default_factory=lambda: {k: v.split() for k, v in REGION_WORDS.items()})
    synonyms: dict[str, str] = field(default_factory=lambda: _inverted(SYNONYMS))
    genres: tuple[str, ...] = tuple(GENRES)

    def overlaid(self, settings: Mapping) -> Rules:
        """The same with what settings add: words by word, region words by region, a list of genres as a whole."""
        region, genre = settings.get("REGION_RULES") or {}, settings.get("GENRE_RULES") or {}
        return replace(
            self, countries=self.countries | dict(region.get("country_map") or {}), languages=self.languages | dict(region.get("language_map") or {}),
            region_words=self.region_words | {k: list(v) for k, v in (region.get("sub_region_words") or {}).items()},
            synonyms=self.synonyms | dict(genre.get("synonyms") or {}), genres=tuple(genre.get("canonical") or self.genres),
        )


def _looked_up(word: Column, table: Mapping[str, str]) -> Column:
    """The entry of a word, as it is or in lower case; null if there is none. The table is part of the plan, of a fixed size."""
    m = F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv])
    return F.coalesce(F.element_at(m, word), F.element_at(m, F.lower(word)))


def _first(words: Column, value) -> Column:
    """The first value that is not null among those of words."""
    return F.get(F.filter(F.transform(words, value), lambda x: x.isNotNull()), 0)


def _tokens(c: Column, gap: str) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), gap), lambda t: t != "")


def _contains_any(text: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def category_from_words(sub_category: Column) -> Column:
    """The category whose words a sub-category contains, else ''."""
    text = F.coalesce(sub_category, F.lit(""))
    out = F.lit("")
    for category, words in reversed(CATEGORY_WORDS.items()):
        out = F.when(_contains_any(text, words.split()), category).otherwise(out)
    return out


def normalize_category(raw: Column, sub_category: Column | None = None, authority: Column | None = None) -> Column:
    """One of CATEGORIES: an authority's word, else a known alias, else by words of the sub-category, else tv."""
    raw = F.coalesce(raw, F.lit(""))
    key = F.regexp_replace(F.lower(F.trim(raw)), r"[\s_\-/.·、,，|]+", "")
    text = raw if sub_category is None else F.coalesce(F.nullif(sub_category, F.lit("")), raw)
    known = F.when(authority.isin(*CATEGORIES), authority) if authority is not None else F.lit(None).cast("string")
    return F.coalesce(known, F.element_at(F.create_map(*[F.lit(x) for kv in sorted(_inverted(ALIASES).items()) for x in kv]), key), F.nullif(category_from_words(text), F.lit("")), F.lit("tv"))


def listed_category(raw: Column, whitelist: Mapping[str, str], discard: tuple[str, ...] = ()) -> Column:
    """Another categoriser: the category of the first listed word that a raw name contains; null (drop) where a word to
    discard occurs or nothing is listed."""
    text, out = F.coalesce(raw, F.lit("")), F.lit(None).cast("string")
    for word, category in sorted(whitelist.items(), key=lambda kv: (len(kv[0]), kv[0])):
        out = F.when(F.contains(text, F.lit(word)), category).otherwise(out)
    return F.when(_contains_any(text, discard), None).otherwise(out)


def authoritative_category(provider: Column, signal: Column, genres: Column) -> Column:
    """(category, reason) by a provider's own data: signal is its end point, kind or type. Category null: not of the four,
    drop; '': no authority, keep the entry's own."""
    blob = F.array_join(F.coalesce(genres, F.array().cast("array<string>")), " ")
    signal = F.coalesce(signal, F.lit(""))
    documentary = F.contains(blob, F.lit("纪录")) | F.contains(F.lower(blob), F.lit("documentary"))
    drawn = _contains_any(blob, ["动画", "Animation", "Comedy Animation"])
    say = lambda c, why: F.struct((F.lit(None).cast("string") if c is None else F.lit(c)).alias("category"), F.lit(why).alias("reason"))
    series = F.when(documentary, say(None, "documentary")).when(drawn, say("anime", "genres")).when(_contains_any(blob, ["真人秀", "脱口秀", "Reality", "Talk"]), say("variety", "genres")).otherwise(say("tv", "series"))
    none = say("", "no signal")
    film = F.when(documentary, say(None, "documentary")).otherwise(say("movies", "film"))
    return (
        F.when(provider == "TMDB", F.when(signal == "", none).when(signal == "movie", film).otherwise(series))
        .when(provider == "豆瓣", F.when(signal == "", none).when(documentary, say(None, "documentary")).when(signal == "tv", series).otherwise(say("movies", "film")))
        .when(provider == "OMDb", F.when(signal == "", none).when(documentary, say(None, "documentary")).when(signal == "series", series)
              .when(signal == "movie", F.when(drawn, say("anime", "genres")).otherwise(say("movies", "film"))).otherwise(say(None, "type")))
        .when(provider == "Bilibili", say("anime", "provider")).when(provider == "TheTVDB", series).otherwise(say("", "no authority"))
    )


def region_of(text: Column, table: Mapping[str, str]) -> Column:
    """The region of the first of several country or language names that has one, else ''."""
    return F.coalesce(_first(_tokens(text, r"[,，/、;；\s]+"), lambda t: _looked_up(t, table)), F.lit(""))


def resolve_region(category: Column, matched: Column, country: Column, language: Column, sub_category: Column, rules: Rules | None = None) -> Column:
    """A fixed region for all categories but tv; for tv by country, then language (of matched items), then words of the
    sub-category, else 其他剧."""
    rules = rules or Rules()
    text, by_words = F.coalesce(sub_category, F.lit("")), F.lit(REGION_DEFAULT["tv"])
    for region, words in reversed(rules.region_words.items()):
        by_words = F.when(_contains_any(text, words), region).otherwise(by_words)
    named = F.coalesce(F.nullif(region_of(country, rules.countries), F.lit("")), F.nullif(region_of(language, rules.languages), F.lit("")))
    fixed = F.when(category == "anime", REGION_DEFAULT["anime"]).when(category == "variety", REGION_DEFAULT["variety"]).otherwise(REGION_DEFAULT["movies"])
    return F.when(F.trim(F.coalesce(category, F.lit(""))) != "tv", fixed).otherwise(F.coalesce(F.when(F.coalesce(matched, F.lit(False)), named), by_words))


def normalize_genre(word: Column, rules: Rules | None = None) -> Column:
    """The genre a word means; '' for words of regions and unknown ones."""
    rules = rules or Rules()
    w = F.trim(F.coalesce(word, F.lit("")))
    mapped = F.coalesce(_looked_up(w, rules.synonyms), w)
    return F.when(~_contains_any(w, REGION_MARKS) & mapped.isin(*rules.genres), mapped).otherwise("")


def resolve_group(matched: Column, genres: Column, sub_category: Column, rules: Rules | None = None) -> Column:
    """The main genre: the first known one of a matched item, else that of the sub-category's words, with the region before
    them and the ending taken off, else 未分类."""
    rules = rules or Rules()
    genre = lambda w: F.nullif(normalize_genre(w, rules), F.lit(""))
    bare = lambda t: F.trim(F.regexp_replace(F.regexp_replace(t, REGION_PREFIX, ""), GENRE_SUFFIX, ""))
    by_genres = _first(F.coalesce(genres, F.array().cast("array<string>")), genre)
    by_words = _first(_tokens(sub_category, r"[\s/、,，|]+"), lambda t: F.coalesce(genre(t), genre(bare(t))))
    return F.coalesce(F.when(F.coalesce(matched, F.lit(False)), by_genres), by_words, F.lit(UNSORTED))


def current_region(region: Column) -> Column:
    """Regions of older products under their present names."""
    r = F.trim(F.coalesce(region, F.lit("")))
    return F.coalesce(_looked_up(r, LEGACY_REGIONS), r)


def conflicts(df, title: str, entry: str, corrected: str, reason: str, most: int = 500):
    """A report of at most `most` rows whose category an authority corrected."""
    wrong = df.where((F.col(corrected) != "") & (F.col(corrected) != F.col(entry)))
    return wrong.orderBy(title, entry).select(F.col(title).alias("title"), F.col(entry).alias("entry_category"), F.col(corrected).alias("corrected_category"), F.col(reason).alias("reason")).limit(most)
