"""HTML main text by consensus host paths.

Pass 1 parses every page, scores its containers (own block text less link text, by tag) and emits, per host, the
generalised tag-class path of the best one. Votes are summed per (host, path) by Spark, pre-aggregated per batch of
pages, so a host with a third of all pages is a few numbers. The path with most votes wins (ties: the smaller text).
Pass 2 parses every page again and takes the text of the elements at its host's winning path; a page without such an
element falls back to its own best container (of articles: all with that path), then to its whole body.

Left out everywhere: navigation, headers (but not the heading of an article's own header), footers, asides, form controls,
forms that hold little of the page's text, scripts, styles, hidden elements, and elements one of whose class or id names
is that of an advert, menu, sidebar, notice, comment section and the like (`sidebar` or `site-footer`, but not
`with-sidebar` or `no-comments`). Character references are decoded, white space in a block becomes one space, blocks are
joined by a line feed.

Null and empty pages give the empty text. Repeated rows are separate; a null or odd URL counts as the host ''; a null
page_id stays null. Very long, deeply nested or cut-off pages take time in proportion to their length. Extra columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

NAME = re.compile(r"[A-Za-z][^\s/>]*+")
#: Possessive throughout: what is matched is never given back, so a tag that is cut off costs its length once.
ATTRIBUTES = re.compile(r"""(?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+)*+""")
ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?+""")
READ = ("class", "id", "role", "hidden", "style")
SPACE = re.compile(r"\s+")
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
RAW_END = {t: re.compile(rf"</{t}\b[^>]*+>?", re.I) for t in RAW}
HEAD = {"title", "meta", "link", "style", "script", "base", "noscript", "template"}
DROP = RAW | {"nav", "footer", "aside", "button", "select", "option", "optgroup", "datalist", "svg", "canvas", "object", "embed", "audio", "video", "dialog", "menu", "head", "input", "label", "legend"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "html", "hr", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "footer", "nav", "aside", "form"}
CONTAINER = {"article": 1.5, "main": 1.3, "section": 1.0, "div": 1.0, "td": 0.8, "body": 0.5}
#: An open element of these ends when one of the given tags starts inside it.
CLOSES = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
CLOSED_BY = {tag: [t for t, some in CLOSES.items() if tag in some] for tag in BLOCK | {"li", "dt", "dd", "tr", "td", "th", "option"}}
#: What an implied end, and a stray end tag, don't reach beyond.
WALLS = {"article", "main", "section", "div", "body", "table", "ul", "ol", "dl", "nav", "footer", "aside", "header", "blockquote", "form"}
STRAY_WALLS = {"article", "main", "section", "div", "td", "nav", "footer", "aside", "header"}
REACH = {"body", "html", "article", "main", "div", "section", "table"}
#: Class and id names of what is no article, fixed values; a name may have other words around it, but none of PLAIN.
BOILERPLATE = set(
    "ad ads advert adverts advertisement advertisements adsense sponsor sponsored promo promos promotion promotions banner banners menu menus nav navbar navigation breadcrumb breadcrumbs "
    "sidebar sidebars footer footers header headers masthead comment comments disqus replies respond cookie cookies consent gdpr notice notices popup popups modal newsletter subscribe "
    "subscription signup share sharing social related recommended widget widgets pagination pager toolbar login search".split()
)
PLAIN = set("with without no not has have is in hide hides show shows open opened closed on off active inactive enabled disabled allow allows".split())
ARTICLE = set("article post entry story content hentry main text body".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
LONGEST_PATH = 1000


@dataclass(slots=True)
class Node:
    tag: str
    path: str
    dropped: bool
    start: int = 0  # of a container or form: its first block
    container: bool = False
    content: bool = False  # inside an article, by its tag or names


@dataclass(slots=True)
class Page:
    blocks: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters of each block inside links
    paragraph: list[bool] = field(default_factory=list)
    containers: list[tuple[str, str, int, int]] = field(default_factory=list)  # tag, path, first block, end
    sums: list[float] = field(default_factory=list)  # of the text before each block


def generalised(tag: str, names: str) -> str:
    """A step of a path: the tag with its classes, numbers taken out."""
    classes = sorted({re.sub(r"\d+", "", c) for c in names.split()} - {"", "-", "_"})
    return ".".join([tag, *classes])


def is_boilerplate(names: str) -> bool:
    """Whether one of some class or id names is that of something other than an article."""
    for name in names.split():
        words = [w.lower() for w in WORDS.findall(name)]
        if words and not PLAIN.intersection(words) and (words[0] in BOILERPLATE or words[-1] in BOILERPLATE or "".join(words) in BOILERPLATE):
            return True
    return False


def attributes(source: str, pos: int) -> tuple[dict[str, str], int, bool]:
    """The attributes of READ from pos on, where the tag ends, and whether it closes itself."""
    size, begin = len(source), pos
    while True:
        pos = ATTRIBUTES.match(source, pos).end()
        if pos >= size or source[pos] == ">":
            break
        # A stray = or a quotation mark that is never closed: the tag goes on to the next end of a tag.
        stop = source.find(">", pos) if source[pos] != "=" or source[pos + 1 : pos + 2] in ('"', "'") else pos + 1
        pos = size if stop < 0 else stop
    found: dict[str, str] = {}
    if pos > begin:
        region = source[begin:pos]
        if any(x in region for x in READ) or not region.islower() and any(x in region.lower() for x in READ):
            for k, v in ATTRIBUTE.findall(region):
                k = k.lower()
                if (k in READ or k == "aria-hidden") and k not in found:
                    found[k] = v.strip("\"'")
    return found, min(pos + 1, size), source[pos - 1 : pos] == "/"


def parse(source: str | None) -> Page:
    source = source or ""
    page = Page()
    stack: list[Node] = [Node("", "", False)]
    opened: Counter = Counter()
    forms: list[tuple[int, int, bool]] = []  # first block, end, whether an article is inside
    text: list[str] = []
    link = links = articles = 0

    def flush() -> None:
        nonlocal link
        if text:
            s = SPACE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if s:
                page.blocks.append(s)
                page.linked.append(min(link, len(s)))
                page.paragraph.append(any(n.tag in ("p", "pre", "blockquote") for n in stack[-3:]))
        link = 0

    def close(to: int) -> None:
        """Close all elements above stack position `to`."""
        nonlocal links
        for n in stack[to:]:
            if n.tag in BLOCK or n.container:
                flush()
                break
        while len(stack) > to:
            n = stack.pop()
            opened[n.tag] -= 1
            if n.container:
                page.containers.append((n.tag, n.path, n.start, len(page.blocks)))
            elif n.tag == "form" and not n.dropped:
                forms.append((n.start, len(page.blocks), n.content))
            if n.tag == "a":
                links -= 1

    pos, size = 0, len(source)
    while pos < size:
        at = source.find("<", pos)
        end = at if at >= 0 else size
        if end > pos and not stack[-1].dropped:
            text.append(source[pos:end])
            if links:
                link += end - pos
        if at < 0:
            break
        if source.startswith("<!--", at):
            stop = source.find("-->", at + 4)
            pos = size if stop < 0 else stop + 3
            continue
        if source.startswith("<![CDATA[", at) and (stop := source.find("]]>", at)) >= 0:
            pos = stop + 3
            continue
        ending = source.startswith("</", at)
        name = NAME.match(source, at + 1 + ending)
        if name is None:
            if source[at + 1 : at + 2] in ("!", "?", "/") and source[at + 1 : at + 2]:
                stop = source.find(">", at)
                pos = size if stop < 0 else stop + 1
            else:  # no tag: a lone < is text
                if not stack[-1].dropped:
                    text.append("<")
                pos = at + 1
            continue
        tag, pos = name.group().lower(), name.end()
        if ending:
            stop = source.find(">", pos)
            pos = size if stop < 0 else stop + 1
            if tag == "br":
                text.append(" ")
            if not opened[tag]:
                if tag == "p":
                    flush()
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag not in REACH and stack[i].tag in STRAY_WALLS:
                    break  # a stray end tag doesn't close what encloses it
            continue
        if source[pos : pos + 1] == ">":
            found, itself, pos = {}, False, pos + 1
        else:
            found, pos, itself = attributes(source, pos)
        if opened["head"] and tag not in HEAD:
            close(next(i for i, n in enumerate(stack) if n.tag == "head"))
        if tag == "br":
            if not stack[-1].dropped:
                text.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if tag in CLOSED_BY and any(opened[t] for t in CLOSED_BY[tag]):
            for i in range(len(stack) - 1, 0, -1):
                t = stack[i].tag
                if t in CLOSES and tag in CLOSES[t]:
                    close(i)
                    break
                if t in WALLS:
                    break
        if tag in VOID:
            continue
        if tag in RAW:
            stop = RAW_END[tag].search(source, pos)
            pos = stop.end() if stop else size
            continue
        if itself and tag in ("svg", "path"):
            continue
        names = f"{found.get('class', '')} {found.get('id', '')}"
        up = stack[-1]
        bad = tag in DROP or tag == "header" or found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I) is not None
        bad = bad or (tag not in ("html", "body", "article", "main", "h1") and names != " " and is_boilerplate(names))
        # The heading of an article's own header.
        heading = tag in ("h1", "h2") and up.dropped and up.content and opened["header"] > 0 and not (opened["nav"] or opened["aside"] or opened["footer"])
        n = Node(tag, up.path, (bad or up.dropped) and not heading, len(page.blocks), content=up.content)
        if tag in ("article", "main") or tag in ("div", "section") and any(ARTICLE.intersection(w.lower() for w in WORDS.findall(x)) for x in names.split()):
            n.content = True
            if not n.dropped:
                for f in stack:
                    if f.tag == "form":
                        f.content = True
        if tag in CONTAINER and not n.dropped:
            n.container = True
            n.path = f"{up.path}/{generalised(tag, found.get('class', ''))}"
            if len(n.path) > LONGEST_PATH:
                n.path = "#" + xxhash.xxh128_hexdigest(n.path.encode("utf-8", "surrogatepass"))
        elif tag == "a":
            links += 1
        opened[tag] += 1
        stack.append(n)
    flush()
    close(1)
    return without_forms(page, forms)


def without_forms(page: Page, forms: list[tuple[int, int, bool]]) -> Page:
    """Empty the blocks of forms, but not of a form around an article or around more than half of the page's text."""
    lengths = [len(x) for x in page.blocks]
    total = sum(lengths)
    for lo, hi, content in forms:
        if not content and 2 * sum(lengths[lo:hi]) <= total:
            page.blocks[lo:hi] = [""] * (hi - lo)
            page.linked[lo:hi] = [0] * (hi - lo)
    page.sums = [0.0]
    for x, n, p in zip(page.blocks, page.linked, page.paragraph, strict=True):
        page.sums.append(page.sums[-1] + (len(x) - n) * (1.0 if p else 0.5))
    return page


def score(page: Page, container: tuple[str, str, int, int]) -> float:
    """Text outside links, paragraphs counted in full and other blocks by half, weighted by the container's tag; of nested
    containers the inner one wins unless the outer one adds text."""
    tag, path, lo, hi = container
    return (page.sums[hi] - page.sums[lo]) * CONTAINER[tag] * (1 + 0.001 * min(path.count("/"), 100))


def best(page: Page) -> tuple[str, str, int, int] | None:
    """The best container, if it has text."""
    found = max(page.containers, key=lambda c: (score(page, c), c[1]), default=None)
    return found if found and any(page.blocks[found[2] : found[3]]) else None


def main_text(page: Page, path: str | None) -> str:
    """The text at a path, else of the page's best container, else of all blocks."""
    spans = [c[2:] for c in page.containers if c[1] == path]
    if not any(any(page.blocks[lo:hi]) for lo, hi in spans):
        own = best(page)
        spans = [] if own is None else [c[2:] for c in page.containers if c[1] == own[1]] if own[0] == "article" else [own[2:]]
    if not spans:
        return "\n".join(x for x in page.blocks if x)
    out, at = [], 0
    for lo, hi in sorted(spans):
        out += [x for x in page.blocks[max(lo, at) : hi] if x]
        at = max(at, hi)
    return "\n".join(out)


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        votes: Counter = Counter()
        for host, source in zip(pdf["host"], pdf["html"], strict=True):
            if own := best(parse(source)):
                votes[host, own[1]] += 1
        yield pd.DataFrame([(h, p, n) for (h, p), n in votes.items()], columns=["host", "path", "votes"])


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts = [main_text(parse(s), p) for s, p in zip(pdf["html"], pdf["path"], strict=True)]
        yield pd.DataFrame({"page_id": pdf["page_id"].array, "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the winner of each host."""
    hosts = pages.select(_host().alias("host"), "html")
    votes = hosts.mapInPandas(_votes, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return votes.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), "path")).alias("path"))


def _host():
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(host)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    pages = pages.select("page_id", "url", "html")
    paths = stored(host_paths(pages), "host-paths")
    # Spark broadcasts the winners while they are small, by its own threshold, and else splits a hot host's partition.
    joined = pages.withColumn("host", _host()).join(paths, "host", "left")
    return joined.select("page_id", "url", "html", "path").mapInPandas(_extract, "page_id long, url string, text string, n_chars long")
