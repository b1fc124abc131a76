"""Main text of web pages: markup first, then repeated substrings of the host.

A page is read as blocks of text in order. Markup settles most of them: menus, headers,
footers, sidebars, notices, adverts, forms, reader comments, scripts and styles go, and where
a page has an article (or else a main part, or a part named as content) the rest is what
lies inside it. A page without any such part is settled by its host. The token streams of
the host's pages, outside their articles, form one text whose suffixes are named by their
first ``DEPTH`` tokens; equal names are neighbours in its suffix array, and those of two
distinct pages mark a repeated substring. Runs of such names cover what repeats, however
long it is: a token is covered exactly if a full suffix array has it in a common substring of
``DEPTH`` tokens of two pages. A block that is covered for the most part is boilerplate; the
others are kept whole.

Blocks inside an article meet the repeats as well, but documents share passages and sidebars
quote them, so a repeat alone means nothing there. A block goes only if most of it is covered
by names that at least half of the host's pages have outside their articles and at least half
of its distinct articles inside, ``LEAST`` at least.

Class names count by their last word that says what the part is ("related-posts", but not
"related-work"), and not where they tell a state ("has-sidebar", "comments-open"). A main part
inside an element that is chrome by its name only is a main part.

Suffix names are counted per host by Spark with partial sums, so a host that holds most pages
is no single task's work. Names inside articles are joined with the repeated ones; a bit table
of bounded size keeps most names that do not repeat out of that join. Only pages with
something to remove meet the counts again.

Defined results: a null html counts as empty and has empty text. Pages of equal html are one
page to the search for repeats, so copies do not erase each other. Repeated rows and null
ids stay. A page whose url has no host shares its streams with the others of that kind. Only
the id, url and html columns are used.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.collocations import bit_table
from seekframe.llm.common import stored

DEPTH = 6
MIN_COVER = 0.5
LEAST = 3

_TAG = re.compile(
    r"""<(?:(/?)([a-zA-Z][\w:-]*+)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+|[^>]*+)|[!?/][^>]*+)>"""
)
_ATTRIBUTE = re.compile(
    r"""(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
    re.IGNORECASE,
)
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")

#: Elements whose content is not text of the page.
_RAW = {"script", "style", "noscript", "template", "iframe", "object", "svg", "math", "head"}
_RAW |= {"textarea", "select", "canvas", "video", "audio"}
_CHROME = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
#: Elements that do not end a block.
_INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby"
    " s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_CHROME_NAMES = set(
    "ad ads adsense advert adverts advertisement advertising banner promo promotion sponsor"
    " sponsored cookie cookies consent gdpr notice notices alert popup modal overlay newsletter"
    " subscribe subscription sidebar menu menus nav navbar navigation breadcrumb breadcrumbs"
    " pagination pager footer comment comments disqus respond reply replies share sharing"
    " social related recommended widget toolbar login signup search".split()
)
#: First and last words of names that tell a state of the page.
_STATE_FIRST = {"has", "no", "not", "with", "without", "is", "hide", "show"}
_STATE_LAST = {"open", "closed", "enabled", "disabled", "on", "off", "visible", "collapsed"}
#: Last words that leave open what the part is.
_VAGUE = set(
    "left right top bottom primary secondary first last wrapper wrap container holder box block"
    " area section region row col column inner outer bar panel pane group set list items item"
    " links link buttons button icons icon form posts post articles article stories entries"
    " content body text title heading header message slot unit widgets zone global site desktop"
    " mobile sticky fixed".split()
)
_COMMENT_NAMES = {"comment", "comments", "reply", "replies"}
_CHROME_ROLES = set(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar"
    " form toolbar".split()
)
_CONTENT_NAMES = {"content", "article", "post", "entry", "story"}
_NOT_CHROME = {"html", "body", "main"}

#: Chrome by name alone, chrome by its element or role, no part, parts.
NAMED, CHROME, OPEN, CONTENT, MAIN, ARTICLE = range(-1, 5)


@dataclass
class Page:
    """Blocks in order: their text and whether they are chrome or in which kind of part."""

    texts: list[str] = field(default_factory=list)
    zones: list[int] = field(default_factory=list)

    def settled(self) -> str | None:
        """The text of the innermost kind of part that the page has, or None without any."""
        best = max(self.zones, default=OPEN)
        if best < CONTENT:
            return "" if not self.texts else None
        return " ".join(t for t, z in zip(self.texts, self.zones, strict=True) if z == best)

    def _part(self) -> int:
        best = max(self.zones, default=OPEN)
        return best if best >= CONTENT else ARTICLE + 1

    def outside(self) -> list[list[str]]:
        """Tokens of each block that is not in the part, none for the others."""
        part = self._part()
        return [t.split() if z != part else [] for t, z in zip(self.texts, self.zones, strict=True)]

    def inside(self) -> list[str]:
        """The blocks in the part."""
        part = self._part()
        return [t for t, z in zip(self.texts, self.zones, strict=True) if z == part]


@lru_cache(maxsize=65_536)
def _subject(name: str) -> str:
    """The last word of a class name that says what the part is; empty for a state."""
    found = [w.lower() for w in _NAME.findall(name)]
    if not found or found[0] in _STATE_FIRST or found[-1] in _STATE_LAST:
        return ""
    while len(found) > 1 and found[-1] in _VAGUE:
        found.pop()
    return found[-1]


def _zone(tag: str, attributes: str, around: int) -> int:
    """Zone inside an element, given the zone around it."""
    if around == CHROME:
        return CHROME
    values: dict[str, str] = {}
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            values.setdefault(name.lower(), value.strip("\"'"))
    named = f"{values.get('class', '')} {values.get('id', '')}".split()
    if tag in _CHROME or (tag == "header" and OPEN <= around < CONTENT):
        return CHROME
    if "hidden" in values or values.get("aria-hidden") == "true":
        return CHROME
    if "display:none" in values.get("style", "").replace(" ", "").lower():
        return CHROME
    role = values.get("role", "").lower()
    body = values.get("itemprop", "").lower() == "articlebody"
    if around == NAMED:
        if tag != "main" and role != "main" and not body:
            return NAMED
        around = OPEN
    subjects = set(map(_subject, named))
    if tag == "article":
        return CHROME if subjects & _COMMENT_NAMES else ARTICLE
    if tag not in _NOT_CHROME:
        if role in _CHROME_ROLES:
            return CHROME
        if subjects & _CHROME_NAMES:
            return NAMED
    if body or role == "article":
        return ARTICLE
    if tag == "main" or role == "main":
        return max(around, MAIN)
    if tag not in _NOT_CHROME:
        if any(n.lower() in _CONTENT_NAMES for part in named for n in _NAME.findall(part)):
            return max(around, CONTENT)
    return around


def read_page(html: str | None) -> Page:
    """The blocks of a page; unclosed and stray tags are read as browsers would, roughly."""
    page, html = Page(), html or ""
    stack: list[tuple[str, int]] = []
    zone, pieces, at = OPEN, [], 0
    raw_end = len(html)

    def close_block() -> None:
        text = " ".join(unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            page.texts.append(text)
            page.zones.append(max(zone, CHROME))

    last_tag = html.rfind(">")
    while True:
        opened = html.find("<", at)
        if opened < 0 or opened > last_tag:
            pieces.append(html[at:])
            break
        pieces.append(html[at:opened])
        if html.startswith("<!--", opened):
            end = html.find("-->", opened + 4)
            at = raw_end if end < 0 else end + 3
            continue
        match = _TAG.match(html, opened)
        if match is None:
            pieces.append("<")
            at = opened + 1
            continue
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if tag not in _INLINE:
                close_block()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    if tag in _INLINE and stack[depth][1] != zone:
                        close_block()
                    zone = stack[depth][1]
                    del stack[depth:]
                    break
            continue
        if tag in _RAW:
            close_block()
            if not match[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at)
                if end is not None:
                    at = end.end()
                elif tag != "head":
                    at = raw_end
            continue
        inner = _zone(tag, match[3], zone)
        if tag not in _INLINE:
            close_block()
            if tag in {"p", "li"} or tag in _CHROME or tag in {"div", "article", "section"}:
                # A paragraph that was never closed ends here, with its zone.
                if stack and stack[-1][0] == "p":
                    zone = stack.pop()[1]
                    inner = _zone(tag, match[3], zone)
        elif inner != zone:
            close_block()
        if tag not in _VOID and (tag not in _INLINE or inner != zone):
            stack.append((tag, zone))
            zone = inner
    close_block()
    return page


def suffix_names(tokens: list[str], host: str, depth: int = DEPTH) -> np.ndarray:
    """Names of the suffixes of a stream by their first ``depth`` tokens, within the host.

    Each doubling names twice as many tokens by the names of both halves.
    """
    seed = xxhash.xxh64_intdigest(host)
    names = np.fromiter(
        (xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), seed) for t in tokens),
        np.uint64,
        len(tokens),
    )
    known = 1
    while known < depth and len(names):
        step = min(known, depth - known)
        names = names[:-step] * np.uint64(0x9E3779B97F4A7C15) ^ (names[step:] + np.uint64(known))
        names ^= names >> np.uint64(31)
        known += step
    return names if len(tokens) >= depth else names[:0]


def _host(url: str | None) -> str:
    head, mark, rest = (url or "").partition("://")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower() if mark else ""


def _digest(text: str, host: str) -> int:
    """A signed hash of a text within the host."""
    named = f"{host}\n{text}".encode("utf-8", "surrogatepass")
    return xxhash.xxh64_intdigest(named) - (1 << 63)


def _inside_names(page: Page, host: str) -> np.ndarray:
    return suffix_names([t for b in page.inside() for t in b.split()], host).view(np.int64)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        settled, names, hosts, articles = [], [], [], []
        for url, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            page, host = read_page(html), _host(url)
            tokens = [t for block in page.outside() for t in block]
            text = page.settled()
            settled.append(text is not None)
            names.append(suffix_names(tokens, host).view(np.int64))
            hosts.append(_digest("", host))
            articles.append(None if text is None else _digest(text, host))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(settled),
                pa.array(names, pa.list_(pa.int64())),
                pa.array(hosts, pa.int64()),
                pa.array(articles, pa.int64()),
            ],
            names=["page", "settled", "names", "host", "article"],
        )


def _settled_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [read_page(html).settled() for html in batch.column(3).to_pylist()]
        out = pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(texts, pa.string())], names=["key", "url", "page", "text"]
        )
        yield out.filter(out.column(3).is_valid())


def _covered(blocks: list[list[str]], starts: list[int]) -> list[bool]:
    """Whether suffixes at ``starts`` cover each block of a stream for the most part."""
    covered = np.zeros(sum(map(len, blocks)) + DEPTH, bool)
    for start in starts:
        covered[start : start + DEPTH] = True
    out, at = [], 0
    for tokens in blocks:
        out.append(bool(tokens) and covered[at : at + len(tokens)].mean() >= MIN_COVER)
        at += len(tokens)
    return out


def _kept(html: str | None, starts: list[int], inside: list[int]) -> str:
    """Blocks of a page that are not chrome and not covered for the most part."""
    page = read_page(html)
    if page.settled() is None:
        covered = _covered(page.outside(), starts)
        zoned = zip(page.texts, page.zones, covered, strict=True)
        return " ".join(text for text, zone, gone in zoned if zone != CHROME and not gone)
    blocks = page.inside()
    covered = _covered([b.split() for b in blocks], inside)
    return " ".join(text for text, gone in zip(blocks, covered, strict=True) if not gone)


def _open_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in (3, 4, 5))
        texts = [
            _kept(html, starts or [], inside or [])
            for html, starts, inside in zip(*columns, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(texts, pa.string())], names=["key", "url", "page", "text"]
        )


def _repeats_inside(source: DataFrame, repeated: DataFrame) -> DataFrame:
    """(page, host, article, start, name, n) where articles have names that repeat outside of them."""
    shared = source.sparkSession.sparkContext.broadcast(
        bit_table(repeated.select(F.col("name").alias("key")))
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        bits = np.uint64(len(cells) * 64 - 1)
        for batch in batches:
            found = [(np.zeros(0, np.int64),) * 5]
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                read, host = read_page(html), _host(url)
                names = _inside_names(read, host)
                place = names.view(np.uint64) & bits
                held = cells[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))
                starts = np.flatnonzero(held & np.uint64(1))
                if len(starts):
                    article = _digest(read.settled() or "", host)
                    own = (page, _digest("", host), article)
                    rows = [np.full(len(starts), value, np.int64) for value in own]
                    found.append((*rows, starts, names[starts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)],
                names=["page", "host", "article", "start", "name"],
            )

    met = source.select("page", "url", "html").mapInArrow(
        look, "page bigint, host bigint, article bigint, start bigint, name bigint"
    )
    return stored(met.join(repeated.hint("merge"), "name"), "inside")


def extract_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(key, url, text) of every page."""
    kind = pages.schema[key].dataType.simpleString()
    body = F.coalesce(F.col(html), F.lit(""))
    source = pages.select(
        F.col(key).alias("key"),
        F.col(url).alias("url"),
        F.xxhash64(body).alias("page"),
        body.alias("html"),
    )
    streams = stored(
        source.select("page", "url", "html").mapInArrow(
            _streams,
            "page bigint, settled boolean, names array<bigint>, host bigint, article bigint",
        ),
        "streams",
    )
    schema = f"key {kind}, url string, page bigint, text string"
    texts = source.mapInArrow(_settled_texts, schema)
    repeated = stored(
        streams.select("page", F.explode(F.array_distinct("names")).alias("name"))
        .groupBy("name")
        .agg(
            F.min("page").alias("least"),
            F.max("page").alias("most"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("least < most")
        .select("name", "n"),
        "repeated",
    )
    unsettled = streams.where("not settled").dropDuplicates(["page", "names"])
    open_pages = unsettled.select("page").distinct()
    placed = unsettled.select("page", F.posexplode("names").alias("start", "name")).join(
        repeated, "name"
    )
    inside = _repeats_inside(source, repeated)
    hosts = streams.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_distinct("article").alias("n_articles")
    )
    shared = (
        inside.select("host", "article", "name", "n")
        .distinct()
        .groupBy("host", "name", "n")
        .agg(F.count(F.lit(1)).alias("n_inside"))
        .where(F.col("n_inside") >= LEAST)
        .join(hosts.hint("merge"), "host")
        .where("2 * n >= n_pages AND 2 * n_inside >= n_articles")
    )
    covered = (
        inside.join(shared.select("name").hint("merge"), "name")
        .groupBy("page")
        .agg(F.collect_set("start").alias("inside"))
    )
    starts = placed.groupBy("page").agg(F.collect_set("start").alias("starts"))
    asked = stored(
        open_pages.join(starts, "page", "left").join(covered, "page", "full"), "asked"
    )
    if not asked.isEmpty():
        still = source.join(asked, "page").select(
            "key", "url", "page", "html", "starts", "inside"
        )
        rest = source.join(asked, "page", "left_anti").select("key", "url", "page", "html")
        texts = rest.mapInArrow(_settled_texts, schema).unionByName(
            still.mapInArrow(_open_texts, schema)
        )
    return texts.select(F.col("key").alias(key), F.col("url").alias(url), "text")
