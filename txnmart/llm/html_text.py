"""Main text of web pages by markup and by differencing with the nearest page of the same host.

A page is cut into lines, one per block. Markup puts each line into a zone: ``main`` inside an
``article`` or ``main`` element, ``chrome`` inside menus, headers, footers, sidebars, notices, adverts,
forms and reader comments (by element, role, class or id), and ``open`` elsewhere. Words of class or id
decide nothing for the page, ``main`` and ``article`` or what holds them, so reader comments that are
``article`` elements are chrome inside another article only; nor for an element with over half of the
text of a page that has no main zone, unless it is one of reader comments. Pages are ordered
by host, path and html, and each is differenced with the nearest different page before or after it, of the same
host, whose path has the longer common start: lines are aligned by a longest common subsequence, and open lines
that both pages share are template and deleted. Chrome lines are deleted as well. A shared line of
two articles is a quotation or a copy, not template, so lines of the main zone stay.

Pages are dealt by ranges of (host, path, html, id), so a hot host is spread over tasks; a page that is
the only different one of its host in its range has no partner, and keeps its open lines.

Nulls: NULL html counts as empty and gives an empty text; a NULL URL has an empty host and path,
like one without ``://``. Repeated rows are pages of their own, and equal pages next to each other are differenced
with the same page. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import html as markup
import os
import re
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.llm.url_rules import parts

CHROME_TAGS = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "head"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"}
#: A name of class or id that holds one of these is chrome.
CHROME_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsored cookie cookies consent sidebar nav navbar navigation "
    "breadcrumb breadcrumbs masthead footer comment comments disqus newsletter".split()
)
#: These may name a page's subject as well, so they count only as whole names or together with the words of `FURNITURE`.
SUBJECT_WORDS = set(
    "sponsor promo notice notices alert menu respond subscribe signup popup modal overlay share sharing social related "
    "recommended login search".split()
)
#: These mark chrome outside of an article only; inside, they hold its headline.
OUTER_WORDS = {"header", "banner", "widget"}
FURNITURE = set(
    "site page top bottom left right main box bar button buttons link links list form icon icons container wrapper "
    "block panel section area item items posts articles stories".split()
)
READER_NAMES = {"comment", "comments", "disqus", "disqus_thread", "respond"}
#: Their content is text up to their end tag, or up to the page's end without one.
RAW_TAGS = {"script", "style", "textarea", "title"}
#: Elements that are not shown; without an end tag they end with their parent, `FOREIGN` ones at the next block as well.
DROPPED_TAGS = {"noscript", "template", "svg", "iframe", "object", "math", "canvas"}
FOREIGN = {"svg", "math"}
VOID_TAGS = {"br", "img", "hr", "meta", "link", "input", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
BLOCK_TAGS = set(
    "p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table tr td th thead tbody tfoot caption section article main blockquote "
    "pre figure figcaption address hr nav header footer aside form body html fieldset legend details summary menu "
    "dialog center option select button head".split()
)
#: Elements whose end tag is often left out, or that hold no blocks: they don't nest the ones around them.
LOOSE_TAGS = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody", "tfoot"}
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>", re.S
)
MARK = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
UNSHOWN = re.compile(r"(?i)(?:^|;)\s*display\s*:\s*none\b")
#: Elements that hold the page or its main text: words of their class and id say nothing about chrome.
HOLDERS = {"html", "body", "main", "article"}
Line = tuple[str, str]


class Zone:
    """Zone of an element and those inside it; ``soft`` chrome rests on words of class or id only, ``reader`` on those of comments."""

    def __init__(self, name: str, outer: Zone | None = None, chrome: str = "", article: bool = False) -> None:
        self.name, self.outer, self.article = name, outer, article
        self.soft, self.reader = chrome in ("soft", "reader"), chrome == "reader"


def _leave_soft(zone: Zone, tag: str) -> None:
    """Soft chrome around a ``main`` or ``article`` holds the text, so it is none; articles inside an article don't tell."""
    chain = []
    while zone.name == "chrome" and zone.soft:
        chain.append(zone)
        zone = zone.outer
    if zone.name == "chrome":
        return
    for own in reversed(chain):
        if tag == "article" and own.article:
            break
        own.name = own.outer.name


def _chrome(tag: str, attributes: str, in_main: bool) -> str:
    """``hard`` by element, role or being hidden, ``soft`` by words of class or id, ``reader`` by those of comments, empty if no chrome."""
    if tag in CHROME_TAGS and not (in_main and tag == "header"):
        return "hard"
    if not attributes or tag in ("html", "body"):
        return ""
    soft = ""
    for name, *values in MARK.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "style" and UNSHOWN.search(value)):
            return "hard"
        if name not in ("class", "id", "role"):
            continue
        names = value.lower().split()
        if name == "role":
            if CHROME_ROLES & set(names):
                return "hard"
        elif tag not in HOLDERS and READER_NAMES & set(names):
            soft = "reader"
        elif tag not in HOLDERS and any(_names_chrome(own, in_main) for own in names):
            soft = soft or "soft"
    return soft


def _names_chrome(name: str, in_main: bool) -> bool:
    words = set(re.split(r"[^a-z0-9]+", name))
    some = SUBJECT_WORDS if in_main else SUBJECT_WORDS | OUTER_WORDS
    return bool(words & CHROME_WORDS or (words & some and words <= some | FURNITURE))


def _keep_large(out: list[tuple[Zone, str]]) -> None:
    """Where nothing is main, a soft zone with over half of the text that is not hard chrome is no chrome."""
    if any(zone.name == "main" for zone, _ in out):
        return
    sizes: dict[int, int] = {}
    for zone, whole in out:
        if zone.name == "open" or zone.soft:
            sizes[id(zone)] = sizes.get(id(zone), 0) + len(whole)
    half = sum(sizes.values()) / 2
    for zone, _ in out:
        if zone.name == "chrome" and zone.soft and not zone.reader and sizes[id(zone)] > half and _soft_only(zone):
            zone.name = "open"


def _soft_only(zone: Zone | None) -> bool:
    """Neither in hard chrome nor in reader comments."""
    while zone is not None:
        if zone.reader or (zone.name == "chrome" and not zone.soft):
            return False
        zone = zone.outer
    return True


def lines(page: str) -> list[Line]:
    """The page's blocks as (zone, text), without empty ones."""
    out: list[tuple[Zone, str]] = []
    stack: list[tuple[str, Zone]] = []  # open elements that nest, with the zone inside
    loose: Zone | None = None  # zone of an open element that doesn't nest, if it is chrome
    text: list[str] = []
    zone = top = Zone("open")
    mark: int | None = None  # where in ``text`` an element that is not shown begins
    inner: list[str] = []  # that element and those open inside it

    def close() -> None:
        whole = " ".join(markup.unescape("".join(text)).split())
        if whole:
            out.append((loose or zone, whole))
        text.clear()

    at = 0
    while found := TAG.search(page, at):
        text.append(page[at : found.start()])
        at = found.end()
        slash, tag, attributes = found[1], found[2], found[3]
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW_TAGS:
            if not slash and not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if mark is not None:
            breaks = tag == "body" or (inner[0] in FOREIGN and tag in BLOCK_TAGS and "foreignobject" not in inner)
            if not slash and not breaks:
                if tag not in VOID_TAGS and not attributes.endswith("/"):
                    inner.append(tag)
                continue
            if slash and tag in inner:
                while inner.pop() != tag:
                    pass
                if inner:
                    continue
            elif slash and all(entry[0] != tag for entry in stack):
                continue
            del text[mark:]
            mark = None
            if slash and not inner:
                continue
        elif tag in DROPPED_TAGS:
            if not slash and not attributes.endswith("/"):
                mark, inner = len(text), [tag]
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK_TAGS:
            close()
            loose = None
        if tag in VOID_TAGS:
            continue
        if slash:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    zone = stack[-1][1] if stack else top
                    break
            continue
        if tag == "body":
            stack, zone = [entry for entry in stack if entry[0] != "head"], top
        chrome = _chrome(tag, attributes, zone.name == "main")
        if tag in LOOSE_TAGS:
            loose = Zone("chrome", zone, chrome) if chrome else None
        elif tag in BLOCK_TAGS and not attributes.endswith("/"):
            holds = tag in ("article", "main") and not chrome
            if holds:
                _leave_soft(zone, tag)
            # Inside hard chrome all is chrome; inside soft chrome each element may turn out to hold the text.
            if chrome and (zone.name != "chrome" or zone.soft):
                zone = Zone("chrome", zone, chrome, zone.article)
            elif holds and zone.name != "chrome":
                zone = Zone("main", zone, article=zone.article or tag == "article")
            stack.append((tag, zone))
    text.append(page[at:])
    if mark is not None:
        del text[mark:]
    close()
    _keep_large(out)
    return [(own.name, whole) for own, whole in out]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each start of ``b``, by one bit per item of ``b``."""
    where: dict[int, int] = {}
    for at, item in enumerate(b):
        where[item] = where.get(item, 0) | 1 << at
    full = (1 << len(b)) - 1
    row = full
    for item in a:
        hit = row & where.get(item, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def aligned(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` that a longest common subsequence of ``a`` and ``b`` uses; memory grows with the longer one only."""
    out: set[int] = set()
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.add(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.add(a1)
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1:
            if a[a0] in b[b0:b1]:
                out.add(a0)
            continue
        mid = (a0 + a1) // 2
        head = _lengths(a[a0:mid], b[b0:b1])
        tail = _lengths(a[mid:a1][::-1], b[b0:b1][::-1])[::-1]
        cut = b0 + int((head + tail).argmax())
        todo += [(a0, mid, b0, cut), (mid, a1, cut, b1)]
    return out


def main_lines(page: list[Line], partner: list[Line] | None) -> list[str]:
    """The page's text lines without chrome, and without open lines that align with the partner's."""
    shared: set[int] = set()
    if partner is not None:
        ids: dict[str, int] = {}
        a, b = ([ids.setdefault(text, len(ids)) for _, text in own] for own in (page, partner))
        both = set(a) & set(b)
        # Lines of one page only can't align.
        places = [at for at, item in enumerate(a) if item in both]
        shared = {places[at] for at in aligned([a[at] for at in places], [item for item in b if item in both])}
    return [text for at, (zone, text) in enumerate(page) if zone == "main" or (zone == "open" and at not in shared)]


def _near(path: str, other: str) -> int:
    return len(os.path.commonprefix([path, other]))


def differenced(pages: Iterable[tuple[str, str, str]]) -> Iterator[str]:
    """Main text of each page (host, path, html) in order; holds three different pages at a time."""
    before = now = None
    copies = 0
    for host, path, page in pages:
        if now is not None and (host, page) == (now[0], now[3]):
            copies += 1
            continue
        after = (host, path, lines(page), page)
        if now is not None:
            yield from repeat(_text(before, now, after), copies)
        before, now, copies = now, after, 1
    if now is not None:
        yield from repeat(_text(before, now, None), copies)


def _text(before, now, after) -> str:
    near = [other for other in (before, after) if other is not None and other[0] == now[0]]
    partner = max(near, key=lambda other: _near(now[1], other[1]), default=None)
    return "\n".join(main_lines(now[2], partner[2] if partner else None))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of each row of ``pages``."""
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("_html"), host.alias("_host"), path.alias("_path"))
    # The html's hash puts equal pages of a path next to each other.
    key = ["_host", "_path", "_hash", "page_id"]
    rows = rows.withColumn("_hash", F.xxhash64("_html"))
    ordered = rows.repartitionByRange(*key).sortWithinPartitions(*key).drop("_hash")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The text of a page is known when the next different one has come, so ids wait for it.
        waiting: deque[tuple] = deque()

        def stream() -> Iterator[tuple[str, str, str]]:
            for batch in batches:
                columns = [batch.column(name) for name in ("page_id", "url", "_host", "_path", "_html")]
                for values in zip(*columns, strict=True):
                    page_id, url, host, path, page = (value.as_py() for value in values)
                    waiting.append((page_id, url))
                    yield host, path, page

        out: list[tuple] = []
        for text in differenced(stream()):
            out.append((*waiting.popleft(), text))
            if len(out) == 1000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    kind = pages.schema["page_id"].dataType.simpleString()
    return ordered.mapInArrow(mapped, f"page_id {kind}, url string, text string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({name: [row[at] for row in rows] for at, name in enumerate(("page_id", "url", "text"))})
