"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element. Elements that declare themselves menus,
adverts, forms and the like leave empty lines behind, and so do the borders of articles.
The text lengths of the lines, link text apart and three times as much inside an article, are
summed over sliding windows of lines: where a sum rises above a threshold text surges, and
where it falls below it again, it dives. The lines between are a region, and the region with
the most text tells where the page's text is: it is what the article around that region holds,
or, outside of articles, what stands between the first and the last region of the element
that holds it.
"""

import os
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from learnlog.llm.shared import map_texts

#: Lines in a sliding window.
WINDOW = 3
#: Characters in a window from which text surges, if a quarter of the fullest window is not less.
SURGE = 40
#: Times that text inside an article counts.
MARKED = 3

# Names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup p pre search section summary table tbody tfoot thead tr ul".split()
)
RAW = frozenset("script style title textarea xmp noembed noframes iframe".split())
DROPPED = frozenset(
    "head nav footer aside form menu noscript template button select option datalist dialog svg "
    "canvas object embed audio video map applet input label fieldset search".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that hold the parts of a page.
CONTAINERS = frozenset("body div section center".split())
#: Elements that end where the next block begins, if no end tag comes first.
OPEN_ENDED = frozenset("p li dt dd tr td th option".split())
SPACED = frozenset("br td th wbr img".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar "
    "toolbar tablist".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Words in class or id that name what is not the article.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor "
    "sponsored menu nav navbar navigation breadcrumb breadcrumbs sidebar side rail footer comment "
    "comments reply replies disqus respond cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended widget toolbar pagination pager skip masthead copyright legal disclaimer".split()
)
#: Words that such names may be joined with by a hyphen or an underline.
JOINED_WORDS = frozenset(
    "area article bar block body bottom box btn button buttons card cards center column container "
    "content entry form global group header icon icons inline inner item items left link links "
    "list main module outer page panel post posts primary right row secondary section site slot "
    "story tab tabs text title top unit wrap wrapper".split()
)
#: Words that are dropped only outside an article.
HEAD_WORDS = frozenset("header head top topbar".split())
#: Words of class or id of an element that holds the article, beside such words as above.
ARTICLE_WORDS = frozenset("article post entry story content main body".split())
#: Words that name what readers write, also beside those of the article.
READER_WORDS = frozenset("comment comments reply replies disqus respond".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>"
    r"|<[/!?][^>]*+>",
    re.S,
)
_NAME = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)")
_PART = re.compile(r"[^-_]+")


@dataclass
class Line:
    """A block's text, the characters of it that count, and what is around it, outermost
    first: containers, and articles with the main parts among them marked."""

    text: str
    weight: int
    path: tuple[int, ...] = (0,)
    marks: tuple[tuple[str, int], ...] = ()


def _names(tokens: list[str], words: frozenset) -> bool:
    """Whether one of the names is one of the words, alone or joined with others of its kind."""
    for token in tokens:
        parts = set(_PART.findall(token))
        if not words.isdisjoint(parts) and parts <= words | DROPPED_WORDS | JOINED_WORDS:
            return True
    return False


def _declared(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element names itself as something beside the article.

    Headings never do, and inside an article no id does: ids are targets of links there.
    """
    if name in DROPPED or (name == "header" and not inside):
        return True
    if not attributes or name in ("html", "body", "main") or name in HEADINGS:
        return False
    found = {k.lower(): v.strip("\"'").lower() for k, v in _NAME.findall(attributes)}
    if found.get("role") in DROPPED_ROLES or found.get("aria-hidden") == "true":
        return True
    if _HIDDEN.search(_NAME.sub(" ", attributes.lower())):
        return True
    tokens = found.get("class", "").split() + ([] if inside else found.get("id", "").split())
    if _names(tokens, READER_WORDS):
        return True
    if not ARTICLE_WORDS.isdisjoint(tokens):
        return False
    return _names(tokens, DROPPED_WORDS) or (not inside and _names(tokens, HEAD_WORDS))


class _Open:
    """The open elements that matter: blocks and what is dropped.

    An end tag closes its element and all that were opened in it and not closed; one without
    an open element is ignored, at no cost however many are open.
    """

    def __init__(self):
        self.stack: list[tuple[str, str]] = []  # name and kind
        self.count: Counter = Counter()
        self.dropped = 0

    def push(self, name: str, kind: str) -> None:
        self.stack.append((name, kind))
        self.count[name] += 1
        self.dropped += kind == "dropped"

    def pop(self) -> str:
        name, kind = self.stack.pop()
        self.count[name] -= 1
        self.dropped -= kind == "dropped"
        return kind

    def close(self, name: str) -> Iterator[str]:
        """The kinds of the elements that an end tag closes."""
        if self.count[name]:
            while True:
                last = self.stack[-1][0] == name
                yield self.pop()
                if last:
                    return


def lines_of(html: str) -> list[Line]:
    """The lines of a page, with empty lines where something was dropped or an article begins
    or ends. One pass over the tags."""
    lines: list[Line] = []
    parts: list[str] = []
    path, marks = [0], []
    linked = depth = containers = 0
    opened = _Open()

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            own = max(0, len(text) - linked)
            lines.append(Line(text, own * (MARKED if marks else 1), tuple(path), tuple(marks)))
        parts.clear()
        linked = 0

    def gap() -> None:
        flush()
        lines.extend([Line("", 0)] * WINDOW)

    def add(text: str) -> None:
        nonlocal linked
        if text and not opened.dropped:
            text = unescape(text)
            parts.append(text)
            if depth:
                linked += len(" ".join(text.split()))

    def leave(kinds: Iterable[str]) -> None:
        for kind in kinds:
            if kind == "container":
                path.pop()
            elif kind == "mark":
                gap()
                marks.pop()

    at, end = 0, html.rfind(">") + 1  # no tag begins after the last one ends
    while tag := _TAG.search(html, at, end):
        add(html[at : tag.start()])
        at = tag.end()
        name, closing = (tag[2] or "").lower(), bool(tag[1])
        if not name:
            continue
        if name in RAW and not closing:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = close.end() if close else len(html)
            continue
        empty = name in VOID or tag[3].endswith("/")
        block = name in BLOCKS or name in DROPPED
        if block and not opened.dropped:
            flush()
        if not closing and (block or name in OPEN_ENDED) and opened.stack:
            # A block ends a paragraph, and an item the item before it.
            top = opened.stack[-1][0]
            if top == "p" or (top in OPEN_ENDED and name == top):
                leave(opened.close(top))
        if closing:
            if name == "a":
                depth = max(0, depth - 1)
            before = opened.dropped
            leave(opened.close(name))
            if before and not opened.dropped:
                gap()
        elif _declared(name, tag[3], bool(marks)):
            if not opened.dropped:
                gap()
            if not empty:
                opened.push(name, "dropped")
        elif opened.dropped:
            if block and not empty:
                opened.push(name, "block")
        elif name in ("article", "main"):
            gap()
            containers += 1
            marks.append((name, containers))
            opened.push(name, "mark")
        elif name in CONTAINERS:
            containers += 1
            path.append(containers)
            opened.push(name, "container")
        elif block and not empty:
            opened.push(name, "block")
        elif name == "a":
            depth += 1
        if name in SPACED and not opened.dropped:
            parts.append(" ")
    add(html[at:])
    flush()
    return lines


def regions(weights: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """Bounds of the lines between each surge of the windows' sums and the dive after it."""
    total = [0, *accumulate(weights)]
    last = len(weights)
    sums = [total[min(i + window, last)] - total[i] for i in range(last)]
    threshold = max(1, min(SURGE, max(sums, default=0) // 4))
    found, start = [], None
    for i, value in enumerate([*sums, 0]):
        if value >= threshold and start is None:
            start = i
        elif value < threshold and start is not None:
            found.append((start, i))
            start = None
    return found


def _held(lines: list[Line], best: list[Line], found: list[tuple[int, int]]) -> list[Line]:
    """The lines of what holds the lines of the best region."""
    around = os.path.commonprefix([line.marks for line in best])
    if around:
        # The article with all that is in it; of a main part around it, what no other article has.
        own = [mark for mark in around if mark[0] == "article"]
        return [
            line for line in lines if line.marks[:1] == around[:1]
            and [mark for mark in line.marks if mark[0] == "article"][: max(1, len(own))] in (own, [])
        ]
    path = os.path.commonprefix([line.path for line in best])
    inside = [i for a, b in found for i in range(a, b) if lines[i].path[: len(path)] == path]
    between = lines[min(inside) : max(inside) + 1]
    return [line for line in between if not line.marks and line.path[: len(path)] == path]


def main_text(html: str | None, window: int = WINDOW) -> str:
    """The blocks of the main text, joined by line feeds; empty without any."""
    lines = lines_of(html or "")
    weights = [line.weight for line in lines]
    found = regions(weights, window)
    if not found:
        return ""
    a, b = max(found, key=lambda r: (sum(weights[slice(*r)]), -r[0]))
    best = [line for line in lines[a:b] if line.text]
    # What a window reaches over a border does not count.
    most = max(best, key=lambda line: line.weight)
    best = [line for line in best if line.marks == most.marks or not most.marks]
    return "\n".join(line.text for line in _held(lines, best, found) if line.text)


def extract(pages: DataFrame, window: int = WINDOW) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every whole page.

    A NULL or empty page, or one without any text of its own, has an empty text. Of regions with
    equally much text the first counts. Time grows with the length of a page. Repeated rows stay rows of their own; other columns
    are not read.
    """

    def make() -> Callable:
        return lambda pages: [pa.array([main_text(h, window) for h in pages], pa.string())]

    return map_texts(
        pages, [("text", pa.string())], make, key="page_id", text="html", keep=["url"]
    )
