"""Main text of web pages as a maximum-scoring subsequence.

A page is read as a sequence of words and tags. A word scores the weight of its place, zero at
least; a tag scores a weight below zero. One linear scan finds the contiguous stretch of blocks with the largest
sum, and the stretch's blocks whose words score are the text. Every page takes this way, whether
it marks its article or not, and the mark itself has no part in a place.

Weights come from labelled pages, those that mark one article (one ``article``, or else one ``main``). Words
within it count as inside, unless their element is one that the task leaves out of an article; all
others, menus too, count as outside. A word's place is its landmark (the nearest element that is a part of a page
such as ``nav`` or that has classes or a role) with the last two elements that aren't mere containers, so that a list
in an article and one in a menu are two places. Its weight is the log-odds of inside against outside, clipped
to CLIP; a place that wasn't seen takes that of the landmark and last element, then of the landmark. A
tag's weight is the log of its rate per word inside over that outside, between -TAG_CLIP and -TAG_LEAST.
What no labelled page shows falls back to the fixed lists below. The sample of labelled pages is bounded
(SAMPLE_PAGES, by hash of page id and html), counted in tasks and summed in Spark; every page is extracted whole.

Edge cases: null or empty html gives an empty text; a page without scoring words too; without any
labelled page the fixed lists decide alone; unclosed and stray tags are read as a browser would close them, in
time proportional to the page; character references are decoded where HTML allows; ties
go to the earlier and shorter stretch; repeated rows get equal texts; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 2000
MIN_WORDS = 3
CLIP = 3.0
#: A tag costs at most and at least so much. Two tags around an advert cost less than one word of an article scores.
TAG_CLIP, TAG_LEAST = 1.0, 0.1
#: Scores where nothing is learned: of a word that no list excludes, and of a tag.
PLAIN_WORD, PLAIN_TAG = 2.0, 0.1

# Element names and class words of HTML pages.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr"}
NEVER = {"nav", "footer", "aside", "form", "button", "select", "head", "svg", "object", "dialog", "menu"} | RAW
NEVER_CLASS = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment",
               "comments", "consent", "cookie", "cookies", "footer", "header", "masthead", "menu", "nav", "navbar",
               "navigation", "newsletter", "notice", "notices", "popup", "promo", "promoted", "related", "replies", "share", "sharing",
               "sidebar", "social", "sponsor", "sponsored", "subscribe", "widget"}
CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form",
            "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
CLOSES_SELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "body", "html", "article", "main", "section", "div", "nav", "aside", "footer", "header",
         "form", "blockquote", "select"}

PARTS = {"nav", "footer", "aside", "header", "form", "menu", "dialog", "fieldset", "figure", "details", "address", "head"}
CONTAINERS = {"html", "body", "article", "main", "section", "div", "center", "hgroup"}
HOMES = ("article", "main")

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                  r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Element:
    __slots__ = ("article", "landmark", "main", "name", "never", "own", "path", "within")

    def __init__(self, name: str, attributes: str, parent: Element | None) -> None:
        self.name = name
        given = [(kind.lower(), "".join(groups)) for kind, *groups in _MARK.findall(attributes)] if attributes else []
        marks = sorted({m.lower() for _, value in given for m in _WORDS.findall(_CAMEL.sub(" ", value))})
        shown = sorted({m.lower() for kind, value in given if kind != "id" for m in value.split()})
        self.article = name == "article" or (parent is not None and parent.article)
        self.main = name == "main" or (parent is not None and parent.main)
        inside = parent is not None and parent.within
        self.within = inside or name in HOMES
        self.never = (parent is not None and parent.never) or name in NEVER or (name == "header" and not self.within) or (
            name not in CONTAINERS - {"div", "section"} and not NEVER_CLASS.isdisjoint(
                set(shown) - {"header"} if inside else marks))
        telling = name in PARTS or (shown and name not in ("html", "body", *HOMES))
        self.own = ".".join([name, *shown]) if telling else name
        if telling:
            self.landmark, self.path = self.own, ()
        else:
            self.landmark = parent.landmark if parent else "flow"
            before = parent.path if parent else ()
            self.path = before if name in CONTAINERS else (*before, name)[-2:]


class Block:
    """A block's text, its element, and the tags before it since the last block's text."""

    __slots__ = ("element", "tags", "text", "words")

    def __init__(self, text: str, element: Element, tags: list[str]) -> None:
        self.text, self.element, self.tags, self.words = text, element, tags, text.count(" ") + 1


class Page:
    """The blocks of a page, and where its tags stand."""

    def __init__(self, html: str) -> None:
        self.blocks: list[Block] = []
        self.homes = dict.fromkeys(HOMES, 0)
        self.outside = Element("body", "", None)
        self.stack: list[Element] = []
        self.open: dict[str, list[int]] = {}   # places in the stack of the open elements of a name
        self.scopes: list[int] = []
        self.pieces: list[str] = []
        self.tags: list[str] = []
        self.seen: list[tuple[str, Element]] = []  # every tag with the element it stands in
        self._read(html)
        self._close_block()

    def _top(self) -> Element:
        return self.stack[-1] if self.stack else self.outside

    def _close_block(self) -> None:
        if self.pieces:
            text = " ".join(entities.unescape("".join(self.pieces)).split())
            self.pieces.clear()
            if text:
                self.blocks.append(Block(text, self._top(), self.tags))
                self.tags = []

    def _push(self, element: Element) -> None:
        self.open.setdefault(element.name, []).append(len(self.stack))
        if element.name in SCOPE:
            self.scopes.append(len(self.stack))
        self.stack.append(element)

    def _pop_to(self, k: int) -> None:
        self._close_block()
        while len(self.stack) > k:
            name = self.stack.pop().name
            self.open[name].pop()
            if name in SCOPE:
                self.scopes.pop()

    def _close_open(self, names: set[str]) -> None:
        """Closes the last open element of these names, unless a scope was opened since."""
        at = max((self.open[n][-1] for n in names if self.open.get(n)), default=-1)
        if at > (self.scopes[-1] if self.scopes else -1):
            self._pop_to(at)

    def _tag(self, key: str, element: Element) -> None:
        self.tags.append(key)
        self.seen.append((key, element))

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            m = _TAG.search(html, at)
            if m is None:
                self.pieces.append(html[at:])
                return
            if m.start() > at:
                self.pieces.append(html[at: m.start()])
            at = m.end()
            if m[2] is None:
                continue
            name = m[2].lower()
            if name in INLINE:
                self._tag("/" + name if m[1] else name, self._top())
            elif m[1]:
                if self.open.get(name):
                    self._pop_to(self.open[name][-1])
                else:
                    self._close_block()
                self._tag("/" + name, self._top())
            else:
                at = self._opening(name, m[3], html, at)

    def _opening(self, name: str, attributes: str, html: str, at: int) -> int:
        """Opens an element; returns where to read on."""
        self._close_block()
        if name in VOID:
            self._tag(name, self._top())
            return at
        if name in CLOSES_P:
            self._close_open({"p"})
        if name in CLOSES_SELF:
            self._close_open(CLOSES_SELF[name])
        if name in ("html", "body") and self.open.get(name):
            return at
        if name in HOMES:
            self.homes[name] += 1
        if attributes.endswith("/") and name in ("svg", "path"):
            return at
        if name == "body":  # an unclosed head ends here
            self._pop_to(1 if self.stack and self.stack[0].name == "html" else 0)
        element = Element(name, attributes, self.stack[-1] if self.stack else None)
        self._tag(element.own, self._top() if name in HOMES else element)
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            self._tag("/" + name, element)
            return end.end() if end else len(html)
        self._push(element)
        return at

    def label(self) -> str | None:
        """The element that marks this page's article, if there is just one."""
        if self.homes["article"]:
            return "article" if self.homes["article"] == 1 else None
        return "main" if self.homes["main"] == 1 else None


def places(e: Element) -> list[str]:
    """Names of a word's place, the most telling first."""
    out = [f"{e.landmark}|{'>'.join(e.path)}", f"{e.landmark}|*>{e.path[-1] if e.path else ''}"]
    return out if e.landmark == "flow" else [*out, f"{e.landmark}|*"]


def counts(html: str) -> Counter:
    """(feature, inside) -> words or tags, of a page that marks its article; empty for others. Tags begin with ``<``."""
    page, seen = Page(html), Counter()
    mark = page.label()
    if mark:
        for b in page.blocks:
            inside = getattr(b.element, mark) and not b.element.never
            seen["", inside] += b.words
            for f in places(b.element):
                seen[f, inside] += b.words
        for key, e in page.seen:
            seen["<" + key, getattr(e, mark) and not e.never] += 1
    return seen


def weigh(totals: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Weight of every feature from its counts (inside, outside); the empty feature counts all words."""
    words = totals.get("", (0, 0))
    base = np.log((words[0] + 0.5) / (words[1] + 0.5))
    out = {}
    for f, (i, o) in totals.items():
        odds = np.log((i + 0.5) / (o + 0.5))
        if f.startswith("<"):
            out[f] = float(np.clip(odds - base, -TAG_CLIP, -TAG_LEAST))
        elif f and i + o >= MIN_WORDS:
            out[f] = float(np.clip(odds, -CLIP, CLIP))
    return out


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weight of every place and tag that the sampled labelled pages show."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for html in batch.column("html"):
                total.update(counts(html.as_py() or ""))
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in total], pa.string()),
                 pa.array([n if k else 0 for (_, k), n in total.items()], pa.int64()),
                 pa.array([0 if k else n for (_, k), n in total.items()], pa.int64())], ["feature", "inside", "outside"])
    n = pages.select("page_id").count()
    share = int(min(1.0, sample / max(n, 1)) * (1 << 30))
    some = pages.filter(F.pmod(F.xxhash64("page_id", "html"), F.lit(1 << 30)) < share).select("html")
    rows = (some.mapInArrow(run, "feature string, inside long, outside long").groupBy("feature")
            .agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).collect())
    return weigh({r["feature"]: (r["i"], r["o"]) for r in rows})


def word_score(weights: dict[str, float], e: Element) -> float:
    """What a word in this element scores."""
    for f in places(e):
        if f in weights:
            return max(0.0, weights[f])
    return 0.0 if e.never else PLAIN_WORD


def best_stretch(before: list[float], scores: list[float]) -> tuple[int, int]:
    """First and end index of the stretch with the largest sum, where ``before[k]`` is paid to join k to its predecessor."""
    best, lo, hi = 0.0, 0, 0
    run, begin = 0.0, 0
    for k, score in enumerate(scores):
        run += before[k]
        if run <= 0:
            run, begin = 0.0, k
        run += score
        if run > best:
            best, lo, hi = run, begin, k + 1
    return lo, hi


def extract(weights: dict[str, float], html: str) -> str:
    """The main text of a page."""
    blocks = Page(html).blocks
    scores = [word_score(weights, b.element) * b.words for b in blocks]
    before = [sum(weights.get("<" + t, -PLAIN_TAG) for t in b.tags) for b in blocks]
    lo, hi = best_stretch(before, scores)
    return "\n".join(blocks[k].text for k in range(lo, hi) if scores[k] > 0)


def main_text(pages: DataFrame) -> DataFrame:
    """The contract's row per page."""
    pages = pages.select("page_id", "url", "html")
    shared = pages.sparkSession.sparkContext.broadcast(fit(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                own = batch.slice(lo, 512)
                texts = [extract(shared.value, h.as_py() or "") for h in own.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [own.column("page_id"), own.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
