"""The main text of web pages as their maximum-scoring run of tokens.

A page is read as a sequence of words and tags. Each has a score: words by where they stand (the section, the block, in a
link or not), tags by their name, always below zero. The scores are log-odds, counted from the pages that
label their own article (an ``article`` or ``main`` element). One scan finds the contiguous run with the greatest
sum; the text is the run's words without those of menus, headers, footers, sidebars, notices, adverts, forms and comments.

Words of such a section within an article cost next to nothing, so that an advert can't split the article around it. A section is
told by its element or by a word in its class, id or role (the lists below). Wrappers around a whole page may bear such words
too: those of layout ("has-sidebar") are passed over, and a form or a hinted element that holds the page's only article
sets nothing aside. Headings in the header of an article belong to it.

Defined results: null and empty pages, and pages without a word of content, give an empty text. White space is what
``str.split`` takes for it. A tag that never ends runs to the end of the page. Repeated rows give equal texts.
An empty table gives an empty result. Other columns are not read. Without labelled pages the prior counts decide.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements whose text is never content, and words in a class or id that say the same. Fixed lists.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title")
ASIDE = frozenset("head nav header footer aside form button select dialog menu object canvas".split()) | frozenset(RAW)
HINTS = frozenset(
    "breadcrumb breadcrumbs cookie cookies disclaimer footer header login menu nav navbar navigation newsletter notice notices "
    "popup related share sharing sidebar social subscribe widget".split()
)
# Hints that hold whatever else is said or found in the element: adverts, and what readers write.
FIRM_HINTS = frozenset(
    "ad ads advert adverts advertisement banner comment comments discussion disqus promo promotion replies reply respond sponsored".split()
)
# Class words that, standing alone, outweigh other hints; words after which a hint tells of the page's layout only.
CONTENT_WORDS = frozenset("article content entry main post story".split())
LAYOUT_WORDS = frozenset("has no with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset(("article", "main"))
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that a new block of the named kinds ends by itself.
ENDS = {"p": BLOCKS - {"br"}, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "option": frozenset(("option",)),
        "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr"))}

# Quotes count only after an equals sign, and only if they are closed.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_HINT_WORD = re.compile(r"[a-z]+")


@dataclass
class Run:
    """Text in one place: the number of its block, whether it is set aside, and its features."""

    block: int
    text: str
    aside: bool
    inside: bool
    features: tuple[str, ...]


@dataclass(slots=True)
class Open:
    """An open element and what follows from it and those around it for the text in it."""

    name: str
    asides: int  # elements around the text that set it aside, without headers of articles
    headers: int  # headers of articles around it
    firm: int  # those of the asides that are no wrappers
    inside: bool  # in an article
    link: bool
    block_at: int  # place of the innermost block among the open elements, -1 if there is none
    wrapper: int  # number of the wrapper that this element is, -1 if it is none


OUTERMOST = Open("", 0, 0, 0, False, False, -1, -1)


@dataclass
class Layout:
    """What one scan says of a whole page: whether an article stands outside of all that is set aside, and the wrappers around
    the others. A wrapper is a form, or an element that a hint sets aside, but for firm hints."""

    content: bool = False
    around: set[int] = field(default_factory=set)


def hints_of(name: str, attributes: str) -> frozenset[str]:
    """The hints in an element's classes, id and role."""
    if name in ("html", "body") or "=" not in attributes:
        return frozenset()
    found, content = set(), False
    for attribute in _ATTRIBUTE.finditer(attributes):
        if attribute[1].lower() in ("class", "id", "role"):
            for value in attribute[2].strip("\"'").lower().split():
                words = _HINT_WORD.findall(value)
                content = content or value in CONTENT_WORDS
                if LAYOUT_WORDS.isdisjoint(words):
                    found.update(words)
    firm = found & FIRM_HINTS
    if firm or content:
        return frozenset(firm)
    return frozenset(found & (HINTS - {"header"} if name in HEADINGS else HINTS))


def tokens(html: str, layout: Layout, opened: frozenset[int] = frozenset()) -> Iterator[Run | str]:
    """Runs of text, and between them the names of block tags (with a slash where they end).

    Fills ``layout``. The wrappers numbered in ``opened`` set nothing aside.
    """
    open_: list[Open] = []
    places: dict[str, list[int]] = {}  # of the open elements, by name
    wrappers: list[int] = []  # numbers of the open ones
    block, raw, count = 0, None, 0
    at, size = 0, len(html)

    def run(text: str) -> Run:
        top = open_[-1] if open_ else OUTERMOST
        aside = top.asides > 0 or top.headers > 0 and not (top.block_at >= 0 and open_[top.block_at].name in HEADINGS)
        leaf = open_[top.block_at].name if top.block_at >= 0 else "none"
        return Run(block, text, aside, top.inside, (f"block {leaf}", f"link {top.link}"))

    def close(place: int) -> None:
        while len(open_) > place:
            element = open_.pop()
            places[element.name].pop()
            if element.wrapper >= 0:
                wrappers.pop()

    while at < size:
        if raw is not None:
            end = re.compile(rf"</{raw}\b", re.I).search(html, at)
            at = end.start() if end else size
            raw = None
            continue
        match = _TOKEN.match(html, at)
        at = match.end()
        name = match[2]
        if name is None:
            if not match[0].startswith(("<!", "<?")):
                yield run(match[0])
            continue
        name = name.lower()
        if match[1]:
            if places.get(name):
                close(places[name][-1])
        else:
            while open_ and name in ENDS.get(open_[-1].name, ()):
                close(len(open_) - 1)
            if name in ("p", "li", "tr") and open_:  # inline elements left open don't keep a block open
                inner = open_[-1].block_at
                if inner >= 0 and open_[inner].name == name:
                    close(inner)
            top = open_[-1] if open_ else OUTERMOST
            hints = hints_of(name, match[3])
            header = name == "header" and not hints and top.inside and places.get("article")
            firm = not header and (name in ASIDE and name != "form" or not hints.isdisjoint(FIRM_HINTS))
            wrapper = -1
            if not firm and (hints or name == "form"):
                wrapper, count = count, count + 1
            if name in CONTENT and not hints or name == "nav" and "form" in places:
                if name != "nav" and not top.asides:
                    layout.content = True
                elif not top.firm:
                    for number in reversed(wrappers):
                        if number in layout.around:
                            break
                        layout.around.add(number)
            if name not in VOID and not match[3].rstrip().endswith("/"):
                aside = firm or wrapper >= 0 and wrapper not in opened
                places.setdefault(name, []).append(len(open_))
                if wrapper >= 0:
                    wrappers.append(wrapper)
                open_.append(
                    Open(
                        name,
                        top.asides + aside,
                        top.headers + bool(header),
                        top.firm + firm,
                        top.inside or name in CONTENT and not hints,
                        top.link or name == "a",
                        len(open_) if name in BLOCKS else top.block_at,
                        wrapper,
                    )
                )
                if name in RAW:
                    raw = name
        if name in BLOCKS:
            block += 1
            yield "/" + name if match[1] else name


def scanned(html: str) -> tuple[list[Run | str], bool]:
    """The tokens of a page, and whether it has an article. Wrappers around a page's only articles are opened."""
    layout = Layout()
    items = list(tokens(html, layout))
    if not layout.content and layout.around:
        opened, layout = frozenset(layout.around), Layout()
        items = list(tokens(html, layout, opened))
    return items, layout.content


# ---------------------------------------------------------------- scores

# Shares in and outside of articles that every feature starts with, the share that keeps rare ones near zero, and how far each
# kind may move a word: where a word stands weighs more than its block and links together. Fixed values.
PRIOR = {"section content": (1.0, 0.0), "section none": (0.0, 1.0), "block p": (0.1, 0.02), "block li": (0.01, 0.05), "link False": (0.1, 0.05), "link True": (0.0, 0.3)}
RARE = 0.01
LIMITS = {"section": 3.0, "block": 1.0, "link": 1.0, "tag": 3.0}
LIMIT = 3.0
ASIDE_WORD = -2.0
INNER_ASIDE_WORD = -0.001
TAG_LIMIT = (-0.2, -0.01)


@dataclass
class Scores:
    """Log-odds of words' features and of tags."""

    odds: dict[str, float]

    def word(self, run: Run, content: bool) -> float:
        """Of one word of a run. In a page without an article it does not matter where the run stands."""
        if run.aside:
            return INNER_ASIDE_WORD if run.inside else ASIDE_WORD
        section = self.odds.get(section_of(run), 0.0) if content else 0.0
        return max(-LIMIT, min(LIMIT, section + sum(self.odds.get(f, 0.0) for f in run.features)))

    def tag(self, name: str) -> float:
        low, high = TAG_LIMIT
        return max(low, min(high, 0.05 * self.odds.get(f"tag {name}", 0.0) - 0.05))


def section_of(run: Run) -> str:
    return "section content" if run.inside else "section none"


def scores_of(counts: dict[str, tuple[int, int]]) -> Scores:
    """Log-odds of a feature's share of what is inside and outside of articles, each kind of feature by itself."""
    totals: dict[str, list[int]] = {}
    for feature, (a, b) in counts.items():
        total = totals.setdefault(feature.split()[0], [0, 0])
        total[0] += a
        total[1] += b
    odds = {}
    for feature in {*counts, *PRIOR}:
        kind = feature.split()[0]
        parts = zip(counts.get(feature, (0, 0)), totals.get(kind, (0, 0)), PRIOR.get(feature, (0.0, 0.0)), strict=True)
        inside, outside = (RARE + prior + n / max(total, 1) for n, total, prior in parts)
        odds[feature] = max(-LIMITS[kind], min(LIMITS[kind], log(inside) - log(outside)))
    return Scores(odds)


def labelled_counts(html: str) -> Counter | None:
    """Words that no list sets aside and tags, by feature, in and outside of the article; None if the page doesn't say where that is."""
    found, inside = Counter(), False
    items, content = scanned(html)
    if not content:
        return None
    for token in items:
        if isinstance(token, str):
            if token.lstrip("/") in CONTENT:
                inside = not token.startswith("/")
            found[f"tag {token}", inside] += 1
        elif not token.aside and (words := len(token.text.split())):
            for feature in (section_of(token), *token.features):
                found[feature, token.inside] += words
    return found


def fitted_scores(pages: DataFrame, html_col: str = "html") -> Scores:
    """Counted over all labelled pages. The features are the names in the lists above, so few rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for html in batch.column(0):
                total.update(labelled_counts(html.as_py() or "") or {})
        if total:
            keys = list(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array([total[k] for k in keys], pa.int64())], ["feature", "inside", "n"]
            )

    counted = pages.select(html_col).mapInArrow(run, "feature string, inside boolean, n long")
    counts: dict[str, list[int]] = {}
    for row in counted.groupBy("feature", "inside").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(row.feature, [0, 0])[0 if row.inside else 1] = row.n
    return scores_of({f: (a, b) for f, (a, b) in counts.items()})


# ---------------------------------------------------------------- extraction


def best_run(values: list[float]) -> tuple[int, int]:
    """First and last + 1 of the run with the greatest sum; the first and shortest of equals. Empty if none is above zero."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, value in enumerate(values):
        if total <= 0:
            total, start = 0.0, i
        total += value
        if total > best:
            best, span = total, (start, i + 1)
    return span


def main_text(html: str | None, scores: Scores) -> str:
    items, content = scanned(html or "")
    runs = [None if isinstance(item, str) else unescape(item.text) for item in items]
    values = [scores.tag(item) if text is None else scores.word(item, content) * len(text.split()) for item, text in zip(items, runs, strict=True)]
    first, last = best_run(values)
    blocks: dict[int, list[str]] = {}
    for item, text in zip(items[first:last], runs[first:last], strict=True):
        if text is not None and not item.aside:
            blocks.setdefault(item.block, []).append(text)
    texts = (" ".join("".join(parts).split()) for parts in blocks.values())
    return " ".join(text for text in texts if text)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: ``page_id, url, text, n_chars``."""
    scores = fitted_scores(pages, html_col)
    shared = pages.sparkSession.sparkContext.broadcast(scores)
    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = T.StructType([narrow.schema["page_id"], narrow.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py(), shared.value) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names
            )

    return narrow.mapInArrow(run, schema)
