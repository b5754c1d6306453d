"""Main text of web pages as the maximum-scoring run of words.

A page is a sequence of words and tags. Every word scores 1, a tag less than 0,
and one linear scan finds the contiguous stretch with the largest sum. What a tag costs
is learnt from labelled pages: those whose own markup says where the article is
(one ``article`` element, or else one ``main``), all of the corpus. A kind of
tag that stands inside articles costs next to nothing; one that stands around
them costs ``STEP`` words for every e-fold that it is rarer inside than
elsewhere, at most ``STEP * log(1 / LEAST)``. Names of content start with a
belief of 99 in 100 inside, others of one half.

Labelled pages also say which elements hold other matter (an advert, a menu):
names and words of class, id and role whose elements' words are mostly outside.
Their words score nothing and are left out wherever they stand, also in
the middle of an article; so are reader comments and the like by the words that
usually name them, which count as ``BELIEF`` words seen outside, until labelled
pages say otherwise. An element that holds the article is never one.

Counts are summed by Spark over all labelled pages; the model is the
``vocabulary`` most frequent names and words, a bounded number.

Edge cases: a null page counts as empty and has the empty text, as has a page
without words outside such elements; very long pages, unclosed tags and
unclosed quotes take linear time; repeated rows and null ids are handled each by
itself; without labelled pages the usual names decide; an empty table gives no
rows; further columns pass through (a made column that clashes gets an
underscore). White space is what Unicode calls so.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.llm.common import fresh

STEP, LEAST, BELIEF, LITTLE = 10.0, 0.01, 200, 0.05

#: Fixed values of HTML: elements by what they are, and the usual names of
#: matter beside an article.
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var wbr br input button select".split())
CONTENT = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption div section hr "
                    "details summary address".split()) | INLINE
ASIDE = frozenset("head nav header footer aside form button select option dialog menu svg math object canvas fieldset".split())
ASIDE_WORDS = frozenset("ad ads advert adverts advertisement advertising adslot sponsored sponsor promo promotion nav navbar navigation menu menubar "
                        "breadcrumb breadcrumbs header masthead footer sidebar aside widget notice notices cookie cookies consent gdpr banner alert "
                        "newsletter subscribe signup login search share sharing social related recommended popup modal comment comments disqus reply "
                        "replies respond pagination pager toolbar".split())
_WHOLE = frozenset("html body".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[A-Za-z][^>]*>?", re.DOTALL)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORDS = re.compile(r"[A-Za-z]+")
_RAW_ENDS = {name: re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE) for name in RAW}


@dataclass
class Element:
    name: str
    words: frozenset[str]  # of class, id and role
    start: int  # its first token
    end: int = 0  # past its last one


@dataclass
class Page:
    """``tokens``: (name, text): a tag's name (end tags with a slash), or None
    and a run of text. Elements in order of their starts."""

    tokens: list[tuple[str | None, str]] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)


def parse(html: str) -> Page:
    page = Page()
    tokens, open_, names, at = page.tokens, [], Counter(), 0

    def close() -> Element:
        e = open_.pop()
        names[e.name] -= 1
        e.end = len(tokens)
        return e

    while m := _TOKEN.search(html, at):
        if m.start() > at:
            tokens.append((None, html[at:m.start()]))
        at = m.end()
        if not (name := m["name"]):
            continue
        name = name.lower()
        if m["end"]:
            tokens.append(("/" + name, ""))
            if names[name]:
                while close().name != name:
                    pass
            continue
        if name in ("p", "li", "option") and open_ and open_[-1].name == name:
            close()
        rest = m["rest"]
        words = frozenset(w.lower() for x in _NAMED.findall(rest) for w in _WORDS.findall("".join(x))) if "=" in rest else frozenset()
        tokens.append((name, ""))
        if name in RAW:
            end = _RAW_ENDS[name].search(html, at)
            at = end.end() if end else len(html)
        elif name not in VOID and not rest.endswith("/"):
            e = Element(name, words, len(tokens) - 1)
            page.elements.append(e)
            open_.append(e)
            names[name] += 1
    if at < len(html):
        tokens.append((None, html[at:]))
    while open_:
        close()
    return page


def _features(e: Element) -> list[str]:
    """What may mark an element as other matter."""
    return [e.name, *(f".{w}" for w in e.words)] if e.name not in _WHOLE else []


def _belief(feature: str) -> tuple[int, int]:
    """Words thought to have been seen inside and outside articles."""
    beside = feature[1:] in ASIDE_WORDS if feature[0] == "." else feature in ASIDE
    return (0, BELIEF) if beside else (BELIEF, 0)


@dataclass(frozen=True)
class Model:
    """``words``: of a name or ``.word``, the words inside and outside labelled
    articles that such elements hold; ``tags``: of a name, its tags there."""

    words: dict[str, tuple[int, int]]
    tags: dict[str, tuple[int, int]]

    def beside(self, feature: str) -> bool:
        a, b = (x + y for x, y in zip(_belief(feature), self.words.get(feature, (0, 0)), strict=True))
        # Names of content (a list, a table) say nothing of where they stand.
        return a < b and feature not in CONTENT

    def cost(self, name: str) -> float:
        a, b = self.tags.get(name, (0, 0))
        a, b = (a + 99, b + 1) if name in CONTENT or name in RAW else (a + 1, b + 1)
        return LITTLE - STEP * log(max(LEAST, a / (a + b)))


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self._beside, self._cost = model, {}, {}

    def other(self, page: Page) -> list[bool]:
        """Per token, whether it belongs to other matter. What holds the first
        article (or main) element does not; nor does, unless its very name says
        so, what holds the first heading."""
        out, until = [False] * len(page.tokens), 0
        first: dict[str, int] = {}
        for e in page.elements:
            if e.name in ("article", "main", "h1"):
                first.setdefault(e.name, e.start)
        heading = first.pop("h1", -1)
        for e in page.elements:
            if e.start < until or any(e.start <= k < e.end for k in first.values()):
                continue
            named, *words = _features(e) or [""]
            if named and self.beside(named) or not e.start <= heading < e.end and any(map(self.beside, words)):
                out[e.start:e.end] = [True] * (e.end - e.start)
                until = e.end
        return out

    def beside(self, feature: str) -> bool:
        if feature not in self._beside:
            if len(self._beside) > 100_000:
                self._beside.clear()
            self._beside[feature] = self.model.beside(feature)
        return self._beside[feature]

    def scores(self, page: Page, other: list[bool]) -> list[float]:
        out = []
        for (name, text), aside in zip(page.tokens, other, strict=True):
            if name is None:
                out.append(0.0 if aside else float(len(text.split())))
            elif aside:
                out.append(0.0)
            else:
                key = name.lstrip("/")
                if key not in self._cost:
                    self._cost[key] = self.model.cost(key)
                out.append(-self._cost[key])
        return out

    def extract(self, html: str) -> str:
        page = parse(html)
        other = self.other(page)
        start, end = best_run(self.scores(page, other))
        return text_of(page.tokens[start:end], other[start:end])


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the stretch with the largest positive sum, the first
    and shortest of equals; (0, 0) if no sum is positive."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, found = total, (start, i + 1)
    return found


def text_of(tokens: list[tuple[str | None, str]], other: list[bool]) -> str:
    blocks, parts = [], []

    def end() -> None:
        if block := " ".join(unescape("".join(parts)).split()):
            blocks.append(block)
        parts.clear()

    for (name, text), aside in zip(tokens, other, strict=True):
        if name is None:
            if not aside:
                parts.append(text)
        elif name == "br":
            parts.append(" ")
        elif name.lstrip("/") not in INLINE and name.lstrip("/") not in RAW:
            end()
    end()
    return "\n\n".join(blocks)


def labelled(page: Page) -> Element | None:
    """The element that the page itself calls its article."""
    for name in ("article", "main"):
        found = [e for e in page.elements if e.name == name]
        if found:
            return found[0] if len(found) == 1 else None
    return None


def counts(page: Page) -> Iterator[tuple[str, str, int, int]]:
    """(words or tags, feature, inside, outside) of a labelled page."""
    if not (article := labelled(page)):
        return
    n_words = [0]
    for name, text in page.tokens:
        n_words.append(n_words[-1] + (len(text.split()) if name is None else 0))
    words: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    inside = lambda k: article.start < k < article.end - 1
    for e in page.elements:
        a, b = max(e.start, article.start), min(e.end, article.end)
        within = n_words[b] - n_words[a] if a < b else 0
        for f in _features(e):
            words[f][0] += within
            words[f][1] += n_words[e.end] - n_words[e.start] - within
    for f, (a, b) in words.items():
        yield "words", f, a, b
    beside = Scorer(Model({}, {})).other(page)  # what stands in other matter tells nothing
    tags: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for k, (name, _) in enumerate(page.tokens):
        if name is not None and not beside[k]:
            tags[name.lstrip("/")][not inside(k)] += 1
    for f, (a, b) in tags.items():
        yield "tags", f, a, b


def fit(pages: DataFrame, html: str = "html", vocabulary: int = 20_000) -> Model:
    """From all labelled pages of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summed: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0, 0])
        for b in batches:
            for t in b.column("html"):
                for kind, feature, inside, outside in counts(parse(t.as_py() or "")):
                    s = summed[kind, feature]
                    s[0], s[1], s[2] = s[0] + inside, s[1] + outside, s[2] + 1
                if len(summed) > 100_000:
                    yield batch(summed)
                    summed.clear()
        if summed:
            yield batch(summed)

    def batch(summed: dict) -> pa.RecordBatch:
        kinds, features = zip(*summed, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array(features), *(pa.array(x, pa.int64()) for x in zip(*summed.values(), strict=True))],
            names=["kind", "feature", "inside", "outside", "pages"])

    found = pages.select(F.col(f"`{html}`").alias("html")).mapInArrow(run, "kind string, feature string, inside long, outside long, pages long")
    found = found.groupBy("kind", "feature").agg(*(F.sum(c).alias(c) for c in ("inside", "outside", "pages")))
    words: dict[str, tuple[int, int]] = {}
    tags: dict[str, tuple[int, int]] = {}
    for r in found.orderBy(F.desc("pages"), "kind", "feature").limit(vocabulary).collect():
        (words if r["kind"] == "words" else tags)[r["feature"]] = (r["inside"], r["outside"])
    return Model(words, tags)


def extract(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, plus ``text`` and ``n_chars``, its code
    points."""
    rest = [f for f in pages.schema.fields if f.name != html]
    names = [f.name for f in rest]
    text, n_chars = (fresh(pages.drop(html), c) for c in ("text", "n_chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            for i in range(0, b.num_rows, 200):
                part = b.slice(i, 200)
                found = [scorer.extract(t.as_py() or "") for t in part.column(html)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                                                 names=[*names, text, n_chars])

    return pages.mapInArrow(run, T.StructType([*rest, T.StructField(text, T.StringType()), T.StructField(n_chars, T.LongType())]))
