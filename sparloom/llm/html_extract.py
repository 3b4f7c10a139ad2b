"""HTML main-text extraction by a maximum-scoring subsequence.

A page is a sequence of words and tags, each with a score, and the contiguous run
with the greatest sum is the content region; one linear scan finds it.

Scores come from labelled pages (see page_layouts).  A tag's score is
negative: its log-odds of standing in content, at most nought.  A word's score is the
log-odds that a logistic regression, fitted on the labelled pages' blocks, gives its
block: words in content score positive, words in menus, adverts, notices, forms and
comments negative.  It weighs the elements around the block, their class and id words
(those the labelled pages don't know all count as one), whether it stands in an
article or main element of the page, before the first heading, in links, its length,
whether it ends a sentence, and what share of the page its holder has.  No name excludes anything by itself.

An article may hold foreign elements (an advert between two paragraphs).  The run
bridges them where both sides are worth it; an element of the region whose
words sum below nought is then left out.

Text: character references are decoded, white space within a block becomes one
space, blocks are joined by one space in page order; inline tags add nothing.

Defined cases: null and empty pages, and pages without content, give an empty
text; unclosed or crossed tags close with the element around them; a cut-off
page ends where it is cut; repeated rows are extracted again; nothing is capped.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .page_layouts import labelled_pages

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|svg|iframe|select|button)\b.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|<[a-zA-Z/][^<>]*\Z",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end when another of them begins.
LOOSE = frozenset("p li dt dd tr td th option b i em strong".split())
ROOTS = frozenset(("article", "main"))
#: Elements that hold blocks.
HOLDERS = frozenset("article main section div body aside header footer nav form td".split())
NEUTRAL = frozenset("section div body td".split())
#: Elements whose class says nothing about their words.
WHOLE = ROOTS | {"html", "body"}
#: Labelled pages; pages that must show a class or id word for it to count; ridge of the regression.
PAGES, LEAST, RIDGE = 2000, 5, 0.3


class Element:
    """An element as its words see it; ``keys`` are the features it and those around it give."""

    __slots__ = ("keys", "linked", "name", "number", "open", "rooted", "up")

    def __init__(self, name: str, names, up: Element | None, number: int):
        self.name, self.up, self.number = name, up, number
        self.rooted = name in ROOTS or bool(up and up.rooted)
        self.linked = name == "a" or bool(up and up.linked)
        own = set()
        if name not in INLINE and name not in WHOLE:
            own.add(f"in {name}{'@' * bool(up and up.rooted)}")
        if name not in WHOLE:
            own |= {f".{x}" for x in names}
        self.keys = up.keys if up and own <= up.keys else frozenset(own) | (up.keys if up else frozenset())
        self.open = up.open if up and name in up.open else frozenset([name]) | (up.open if up else frozenset())


def tokens(page: str):
    """('text', words as written) and (open, close or raw, element, its class and id words)."""
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", page[at : m.start()], ()
        at = m.end()
        if m[3]:
            names = ()
            if m[4] and not m[2]:
                names = tuple({w for x in _NAMES.finditer(m[4]) for w in _SPLIT.split((x[1] or x[2] or x[3] or "").lower()) if w})
            yield ("close" if m[2] else "open"), m[3].lower(), names
        elif m[1]:
            yield "raw", m[1].lower(), ()
        # comments and declarations say nothing
    if at < len(page):
        yield "text", page[at:], ()


class Page:
    """Pieces of a page in order: text with its element and block, or a tag."""

    def __init__(self, page: str):
        self.pieces: list[tuple[str, str, Element | None, int]] = []  # kind, text or tag, element, block
        self.blocks: list[list[int]] = []  # pieces of each block
        self.roots = self.headings = self.paragraphs = 0
        self.heading = math.inf  # piece of the first heading
        here: Element | None = None
        block, number = -1, 0
        for kind, what, names in tokens(page):
            if kind == "text":
                if block < 0:
                    block = len(self.blocks)
                    self.blocks.append([])
                self.blocks[block].append(len(self.pieces))
                self.pieces.append(("text", what, here, block))
                continue
            if what not in INLINE:
                block = -1
            number += 1
            if kind == "open" and what not in VOID:
                if what in ROOTS:  # content may begin although something before was not closed
                    here = None
                elif what in LOOSE and here and here.name == what:
                    here = here.up
                here = Element(what, names, here, number)
                self.roots += what in ROOTS
                self.paragraphs += what == "p"
                if what == "h1":
                    self.heading = min(self.heading, len(self.pieces))
            elif kind == "close":
                here = self._close(here, what)
            self.pieces.append((kind, what, here, -1))

    @staticmethod
    def _close(here: Element | None, name: str) -> Element | None:
        x = here if here and name in here.open else None
        while x:
            if x.name == name:
                return x.up
            if x.name not in LOOSE and x.name not in INLINE and name in INLINE:
                return here
            x = x.up
        return here

    def _holder(self, block: list[int]) -> tuple[int, bool]:
        """Number of the element that holds a block and its neighbours (0: the page), and whether it says nothing by itself."""
        x = self.pieces[block[0]][2]
        while x and x.name not in HOLDERS:
            x = x.up
        return (x.number, x.name in NEUTRAL) if x else (0, True)

    def features(self, words: list[int]) -> list[set[str] | None]:
        """What the model knows of each block, given the words of each piece; None for one without words."""
        total = [sum(words[k] for k in block) for block in self.blocks]
        holders = [self._holder(block) for block in self.blocks]
        held: Counter = Counter()
        for h, n in zip(holders, total):
            held[h] += n
        return [self._features(block, words, n, held[h] / sum(total) if h[1] else None) if n else None for block, n, h in zip(self.blocks, total, holders)]

    def _features(self, block: list[int], words: list[int], total: int, share: float | None) -> set[str]:
        first = next(self.pieces[k][2] for k in block if words[k])
        found = set(first.keys) if first else set()
        holder = first
        while holder and holder.name in INLINE:
            holder = holder.up
        found.add(f"by {holder.name if holder else 'none'}")
        found.add("root" if first and first.rooted else "outside" if self.roots else "no root")
        if not (first and first.rooted):
            if block[0] < self.heading < math.inf:
                found.add("before heading")
            if not self.roots and share is not None:
                found.add("most" if share > 0.5 else "much" if share > 0.2 else "little")
                if self.paragraphs and (not holder or holder.name in ("div", "section", "body")):
                    found.add("bare")
        found.add("long" if total >= 20 else "short" if total < 6 else "middling")
        linked = sum(words[k] for k in block if self.pieces[k][2] and self.pieces[k][2].linked)
        if 2 * linked > total:
            found.add("links@" if first and first.rooted else "links")
        if self.pieces[block[-1]][1].rstrip()[-1:] in (".", "!", "?"):
            found.add("stop")
        return found


class Model:
    """Log-odds of blocks, and scores of tags."""

    def __init__(self, many: int = PAGES):
        rows, truth, inside, outside, named = [], [], Counter(), Counter(), Counter()
        for text in labelled_pages(many):
            page = Page(text)
            named.update({f for x in page.pieces if x[2] for f in x[2].keys if f[0] == "."})
            marks = {k for k, x in enumerate(page.pieces) if x[0] == "text" and "{{" in x[1]}
            page.pieces = [(kind, what.replace("{{", "").replace("}}", ""), *rest) for kind, what, *rest in page.pieces]
            for block, found in zip(page.blocks, page.features([len(x[1].split()) if x[0] == "text" else 0 for x in page.pieces])):
                if found is not None:
                    rows.append(found)
                    truth.append(any(k in marks for k in block))
            for k, (kind, what, _, _) in enumerate(page.pieces):
                if kind != "text":
                    (inside if marks and min(marks) < k < max(marks) else outside)["/" * (kind == "close") + what] += 1
        self.tags = {}
        for tag in inside.keys() | outside.keys():
            odds = math.log((inside[tag] + 0.5) / (outside[tag] + 0.5))
            self.tags[tag] = -0.1 - math.log1p(math.exp(-odds)) / 4
        self.known = {f: k for k, f in enumerate(sorted(f for f in set().union(*rows) if f[0] != "." or named[f] >= LEAST))}
        size = len(self.known)
        x = np.zeros((len(rows), size + 2))
        for k, found in enumerate(rows):
            at, unknown = self._at(found)
            x[k, at], x[k, size], x[k, size + 1] = 1, unknown, 1
        y, w = np.array(truth, float), np.zeros(size + 2)
        ridge = np.full(size + 2, RIDGE)
        ridge[-1] = 1e-6
        for _ in range(12):  # Newton steps
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
            w += np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        self.weights, self.unknown, self.bias = w[:size].tolist(), float(w[size]), float(w[size + 1])

    def _at(self, found: set[str]) -> tuple[list[int], int]:
        """Known features, and whether there is a class or id word that isn't."""
        at = [self.known[f] for f in found if f in self.known]
        return at, int(any(f[0] == "." and f not in self.known for f in found))

    def word(self, found: set[str]) -> float:
        at, unknown = self._at(found)
        return max(-8.0, min(8.0, self.bias + unknown * self.unknown + sum(self.weights[k] for k in at)))

    def tag(self, kind: str, what: str) -> float:
        return self.tags.get("/" * (kind == "close") + what, -0.5)


@cache
def model() -> Model:
    return Model()


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run [a, b) of greatest sum, (0, 0) if none is above nought."""
    best = total = 0.0
    start = a = b = 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, a, b = total, start, i + 1
    return a, b


def scored(page: Page, known: Model) -> tuple[list[str], list[float]]:
    """(decoded text or "" of each piece, score of each piece)."""
    texts = [html.unescape(x[1]) if x[0] == "text" else "" for x in page.pieces]
    words = [len(x.split()) for x in texts]
    scores = [0.0 if x[0] == "text" else known.tag(x[0], x[1]) for x in page.pieces]
    for block, found in zip(page.blocks, page.features(words)):
        if found is not None:
            each = known.word(found)
            for k in block:
                scores[k] = each * words[k]
    return texts, scores


def foreign(pieces, scores: list[float]) -> set[int]:
    """Numbers of the elements of a region whose words sum below nought, and of those inside them."""
    sums: Counter[int] = Counter()
    elements: dict[int, Element] = {}
    for (_, _, x, _), score in zip(pieces, scores):
        if x:
            sums[x.number] += score
        while x and x.number not in elements:
            elements[x.number] = x
            x = x.up
    for number in sorted(elements, reverse=True):  # children before parents
        if up := elements[number].up:
            sums[up.number] += sums[number]
    out: set[int] = set()
    for number in sorted(elements):
        if sums[number] < 0 or elements[number].up and elements[number].up.number in out:
            out.add(number)
    return out


def extract(text: str | None, known: Model | None = None, whole: bool = False) -> str:
    """The main text of one page; ``whole`` keeps foreign elements inside the region."""
    if not text:
        return ""
    page = Page(text)
    texts, scores = scored(page, known or model())
    a, b = best_run(scores)
    pieces = page.pieces[a:b]
    said = [0.0 if x[0] != "text" else s for x, s in zip(pieces, scores[a:b])]
    gone = set() if whole else foreign(pieces, said)
    out = []
    for (kind, what, x, _), own in zip(pieces, texts[a:b]):
        if kind == "text":
            out.append(" " if x and x.number in gone else own)
        else:
            out.append("" if what in INLINE else " ")
    return " ".join("".join(out).split())


def extract_pages(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """All columns of ``pages`` and the extracted text in ``out`` (a fresh name where it is taken)."""
    body, made = c.fresh(pages.columns, "_html"), c.fresh(pages.columns, out)
    n, known = len(pages.columns), model()

    def run(batches):
        for batch in batches:
            text = [extract(x.as_py(), known) for x in batch.column(n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(text, pa.string())], names=[*batch.schema.names[:n], made])

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema), f"`{made}` string"])
    return pages.withColumn(body, F.col(html_col).cast("string")).mapInArrow(run, kinds)


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = c.read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_pages(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
