"""Main text of web pages: flat text blocks classified by a small decision tree.

A page is cut into blocks at its block-level tags. A block is described by its number of
words and its link density, by those of the blocks before and after it, by whether it ends as
a sentence does and is a heading, and, as weaker hints, by what its elements say it stands in.
A decision tree over these numbers, trained on a small table of labelled blocks, says which
blocks are main text. Pages that name no part of theirs are decided by words, links and
neighbours alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element and attribute names of HTML, and words that pages use for parts that
# are not the article.
INLINE = frozenset(
    """a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark
    picture q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr""".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
UNSEEN = frozenset(
    """head script style noscript template svg math canvas iframe object select textarea button
    audio video map title datalist""".split()
)
RAW = frozenset("script style textarea title iframe noscript".split())
PARTS = frozenset("nav header footer aside form dialog menu fieldset".split())
BODIES = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)
PART_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo
    promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie
    cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe
    subscription signup login comment comments commentlist reply replies respond disqus
    discussion share sharing social related recommended widget toolbar search searchbox form
    copyright pagination pager skip banner""".split()
)
# Words that may stand beside them in a name, without naming a subject of their own.
PLAIN_WORDS = frozenset(
    """area author bar block body bottom box buttons container content group header icons inner
    item items left links list meta notice outer page panel post posts primary right secondary
    section site text thread title top unit wrap wrapper js is has""".split()
)
BODY_WORDS = frozenset("article post entry story content main maincontent body text".split())
# Elements whose end tag may be left out: the start of another of the group ends them.
CLOSERS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
SCOPES = frozenset("ul ol dl table div section article main nav aside header footer form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I
)
_WORD = re.compile(r"[^\W_]+")
_ENDS = frozenset(".!?…。！？")
NEUTRAL, BODY, PART = 0, 1, 2


@dataclass
class Block:
    text: str
    n_words: int
    link_density: float
    place: int  # NEUTRAL, BODY or PART: the nearest element that says so
    heading: bool
    in_body: bool  # anywhere inside an article or main element
    sentence: bool  # ends with a sign that ends sentences


def _names_part(value: str) -> bool:
    """Whether one of the names says advert, menu, comments and the like, and nothing else.

    "comment-list" does; "share-price", "form-factor" and "search-results" do not.
    """
    for name in value.split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if any(w in PART_WORDS for w in words) and all(
            w in PART_WORDS or w in PLAIN_WORDS for w in words
        ):
            return True
    return False


def _place(name: str, attributes: str, inside: int) -> int:
    """What an element says about the text in it."""
    if name in HEADINGS or name in ("body", "html"):
        return NEUTRAL
    if name in PARTS:
        # An article's own header holds its title.
        return NEUTRAL if name == "header" and inside == BODY else PART
    # An article among the comments is a comment.
    place = BODY if name in BODIES and inside != PART else NEUTRAL
    if "=" not in attributes:
        return place
    for found in _ATTRIBUTE.finditer(attributes):
        value = (found[2] or found[3] or found[4] or "").lower()
        if found[1].lower() == "role":
            if value in ROLES:
                return PART
            if value in ("main", "article") and inside != PART:
                place = BODY
            continue
        if _names_part(value):
            return PART
        if set(re.split(r"[^a-z]+", value)) & BODY_WORDS and inside != PART:
            place = BODY
    return place


def blocks(page: str) -> list[Block]:
    """Text blocks in page order. White space in a block is one space, ends trimmed."""
    found: list[Block] = []
    texts: list[str] = []  # of the block being read
    linked: list[bool] = []
    stack: list[tuple[str, int]] = []  # open block elements and the place they give
    links = 0
    place, heading = NEUTRAL, False

    def flush() -> None:
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            if text:
                n = len(text.split(" "))
                in_links = 0
                if any(linked):
                    parts = [t for t, x in zip(texts, linked, strict=True) if x]
                    in_links = len(html.unescape(" ".join(parts)).split())
                inside = any(p == BODY for _, p in stack)
                ends = text.rstrip("\"'”’»)")[-1:] in _ENDS
                found.append(Block(text, n, min(1.0, in_links / n), place, heading, inside, ends))
            texts.clear()
            linked.clear()

    def settle() -> None:
        nonlocal place, heading
        place = next((p for _, p in reversed(stack) if p != NEUTRAL), NEUTRAL)
        heading = any(name in HEADINGS for name, _ in stack)

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            texts.append(page[at:])
            linked.append(links > 0)
            break
        if token.start() > at:
            texts.append(page[at : token.start()])
            linked.append(links > 0)
        at = token.end()
        name = token[2] or token[5]
        if name is None:
            continue
        closing, name, attributes = bool(token[1] or token[4]), name.lower(), token[3] or token[6] or ""
        if name in UNSEEN:
            if closing:
                continue
            if not attributes.endswith("/") or name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                if end:
                    at = end.end()
                elif name == "head":
                    body = re.compile(r"<body\b", re.I).search(page, at)
                    at = body.start() if body else at
                elif name in RAW:
                    at = size
            if name not in ("button", "select"):
                flush()
            continue
        if name == "br":
            texts.append(" ")
            linked.append(False)
            continue
        if name == "a":
            links = max(0, links - 1) if closing else 1
        if name in INLINE:
            continue
        flush()
        if not closing and name in VOID:
            continue
        links = 0  # a link does not reach beyond its block
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                del stack[depth:]
        else:
            if stack and stack[-1][0] in ("p", *HEADINGS):
                stack.pop()
            ended = CLOSERS.get(name)
            if ended:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ended:
                        del stack[i:]
                        break
                    if stack[i][0] in SCOPES:
                        break
            settle()
            stack.append((name, _place(name, attributes, place)))
        settle()
    flush()
    return found


FEATURES = (
    "words", "link density", "words before", "link density before", "words after",
    "link density after", "sentence", "heading", "in a part", "in a body", "page has a body",
)
HINTS = 8  # the first feature that tells what elements say


def describe(found: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block."""
    has_body = float(any(b.in_body for b in found))
    own = [(min(b.n_words, 200), b.link_density) for b in found]
    edge = [(0, 0.0)]
    rows = [
        (*now, *before, *after, b.sentence, b.heading, b.place == PART, b.place == BODY, has_body)
        for b, now, before, after in zip(
            found, own, edge + own[:-1], own[1:] + edge, strict=True
        )
    ]
    return np.array(rows, float).reshape(-1, len(FEATURES))


# ---- the tree ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Nodes by number: feature (-1: a leaf), threshold, child if below, child else, label."""

    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    below: tuple[int, ...]
    above: tuple[int, ...]
    label: tuple[bool, ...]

    def predict(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        below, above = np.array(self.below), np.array(self.above)
        for _ in self.feature:
            at = feature[node]
            inner = at >= 0
            if not inner.any():
                break
            low = rows[np.arange(len(rows)), np.maximum(at, 0)] <= threshold[node]
            node = np.where(inner, np.where(low, below[node], above[node]), node)
        return np.array(self.label)[node]


def grow(
    rows: np.ndarray, labels: np.ndarray, least: int = 1, depth: int = 12, hint: float = 0.6
) -> Tree:
    """A binary tree by the largest drop of Gini impurity; ties go to the earlier feature.

    Features from HINTS on count for the share ``hint`` of what they gain, so that what a text
    is like comes before what its elements are called.
    """
    nodes: list[list] = []

    def impurity(part: np.ndarray) -> float:
        share = part.mean() if len(part) else 0.0
        return 2 * share * (1 - share) * len(part)

    def build(index: np.ndarray, left: int) -> int:
        number = len(nodes)
        nodes.append([-1, 0.0, -1, -1, bool(labels[index].mean() >= 0.5)])
        best = (1e-9, -1, 0.0)
        if left and len(index) >= 2 * least:
            for f in range(rows.shape[1]):
                values = np.unique(rows[index, f])
                for cut in (values[:-1] + values[1:]) / 2:
                    low = rows[index, f] <= cut
                    if min(low.sum(), (~low).sum()) < least:
                        continue
                    gain = impurity(labels[index]) - (
                        impurity(labels[index][low]) + impurity(labels[index][~low])
                    )
                    gain *= hint if f >= HINTS else 1.0
                    if gain > best[0] + 1e-9:
                        best = (gain, f, cut)
        if best[1] >= 0:
            low = rows[index, best[1]] <= best[2]
            nodes[number][:2] = [best[1], float(best[2])]
            nodes[number][2] = build(index[low], left - 1)
            nodes[number][3] = build(index[~low], left - 1)
        return number

    build(np.arange(len(rows)), depth)
    return Tree(*(tuple(column) for column in zip(*nodes, strict=True)))


# The labelled table: blocks as (words, link density, marks, main text), in page order, with
# a line or two for each page. Marks: a what is in an article, p in another named part, h a
# heading, s ends as a sentence.
LABELLED: tuple[tuple[tuple[int, float, str, int], ...], ...] = (
    # menu, title and text in an article, advert, footer
    ((6, 1.0, "p", 0), (9, 0.0, "ps", 0), (8, 0.0, "ahs", 1), (60, 0.0, "as", 1), (1, 0.0, "as", 1),
     (35, 0.1, "as", 1), (2, 0.0, "as", 1), (120, 0.0, "as", 1), (3, 0.0, "a", 1), (10, 0.0, "ps", 0)),
    ((1, 1.0, "p", 0), (1, 1.0, "p", 0), (1, 1.0, "p", 0), (40, 0.0, "ps", 0), (5, 0.0, "ah", 1),
     (44, 0.0, "as", 1), (3, 0.0, "a", 1), (4, 1.0, "a", 1), (16, 0.0, "as", 1), (12, 0.0, "ps", 0),
     (45, 0.0, "ps", 0), (3, 0.0, "ph", 0), (6, 0.3, "p", 0)),
    # comments below an article, as long as its text
    ((2, 0.0, "ah", 1), (70, 0.0, "as", 1), (90, 0.02, "as", 1), (2, 0.0, "ph", 0), (55, 0.0, "ps", 0),
     (80, 0.0, "ps", 0), (2, 1.0, "p", 0), (64, 0.05, "ps", 0), (3, 0.0, "p", 0)),
    # short article, long notices around it
    ((30, 0.1, "ps", 0), (80, 0.0, "ps", 0), (4, 0.0, "ah", 1), (7, 0.0, "as", 1), (70, 0.0, "ps", 0),
     (25, 0.2, "p", 0)),
    # text beside an article, unmarked
    ((2, 0.0, "", 0), (14, 0.0, "s", 0), (6, 0.0, "ah", 1), (90, 0.0, "as", 1), (12, 0.0, "as", 1),
     (20, 0.0, "s", 0), (33, 0.0, "s", 0)),
    ((30, 0.0, "s", 0), (2, 0.0, "a", 1), (8, 0.75, "a", 1), (1, 0.0, "as", 1), (40, 0.0, "s", 0),
     (25, 0.0, "s", 0)),
    # an article full of links, short lines and lists
    ((1, 1.0, "p", 0), (3, 0.0, "ah", 1), (5, 0.4, "a", 1), (1, 1.0, "a", 1), (2, 1.0, "a", 1),
     (3, 0.35, "a", 1), (30, 0.6, "as", 1), (1, 0.0, "a", 1), (6, 1.0, "a", 1), (12, 0.5, "as", 1),
     (1, 0.0, "a", 1), (2, 1.0, "a", 1), (9, 1.0, "p", 0), (20, 0.4, "as", 1), (4, 0.0, "", 0)),
    # no article element: menu, title, text, links to more of it
    ((1, 1.0, "", 0), (2, 1.0, "", 0), (2, 1.0, "", 0), (7, 0.0, "h", 1), (55, 0.0, "s", 1),
     (48, 0.05, "s", 1), (15, 0.0, "s", 1), (70, 0.0, "s", 1), (3, 1.0, "", 0), (4, 0.5, "", 0)),
    # a menu of plain words, title, text, line of rights
    ((1, 0.0, "", 0), (1, 0.0, "", 0), (2, 0.0, "", 0), (5, 0.0, "h", 1), (38, 0.0, "s", 1),
     (61, 0.0, "s", 1), (27, 0.04, "s", 1), (6, 0.0, "", 0)),
    ((1, 0.0, "", 0), (1, 0.0, "", 0), (1, 0.0, "", 0), (1, 0.0, "", 0)),
    ((2, 0.0, "", 0), (1, 0.0, "", 0), (3, 0.0, "", 0), (2, 0.0, "", 0), (42, 0.0, "s", 1),
     (88, 0.0, "s", 1), (8, 0.0, "s", 1), (51, 0.1, "s", 1), (5, 0.0, "", 0), (9, 0.0, "", 0)),
    # paragraphs of one sentence
    ((1, 0.0, "", 0), (1, 0.0, "", 0), (1, 0.0, "", 0), (5, 0.0, "h", 1), (19, 0.0, "s", 1),
     (21, 0.0, "s", 1), (17, 0.0, "s", 1), (4, 0.0, "", 0)),
    ((20, 0.0, "s", 1), (6, 0.0, "", 0), (18, 0.0, "s", 1), (3, 1.0, "", 0)),
    ((4, 0.0, "h", 1), (16, 0.0, "s", 1), (23, 0.05, "s", 1), (15, 0.0, "s", 1), (6, 0.0, "", 0)),
    # an advert between paragraphs, a list in the text
    ((6, 0.0, "h", 1), (45, 0.0, "s", 1), (7, 0.0, "", 0), (33, 0.0, "s", 1), (5, 0.6, "", 0),
     (52, 0.0, "s", 1), (9, 0.0, "s", 1), (12, 0.0, "s", 1), (40, 0.0, "s", 1), (7, 0.0, "", 0)),
    ((3, 1.0, "p", 0), (5, 0.0, "h", 1), (25, 0.0, "s", 1), (4, 0.0, "s", 1), (31, 0.0, "s", 1),
     (8, 0.0, "p", 0)),
    ((40, 0.0, "ps", 0), (6, 0.0, "h", 1), (50, 0.0, "s", 1), (75, 0.0, "ps", 0), (28, 0.0, "s", 1),
     (18, 0.0, "ps", 0), (26, 0.0, "ps", 0)),
    ((4, 0.8, "", 0), (6, 1.0, "", 0), (9, 0.7, "", 0), (40, 0.0, "s", 1), (65, 0.0, "s", 1),
     (5, 0.6, "", 0), (22, 0.9, "", 0), (18, 0.7, "s", 0), (24, 0.55, "", 0)),
    # headings of link lists, of a text
    ((3, 0.0, "h", 0), (2, 1.0, "", 0), (3, 1.0, "", 0), (4, 0.0, "h", 1), (36, 0.0, "s", 1),
     (3, 0.0, "h", 1), (58, 0.0, "s", 1), (2, 0.0, "h", 0), (5, 1.0, "", 0), (4, 1.0, "", 0)),
    # a page of one block
    ((45, 0.0, "s", 1),),
    ((45, 0.0, "", 1),),
    ((30, 0.0, "", 1),),
    ((20, 0.0, "s", 1),),
    ((18, 0.0, "s", 1),),
    ((2, 1.0, "", 0),),
    ((3, 0.0, "", 0),),
)


def labelled(page: tuple[tuple[int, float, str, int], ...]) -> list[Block]:
    return [
        Block("", n, density, BODY if "a" in marks else PART if "p" in marks else NEUTRAL,
              "h" in marks, "a" in marks, "s" in marks)
        for n, density, marks, _ in page
    ]


@cache
def trained() -> Tree:
    rows = np.concatenate([describe(labelled(page)) for page in LABELLED])
    return grow(rows, np.array([bool(line[-1]) for page in LABELLED for line in page]))


def main_text(page: str | None, tree: Tree | None = None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    kept = (tree or trained()).predict(describe(found))
    return "\n\n".join(b.text for b, keep in zip(found, kept, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    The text is empty if the page is null, empty, or holds no main text. Whole pages of any
    length are read, each alone; repeated rows give equal rows; other columns are not read.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.select("page_id", "url").schema}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained()
        for batch in batches:
            texts = [main_text(page, tree) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    columns = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return pages.select(F.col("page_id"), F.col("url"), F.col("html")).mapInArrow(read, columns)
