"""HTML extraction: flat text blocks classified by a decision tree.

A page is cut at block tags into flat text blocks. A block is described by its own and its neighbours'
word counts and link densities and by the kind of element around it; a small decision tree, grown here
from a labelled table, tells main text from the rest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is never text.
HIDDEN = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head", "title", "select", "textarea", "button", "canvas", "video", "audio"}
_RAW = {"script", "style", "textarea", "title", "iframe", "noscript"}
#: Elements around the text of a page that are not its article.
AROUND = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
MAIN = {"article", "main"}
#: Words in class, id or role that mark such a part.
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|nav\w*|menu|breadcrumbs?|footer|header|sidebar|widget|cookies?|consent|notice|popup|modal|newsletter|subscribe"
    r"|comments?|replies|reply|disqus|respond|related|share|sharing|social|login|signup|search|pagination|pager|complementary|contentinfo|navigation|dialog|alert)(?:$|[\s_-])"
)
#: Inline elements do not end a block; every other element does.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins", "kbd", "label", "mark", "q", "rp",
    "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements that end one of their own kind, and the elements up to which to look for it.
_ITEMS = (
    ({"li"}, {"ul", "ol", "menu"}),
    ({"dt", "dd"}, {"dl"}),
    ({"td", "th"}, {"tr", "table"}),
    ({"tr"}, {"table"}),
    ({"option"}, {"select"}),
)
_BLANK = re.compile(r"\s+")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "main", "around", "heading")
#: Labelled blocks in the order of ``FEATURES``, then 1 for main text.
LABELLED = (
    (60, 0.0, 40, 0.0, 55, 0.0, 1, 0, 0, 1), (4, 0.0, 0, 0.0, 60, 0.0, 1, 0, 1, 1), (2, 0.0, 30, 0.0, 3, 0.0, 1, 0, 0, 1), (12, 1.0, 30, 0.0, 40, 0.0, 1, 0, 0, 1),
    (3, 1.0, 2, 1.0, 2, 1.0, 1, 0, 0, 1), (150, 0.1, 9, 0.0, 3, 1.0, 1, 0, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1), (8, 0.0, 1, 1.0, 0, 0.0, 1, 0, 0, 1),
    (20, 0.0, 12, 0.0, 5, 0.0, 1, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0), (7, 0.0, 1, 1.0, 9, 0.0, 0, 1, 0, 0), (40, 0.0, 80, 0.0, 2, 1.0, 0, 1, 0, 0),
    (90, 0.0, 80, 0.0, 60, 0.0, 1, 1, 0, 0), (5, 0.5, 40, 0.0, 0, 0.0, 0, 1, 1, 0), (2, 0.0, 70, 0.0, 60, 0.0, 1, 1, 1, 0), (120, 0.0, 3, 0.0, 4, 0.0, 0, 1, 0, 0),
    (80, 0.0, 60, 0.0, 70, 0.0, 0, 0, 0, 1), (45, 0.05, 5, 0.0, 90, 0.0, 0, 0, 0, 1), (30, 0.0, 6, 0.0, 2, 1.0, 0, 0, 0, 1), (14, 0.0, 50, 0.0, 44, 0.0, 0, 0, 0, 1),
    (6, 0.0, 2, 1.0, 70, 0.0, 0, 0, 1, 1), (5, 0.0, 40, 0.0, 60, 0.0, 0, 0, 1, 1), (9, 0.0, 60, 0.0, 30, 0.0, 0, 0, 0, 1), (25, 0.2, 33, 0.0, 40, 0.1, 0, 0, 0, 1),
    (60, 0.0, 0, 0.0, 40, 0.0, 0, 0, 0, 1), (35, 0.0, 1, 1.0, 30, 0.0, 0, 0, 0, 1), (50, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (28, 0.1, 3, 1.0, 4, 0.0, 0, 0, 0, 1),
    (2, 1.0, 2, 1.0, 60, 0.0, 0, 0, 0, 0), (1, 1.0, 1, 1.0, 90, 0.0, 0, 0, 0, 0), (4, 1.0, 70, 0.0, 2, 1.0, 0, 0, 0, 0), (8, 0.7, 3, 1.0, 80, 0.0, 0, 0, 0, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (3, 1.0, 2, 1.0, 40, 0.0, 0, 0, 0, 0), (20, 0.9, 3, 1.0, 10, 0.8, 0, 0, 0, 0), (2, 0.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0),
    (4, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), (6, 0.0, 4, 1.0, 0, 0.0, 0, 0, 0, 0), (3, 0.0, 2, 0.0, 4, 0.0, 0, 0, 0, 0), (60, 0.8, 10, 1.0, 20, 0.9, 0, 0, 0, 0),
    (5, 0.0, 3, 1.0, 2, 0.5, 0, 0, 1, 0), (2, 1.0, 60, 0.0, 55, 0.0, 0, 0, 0, 0), (7, 0.6, 70, 0.0, 60, 0.0, 0, 0, 0, 0),
)


class Node(NamedTuple):
    """A leaf has no feature and answers with ``label``."""

    feature: int | None
    cut: float
    low: Node | None
    high: Node | None
    label: int


def grow_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> Node:
    """A decision tree by the smallest Gini impurity; cuts lie midway between values."""
    label = int(labels.mean() >= 0.5)
    if depth == 0 or len(set(labels.tolist())) == 1:
        return Node(None, 0.0, None, None, label)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= cut
            impurity = sum(part.sum() * 2 * labels[part].mean() * (1 - labels[part].mean()) for part in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, feature, float(cut), low
    if best is None:
        return Node(None, 0.0, None, None, label)
    _, feature, cut, low = best
    return Node(feature, cut, grow_tree(rows[low], labels[low], depth - 1), grow_tree(rows[~low], labels[~low], depth - 1), label)


_TABLE = np.array(LABELLED, float)
TREE = grow_tree(_TABLE[:, :-1], _TABLE[:, -1])


class Block(NamedTuple):
    text: str
    words: int
    links: float
    main: bool
    around: bool
    heading: bool


def text_blocks(page: str) -> list[Block]:
    """Flat text blocks of a page in order; unclosed and stray tags are tolerated."""
    blocks: list[Block] = []
    held: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # element, around, hidden
    around = hidden = main = anchors = 0
    heading = False

    def close_block() -> None:
        nonlocal held
        text = _BLANK.sub(" ", html.unescape("".join(t for t, _ in held))).strip() if held else ""
        if text:
            words = len(text.split())
            linked = sum(len(html.unescape(t).split()) for t, link in held if link)
            blocks.append(Block(text, words, min(1.0, linked / words), main > 0, around > 0, heading))
        held = []

    def pop(to: int) -> None:
        nonlocal around, hidden, main, anchors
        while len(stack) > to:
            name, was_around, was_hidden = stack.pop()
            around -= was_around
            hidden -= was_hidden
            main -= name in MAIN
            anchors -= name == "a"

    def close_implied(name: str) -> None:
        """An element ends an open paragraph; an item or cell ends an open one of its kind in the same list or table."""
        k = len(stack) - 1
        while k >= 0 and stack[k][0] in INLINE:
            k -= 1
        if k >= 0 and stack[k][0] == "p":
            pop(k)
        for kinds, inside in _ITEMS:
            if name in kinds:
                k = len(stack) - 1
                while k >= 0 and stack[k][0] not in inside and stack[k][0] not in kinds:
                    k -= 1
                if k >= 0 and stack[k][0] in kinds:
                    pop(k)

    at, end = 0, len(page)
    while at < end:
        open_at = page.find("<", at)
        if open_at < 0:
            open_at = end
        if open_at > at and not hidden:
            held.append((page[at:open_at], anchors > 0))
        if open_at == end:
            break
        token = _TOKEN.match(page, open_at)
        if token is None:
            if not hidden:
                held.append(("<", anchors > 0))
            at = open_at + 1
            continue
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        if name == "br":
            held.append((" ", False))
            continue
        if name not in INLINE:
            close_block()
            heading = not token[1] and len(name) == 2 and name[0] == "h" and name[1].isdigit()
        if token[1]:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if k is not None and not (name in INLINE and any(s[0] not in INLINE for s in stack[k + 1 :])):
                pop(k)
            continue
        if name in VOID or token[3].endswith("/"):
            continue
        if name not in INLINE:
            close_implied(name)
        marked = any(_MARKS.search((a[2] or a[3] or a[4] or "").lower()) for a in _ATTRIBUTE.finditer(token[3])) if "=" in token[3] and name not in ("html", "body") and name not in MAIN else False
        inside_main = name == "header" and main > 0  # an article's own head holds its title
        stack.append((name, (name in AROUND and not inside_main) or marked, name in HIDDEN))
        around, hidden, main, anchors = around + stack[-1][1], hidden + stack[-1][2], main + (name in MAIN), anchors + (name == "a")
        if name in _RAW:
            closing = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = closing.start() if closing else end
    close_block()
    return blocks


def is_main(tree: Node, features: tuple) -> bool:
    while tree.feature is not None:
        tree = tree.low if features[tree.feature] <= tree.cut else tree.high
    return bool(tree.label)


def main_text(page: str, tree: Node = TREE) -> str:
    """The main text: blocks the tree keeps, joined by line ends. A page with an article or main element has its text there."""
    blocks = text_blocks(page)
    kept = []
    for k, b in enumerate(blocks):
        before = blocks[k - 1] if k else Block("", 0, 0.0, False, False, False)
        after = blocks[k + 1] if k + 1 < len(blocks) else Block("", 0, 0.0, False, False, False)
        if is_main(tree, (b.words, b.links, before.words, before.links, after.words, after.links, b.main, b.around, b.heading)):
            kept.append(b)
    if any(b.main for b in kept):
        kept = [b for b in kept if b.main]
    return "\n".join(b.text for b in kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Null, empty and text-free pages have the empty text. Repeated rows get equal results; further columns
    are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page.as_py() or "") for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return given.mapInArrow(run, "page_id long, url string, text string, n_chars long")
