"""HTML extraction: the main text of raw pages.

A page becomes a flat list of text blocks; block-level tags part them, inline tags do not. Each
block has its word count and link density, those of the blocks before and after it, whether it is a
heading, and what kind of element holds it. A decision tree, grown by Gini impurity on the labelled
table below, keeps or drops each block. Pages are parsed inside tasks and never shuffled.

Markup may be broken: tags that are never closed end with the element around them, a stray end tag
is ignored, a page may stop anywhere (inside a tag, a comment or a script too), and ``<`` before
anything but a name, ``/``, ``!`` or ``?`` is text. Only raw elements (scripts and the like) run to
their end tag or the page's end. A silent element (a button, say) that is not closed within the element
around it ends at the next tag of a block, and a head at the body or its first such tag.

A form is no part of the article, unless it holds most of the page's words: then it is a wrapper, and
its content is judged as if the form were not there.

Edge cases: a null, empty or blank page, and one without main text, gives an empty text; pages of
any length are parsed whole in one pass; repeated rows are extracted alike; an empty table gives no
rows. All columns of the pages pass through, and the added names avoid theirs."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from terracheck.llm.common import fresh_name, read_table
from terracheck.llm.registry import register

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)", re.S
)
_HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_BREAK = re.compile(r"[\s]+")
#: Elements whose content is never text of the page.
SILENT = frozenset("script style noscript template svg math head title select option button textarea iframe object canvas audio video map datalist".split())
RAW = frozenset("script style textarea title iframe".split())
#: Tags that end a silent element that is never closed.
FLOW = frozenset(
    "body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements, and words of class, id and role, that hold what is not the article.
ASIDE_TAGS = frozenset("nav footer aside menu dialog header".split())
ASIDE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement sponsor sponsored promo promotion sidebar menu nav navigation navbar breadcrumb breadcrumbs footer header masthead banner "
    "cookie cookies consent gdpr notice notices alert comment comments disqus respond replies reply related recommended share sharing social newsletter subscribe signup login popup "
    "modal overlay widget toolbar pagination pager copyright legal disclaimer contentinfo complementary search tags".split()
)
MAIN_TAGS = frozenset("article main".split())
MAIN_WORDS = frozenset("article articlebody main content post entry story".split())

FEATURES = ("held", "page_has_main", "heading", "words", "links", "words_before", "links_before", "words_after", "links_after")
#: What an open cell of the labelled table stands for: short, medium and long blocks, few and many links.
OPEN = {"page_has_main": (0, 1), "heading": (0, 1), "words": (2, 9, 25, 80), "links": (0.0, 0.3, 0.9)}
OPEN |= {f"{c}_{side}": OPEN[c] for c in ("words", "links") for side in ("before", "after")}
_ = None
#: The labelled table: held by (-1 aside, 0 neither, 1 article), does the page have an article
#: element, heading, words and link density of the block, of the one before, of the one after; label.
LABELLED = (
    (-1, _, _, _, _, _, _, _, _, 0),  # whatever stands in a menu, footer, advert, form or comment
    (1, _, _, _, 0.0, _, _, _, _, 1), (1, _, _, _, 0.3, _, _, _, _, 1), (1, _, _, _, 0.9, _, _, _, _, 0),  # in an article all but lists of links
    (0, 1, _, _, _, _, _, _, _, 0),  # outside the article of a page that has one
    (0, 0, _, 80, 0.0, _, _, _, _, 1), (0, 0, _, 80, 0.3, _, _, _, _, 1), (0, 0, 0, 25, 0.0, _, _, _, _, 1), (0, 0, 0, 25, 0.3, _, _, _, _, 1),
    (0, 0, _, _, 0.9, _, _, _, _, 0), (0, 0, 0, 2, 0.3, _, _, _, _, 0), (0, 0, 0, 9, 0.3, _, _, _, _, 0),
    # short blocks are text between texts only, and headings before a text
    (0, 0, 0, 2, 0.0, 25, 0.0, 25, 0.0, 1), (0, 0, 0, 2, 0.0, 80, 0.0, 80, 0.0, 1), (0, 0, 0, 9, 0.0, 25, 0.0, 80, 0.0, 1), (0, 0, 0, 9, 0.0, 80, 0.0, 25, 0.0, 1),
    (0, 0, 0, 9, 0.0, 2, _, _, _, 0), (0, 0, 0, 9, 0.0, 9, _, _, _, 0), (0, 0, 0, 2, 0.0, 2, _, _, _, 0), (0, 0, 0, 2, 0.0, 9, _, _, _, 0),
    (0, 0, 0, 9, 0.0, _, _, 2, _, 0), (0, 0, 0, 9, 0.0, _, _, 9, _, 0), (0, 0, 0, 2, 0.0, _, _, 2, _, 0), (0, 0, 0, 2, 0.0, _, _, 9, _, 0),
    (0, 0, 1, 2, 0.0, _, _, 25, 0.0, 1), (0, 0, 1, 9, 0.0, _, _, 25, 0.0, 1), (0, 0, 1, 2, 0.0, _, _, 80, 0.0, 1), (0, 0, 1, 9, 0.0, _, _, 80, 0.0, 1),
    (0, 0, 1, 2, 0.0, _, _, 2, _, 0), (0, 0, 1, 9, 0.0, _, _, 2, _, 0), (0, 0, 1, 2, 0.0, _, _, 9, _, 0), (0, 0, 1, 9, 0.0, _, _, 9, _, 0),
)


class Tree:
    """A binary decision tree in arrays; a leaf has feature -1."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 12):
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []
        self._grow(x, y, depth)
        self.feature, self.cut, self.left, self.right, self.value = map(np.array, (self.feature, self.cut, self.left, self.right, self.value))

    @staticmethod
    def _split(x, y) -> tuple[float, int, float]:
        best = (np.inf, -1, 0.0)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                side = x[:, f] <= cut
                impurity = sum(s.sum() * p * (1 - p) for s in (side, ~side) for p in (y[s].mean(),))
                best = min(best, (round(float(impurity), 9), f, float(cut)))
        return best

    def _grow(self, x, y, depth) -> int:
        node = len(self.feature)
        for column, v in zip((self.feature, self.cut, self.left, self.right, self.value), (-1, 0.0, 0, 0, float(y.mean()))):
            column.append(v)
        impurity, f, cut = self._split(x, y) if depth and 0 < y.mean() < 1 else (np.inf, -1, 0.0)
        if f >= 0:
            side = x[:, f] <= cut
            self.feature[node], self.cut[node] = f, cut
            self.left[node] = self._grow(x[side], y[side], depth - 1)
            self.right[node] = self._grow(x[~side], y[~side], depth - 1)
        return node

    def keeps(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while (self.feature[node] >= 0).any():
            inner = self.feature[node] >= 0
            down = np.where(x[rows, np.maximum(self.feature[node], 0)] <= self.cut[node], self.left[node], self.right[node])
            node = np.where(inner, down, node)
        return self.value[node] > 0.5


def train(labelled=LABELLED) -> Tree:
    each = [OPEN[f] for f in FEATURES if f in OPEN]
    rows = [full for row in labelled for full in product(row[:1], *((c,) if c is not None else o for c, o in zip(row[1:-1], each)), row[-1:])]
    table = np.array(rows, dtype=float)
    return Tree(table[:, :-1], table[:, -1])


def _kind(tag: str, attributes: str, outer: int) -> int:
    """What an element makes of its content: -1 not the article, 1 the article, 0 neither."""
    if tag in MAIN_TAGS:
        return 1
    if tag in ASIDE_TAGS:
        # a header inside an article holds its title
        return outer if tag == "header" and outer == 1 else -1
    if attributes and tag not in ("html", "body"):
        words = {w for m in _HINT.finditer(attributes) for w in re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower())}
        aside, main = bool(words & ASIDE_WORDS), bool(words & MAIN_WORDS)
        if aside and not main:
            return -1
        if main and not aside and outer >= 0:
            return 1
    return outer


def tags(page: str) -> list[tuple[int, int, str, bool, str, int]]:
    """(start, end, name, end tag, attributes, closed by) of all markup in order. The name is empty for
    comments and tags cut off; raw elements are one entry with their content. A silent element is closed
    by the entry of that number, -1 if nothing closes it within the element around it."""
    out: list[list] = []
    opened: list[tuple[str, int]] = []
    silent: dict[str, int] = {}  # how many elements of a silent name are open
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        at = m.end()
        end, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag or not m[0].endswith(">"):
            out.append([m.start(), at, "", False, "", -1])
            continue
        tag = tag.lower()
        if tag in RAW and not end:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
        out.append([m.start(), at, tag, bool(end), attributes or "", -1])
        if tag in RAW or tag in VOID or tag in INLINE:
            continue
        if end:
            for k in range(len(opened) - 1, -1, -1):
                if opened[k][0] == tag:
                    out[opened[k][1]][5] = len(out) - 1
                    for name, _ in opened[k:]:
                        if name in SILENT:
                            silent[name] -= 1
                    del opened[k:]
                    break
        elif not (attributes or "").endswith("/"):
            # a body or a block ends a head, a button another button
            over = "head" if tag in FLOW else tag if tag in ("button", "select", "option") else ""
            if over and silent.get(over):
                k = max(k for k, o in enumerate(opened) if o[0] == over)
                del opened[k]
                silent[over] -= 1
            opened.append((tag, len(out) - 1))
            if tag in SILENT:
                silent[tag] = silent.get(tag, 0) + 1
    return [tuple(t) for t in out]


def blocks(page: str) -> list[tuple[str, int, int, bool]]:
    """(text, held by, words in links, heading) of every block of a page, in order."""
    out: list[tuple[str, int, int, bool, int]] = []
    stack: list[tuple[str, int, bool, bool, int]] = [("", 0, False, False, 0)]  # tag, kind, in a link, heading, form
    parts: list[tuple[str, bool]] = []
    at = forms = 0
    skip_to, mute = -1, ""  # the entry that closes a silent element; a silent element that nothing closes

    def flush() -> None:
        text = _BREAK.sub(" ", html.unescape("".join(p for p, _ in parts))).strip()
        if text:
            links = sum(len(html.unescape(p).split()) for p, link in parts if link)
            out.append((text, stack[-1][1], links, stack[-1][3], stack[-1][4]))
        parts.clear()

    for number, (begin, stop, tag, end, attributes, closed) in enumerate(tags(page)):
        if number <= skip_to:
            at = stop
            continue
        if begin > at and not mute:
            parts.append((page[at:begin], stack[-1][2]))
        at = stop
        if not tag:
            continue
        if mute and (tag in FLOW or tag == mute or (end and tag not in INLINE and tag not in SILENT)):
            mute = ""
        if tag in SILENT and not end:
            if tag not in RAW and not attributes.endswith("/"):
                skip_to = closed
                if closed < 0 and tag != "head":
                    flush()
                    mute = mute or tag
            flush()
            continue
        if tag == "br" or tag == "hr":
            parts.append((" ", False))
            continue
        if tag in INLINE and tag != "a":
            continue
        if tag in VOID:
            flush()
            continue
        if tag != "a":
            flush()
        if end:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag == "a":
            if stack[-1][0] == "a":
                stack.pop()
            stack.append(("a", stack[-1][1], True, *stack[-1][3:]))
            continue
        while stack[-1][0] in ("p", "a") or stack[-1][0] in HEADINGS or stack[-1][0] == tag == "li":
            stack.pop()  # a block ends a paragraph, a heading or a link that was never closed
        if not attributes.endswith("/"):
            form = stack[-1][4]
            if tag == "form" and not form:
                forms = form = forms + 1
            if tag in MAIN_TAGS:
                form = 0
            stack.append((tag, _kind(tag, attributes, stack[-1][1]), False, stack[-1][3] or tag in HEADINGS, form))
    if at < len(page) and not mute:
        parts.append((page[at:], stack[-1][2]))
    flush()
    if not forms:
        return [b[:4] for b in out]
    words = [0] * (forms + 1)
    for text, kind, _, _, form in out:
        words[form] += len(text.split()) if kind >= 0 else 0
    wraps = [2 * w > sum(words) for w in words]
    return [(text, kind if not form or wraps[form] else -1, links, heading) for text, kind, links, heading, form in out]


def _features(found: list[tuple[str, int, int, bool]]) -> np.ndarray:
    n = len(found)
    words = np.array([len(t.split()) for t, *_ in found], dtype=float)
    links = np.array([x[2] for x in found], dtype=float) / np.maximum(words, 1)
    held = np.array([x[1] for x in found], dtype=float)
    table = np.zeros((n, len(FEATURES)))
    table[:, 0], table[:, 1], table[:, 2], table[:, 3], table[:, 4] = held, (held == 1).any(), [x[3] for x in found], words, np.minimum(links, 1)
    table[1:, 5], table[1:, 6], table[:-1, 7], table[:-1, 8] = words[:-1], table[:-1, 4], words[1:], table[1:, 4]
    return table


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    return " ".join(b[0] for b, keep in zip(found, tree.keeps(_features(found))) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """All columns of ``pages`` with ``text`` and ``n_chars`` (fresh names where they are taken)."""
    names = [fresh_name(pages, "text"), fresh_name(pages, "n_chars")]
    schema = T.StructType([*pages.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.LongType())])
    html_at = [c.lower() for c in pages.columns].index("html")
    tree = train()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [main_text(page, tree) for page in part.column(html_at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return pages.mapInArrow(parse, schema)


@register("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
