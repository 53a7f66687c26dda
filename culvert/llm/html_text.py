"""Main text of web pages from flat text blocks and a small decision tree.

A page is cut at block tags into a flat list of text blocks. Each block has its word count, its link density (share
of words inside links), the same two of the block before and after, and what encloses it (page furniture such as nav,
footer or a container named like an advert; an article). A CART tree, trained on the small labelled table ``LABELLED``
below, says which blocks are main text. Character references are decoded, white space inside a block becomes one
space, and the blocks kept are joined in page order by one space.

Defined cases: null or empty html has empty text; broken markup never fails (unknown closing tags are ignored, tags
left open close with their container, a tag that never ends is dropped with the rest); a page without any block kept
has empty text; equal pages have equal texts; pages are read whole; other columns are neither read nor changed.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm.common import ship, table

#: words, link density, words before, density before, words after, density after, furniture, article -> main text
LABELLED = [
    # article paragraphs, long and short
    ((80, .00, 12, .0, 90, .0, 0, 1), 1), ((45, .02, 80, .0, 60, .0, 0, 1), 1), ((3, .0, 60, .0, 70, .0, 0, 1), 1), ((1, .0, 40, .0, 30, .0, 0, 1), 1),
    ((12, .0, 6, 1., 80, .0, 0, 1), 1), ((9, .0, 6, .0, 40, .0, 0, 1), 1), ((25, .3, 50, .0, 50, .0, 0, 1), 1), ((2, .0, 100, .0, 8, .1, 0, 1), 1),
    ((30, .0, 30, .0, 0, .0, 0, 1), 1), ((200, .05, 0, .0, 0, .0, 0, 1), 1), ((6, .5, 40, .0, 40, .0, 0, 1), 1), ((1, .0, 1, .0, 1, .0, 0, 1), 1),
    ((15, 1., 60, .0, 60, .0, 0, 1), 1), ((4, 1., 30, .0, 30, .0, 0, 1), 1),
    ((2, .0, 1, 1., 1, 1., 0, 1), 1), ((5, .0, 0, .0, 1, .0, 0, 1), 1), ((3, .0, 2, .0, 4, .0, 0, 1), 1), ((8, .0, 3, 1., 2, 1., 0, 1), 1), ((1, .0, 3, .0, 3, 1., 0, 1), 1),
    ((7, .0, 0, .0, 0, .0, 0, 1), 1), ((16, .0, 4, .0, 1, 1., 0, 1), 1), ((2, .0, 5, .5, 12, .0, 0, 1), 1), ((10, .0, 1, .0, 8, 1., 0, 1), 1), ((19, .0, 2, .9, 3, .9, 0, 1), 1),
    # pages without an article element: text carried by its length and its neighbours
    ((60, .00, 50, .0, 70, .0, 0, 0), 1), ((40, .05, 3, .0, 45, .0, 0, 0), 1), ((120, .0, 4, 1., 90, .1, 0, 0), 1), ((18, .0, 60, .0, 55, .0, 0, 0), 1),
    ((9, .0, 70, .0, 80, .0, 0, 0), 1), ((35, .1, 0, .0, 5, .0, 0, 0), 1), ((22, .0, 40, .0, 3, 1., 0, 0), 1), ((14, .0, 33, .0, 41, .0, 0, 0), 1),
    ((3, .0, 60, .0, 70, .0, 0, 0), 1), ((1, .0, 45, .0, 55, .0, 0, 0), 1), ((5, .0, 40, .0, 25, .0, 0, 0), 1), ((7, .0, 1, 1., 60, .0, 0, 0), 1), ((6, .0, 0, .0, 48, .0, 0, 0), 1), ((2, .0, 90, .0, 30, .0, 0, 0), 1),
    # pages of one block
    ((2, .0, 0, .0, 0, .0, 0, 0), 1), ((1, .0, 0, .0, 0, .0, 0, 0), 1), ((5, .0, 0, .0, 0, .0, 0, 0), 1), ((12, .1, 0, .0, 0, .0, 0, 0), 1), ((30, .0, 0, .0, 0, .0, 0, 0), 1),
    ((1, 1., 0, .0, 0, .0, 0, 0), 0), ((4, 1., 0, .0, 0, .0, 0, 0), 0), ((6, .0, 0, .0, 0, .0, 1, 0), 0), ((40, .0, 0, .0, 0, .0, 1, 0), 0),
    # menus and link lists outside furniture containers
    ((1, 1., 1, 1., 1, 1., 0, 0), 0), ((2, 1., 3, 1., 2, 1., 0, 0), 0), ((5, 1., 2, 1., 60, .0, 0, 0), 0), ((8, .9, 30, .0, 4, 1., 0, 0), 0), ((12, .8, 5, 1., 9, .9, 0, 0), 0),
    ((20, .7, 10, .9, 10, .8, 0, 0), 0), ((3, .0, 2, 1., 4, 1., 0, 0), 0), ((2, .0, 0, .0, 3, .0, 0, 0), 0), ((6, .0, 4, .5, 5, 1., 0, 0), 0), ((4, .0, 3, .0, 2, .0, 0, 0), 0),
    # furniture, whatever its length, inside an article or not
    ((1, 1., 1, 1., 1, 1., 1, 0), 0), ((14, .0, 1, 1., 12, .0, 1, 0), 0), ((90, .0, 60, .0, 20, .0, 1, 0), 0), ((40, .1, 80, .0, 0, .0, 1, 0), 0), ((7, .0, 90, .0, 0, .0, 1, 0), 0),
    ((25, .0, 50, .0, 50, .0, 1, 1), 0), ((60, .0, 80, .0, 80, .0, 1, 1), 0), ((3, 1., 40, .0, 60, .0, 1, 1), 0), ((2, .0, 0, .0, 9, .0, 1, 0), 0), ((200, .0, 3, .0, 3, .0, 1, 0), 0),
]

# names of the HTML standard
_BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_HOLDS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figure footer form header li main menu nav ol p section table tbody td tfoot th thead tr ul span".split())
_RAW = frozenset("script style noscript template textarea title svg math iframe object select button canvas audio video head".split())
#: Only these may end with their own tag.
_FOREIGN = frozenset(("svg", "math"))
_FURNITURE = frozenset("nav footer aside form menu dialog".split())
_NAMED = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|side-?bar|menu|nav(?:bar|igation)?|footer|header|masthead|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|breadcrumbs?|pagination|pager|comments?|replies|respond|disqus|widget|toolbar|copyright|legal|skip)(?:$|[\s_-])", re.I)
_CONTENT = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|main)(?:$|[\s_-])", re.I)
_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
_TAG = re.compile(r"<(?:!--(?:.*?(?:--!?>|$))|(/?)([A-Za-z][A-Za-z0-9:-]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>|[!?/][^>]*(?:>|$))", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)


def _enclosure(name: str, attrs: str) -> tuple[int, int]:
    """Whether a container is furniture, or an article, by its element name, role, class and id."""
    furniture, article = name in _FURNITURE, name in ("article", "main")
    for m in _ATTR.finditer(attrs) if attrs else ():
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or (value.lower() in _ROLE if key == "role" else _NAMED.search(value)):
            furniture = True
        elif value.lower() == "main" if key == "role" else _CONTENT.search(value):
            article = True
    return int(furniture), int(article and not furniture)


def blocks(page: str) -> list[tuple[str, int, int, int, int]]:
    """(text, words, words in links, furniture, article) of each non-empty block in page order."""
    out: list[tuple[str, int, int, int, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, int]] = []  # name, furniture, article
    furniture = article = link = pos = 0

    def close():
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                out.append((" ".join(words), len(words), min(len(words), len(html.unescape(" ".join(linked)).split())), min(furniture, 1), min(article, 1)))
            parts.clear()
            linked.clear()

    def text(s: str):
        if s:
            parts.append(s)
            if link:
                linked.append(s)

    while True:
        m = _TAG.search(page, pos)
        if m is None:
            tail = page[pos:]
            text(re.sub(r"<[A-Za-z/!?].*", "", tail, flags=re.S))
            break
        text(page[pos:m.start()])
        pos, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        opening = not m[1]
        if name in _BLOCK:
            close()
        if name in _RAW:
            if opening and not (name in _FOREIGN and m[3].endswith("/")):
                if name == "head":  # its contents are furniture; the body may start without its end
                    continue
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, pos)
                pos = end.end() if end else len(page)
            continue
        if name == "a":
            link = 1 if opening else 0
        elif name in _HOLDS:
            if opening and name == "p":
                while stack and stack[-1][0] == "p":
                    _, f, a = stack.pop()
                    furniture, article = furniture - f, article - a
            if opening and not m[3].endswith("/"):
                f, a = _enclosure(name, m[3])
                f = int(f or name == "header" and not article)
                stack.append((name, f, a))
                furniture, article = furniture + f, article + a
            elif not opening and any(s[0] == name for s in stack):
                while stack:
                    top, f, a = stack.pop()
                    furniture, article = furniture - f, article - a
                    if top == name:
                        break
    close()
    return out


def features(page_blocks: list[tuple[str, int, int, int, int]]) -> list[tuple[float, ...]]:
    one = [(w, k / w) for _, w, k, _, _ in page_blocks]
    none = (0, 0.0)
    return [(*one[i], *(one[i - 1] if i else none), *(one[i + 1] if i + 1 < len(one) else none), b[3], b[4]) for i, b in enumerate(page_blocks)]


def train(rows=LABELLED, depth: int = 8):
    """CART with Gini impurity; a node is (feature, cut, left, right), a leaf the majority label."""
    positive = sum(y for _, y in rows)
    label = int(2 * positive >= len(rows))
    if depth == 0 or positive in (0, len(rows)):
        return label
    gini = lambda part: len(part) * (1 - (s := sum(y for _, y in part) / len(part)) ** 2 - (1 - s) ** 2)
    best = None
    for f in range(len(rows[0][0])):
        values = sorted({x[f] for x, _ in rows})
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            left, right = [r for r in rows if r[0][f] <= cut], [r for r in rows if r[0][f] > cut]
            cost = gini(left) + gini(right)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, cut, left, right)
    if best is None or best[0] >= gini(rows) - 1e-12:
        return label
    _, f, cut, left, right = best
    return f, cut, train(left, depth - 1), train(right, depth - 1)


def decide(tree, x) -> int:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(page: str, tree) -> str:
    found = blocks(page)
    return " ".join(b[0] for b, x in zip(found, features(found)) if decide(tree, x))


def extracted(pages: DataFrame, out: str = "text", source: str = "html") -> DataFrame:
    """``pages`` with the main text of ``source`` in ``out``."""
    ship(pages.sparkSession)
    tree = train()

    @F.arrow_udf("string")
    def text(v: pa.Array) -> pa.Array:
        return pa.array([main_text(p or "", tree) for p in v.to_pylist()], pa.string())

    return pages.withColumn(out, text(F.coalesce(F.col(source), F.lit(""))))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = extracted(table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html"))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
