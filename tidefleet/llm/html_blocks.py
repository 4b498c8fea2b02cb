"""Main-text extraction: flat text blocks, their neighbours, and a decision tree.

A page is cut into flat blocks at block-level tags in one pass. A block is
described by its words and link density, those of the blocks beside it and of
the section that it shares with its siblings, and what its tags and names say; a
decision tree grown on a small labelled table says which blocks are main text.
In most of that table names are missing or misleading, so that words and links
must decide. A name counts on any container but a wrapper: what holds the page's
article, its title beside other parts, or all there is.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidefleet.llm.common import slices, small_batches

#: Elements that never show as text, with all that they hold.
HIDDEN = frozenset("audio button canvas datalist iframe math noframes noscript object option script select style svg template textarea title video".split())
#: A tag: a quote opens a value only after an equals sign. Nothing here is tried twice, so a page takes time in proportion to its length.
TAG = re.compile(r"""<(/?+)([a-zA-Z][^\s/>]*+)((?>[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+)(>?+)""")
CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in HIDDEN}
NAMED = re.compile(r"""\b(?:class|id|role|aria-label)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Containers, and among them those that begin no section of their own: their blocks belong to what holds them.
CONTAINERS = frozenset("article aside body blockquote details dialog dl div fieldset figure footer form head header html main menu nav ol search section table ul".split())
PARTS = frozenset("blockquote details dl figure ol table ul".split())
AROUND = frozenset("aside dialog fieldset footer form head menu nav search".split())
MAIN = frozenset("article main".split())
#: Words of class, id and role attributes that tell of what stands around the main text.
AROUND_NAMES = frozenset(
    "ad ads adv advert advertisement adverts alert author-box banner breadcrumb breadcrumbs byline captcha comment commentlist comments consent cookie cookies disclaimer discussion footer form gdpr login masthead menu menubar nav navbar navigation newsletter note notice notices notification overlay pager pagination paywall popup privacy promo promoted promotion recommended register related replies reply respond search share sharing sidebar signup site-footer site-header skip social sponsor sponsored subscribe tags teaser toc toolbar tooltip topbar trending warning widget".split()
)
SPLIT_NAMES = re.compile(r"[^a-z0-9]+")
HEADINGS = {f"h{i}": i for i in range(1, 7)}
ITEMS = frozenset("dd dt li td th".split())
LONG_REFERENCE = re.compile("&#([0-9]{8,});?")
FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "longest_near",
    "section_words", "section_share", "section_link_density", "section_heading", "heading", "item", "bare", "after_title", "around", "named", "main", "page_header", "elsewhere", "outside",
)
#: Rows of a tree at most, so many levels down.
DEPTH, LEAST = 10, 4


@dataclass
class Block:
    text: str
    words: int
    linked: int
    tag: str
    named: bool
    node: int


@dataclass
class Page:
    """Flat blocks, and the containers that they stand in: for each its parent, tag and whether its names tell of surroundings."""

    blocks: list[Block] = field(default_factory=list)
    parent: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: [""])
    named: list[bool] = field(default_factory=lambda: [False])


def _named(attributes: str) -> bool:
    """Whether names tell of what stands around main text."""
    for m in NAMED.finditer(attributes):
        for whole in (m[1] or m[2] or m[3] or "").lower().split():
            if whole in AROUND_NAMES or any(n in AROUND_NAMES for n in SPLIT_NAMES.split(whole)):
                return True
    return False


def _reference(m: re.Match) -> str:
    digits = m[1].lstrip("0")
    return f"&#{digits or 0};" if len(digits) < 8 else "�"


def plain(raw: str) -> str:
    """Character references decoded, white space runs turned into one space, trimmed."""
    if "&" in raw:
        raw = html.unescape(LONG_REFERENCE.sub(_reference, raw))
    return " ".join(raw.split())


def parsed(page: str | None) -> Page:
    """Blocks and containers of a page in its order, in one pass; a null page has none."""
    page, out = page or "", Page()
    stack, held = [0], Counter()
    pieces: list[str] = []
    linked: list[str] = []
    tag, own, links = "", False, False
    at, end = 0, len(page)

    def close() -> None:
        text = plain("".join(pieces))
        if text:
            n = text.count(" ") + 1
            out.blocks.append(Block(text, n, min(n, len(plain(" ".join(linked)).split())) if linked else 0, tag, own, stack[-1]))
        pieces.clear()
        linked.clear()

    while at < end:
        lt = page.find("<", at)
        m = TAG.match(page, lt) if lt >= 0 else None
        stop = end if lt < 0 else lt
        if stop > at:
            pieces.append(page[at:stop])
            if links:
                linked.append(page[at:stop])
        if lt < 0:
            break
        if not m:
            if page.startswith(("<!", "<?", "</"), lt):
                finish = "-->" if page.startswith("<!--", lt) else "]]>" if page.startswith("<![CDATA[", lt) else ">"
                at = page.find(finish, lt + 2)
                at = end if at < 0 else at + len(finish)
            else:  # a sign, not a tag
                pieces.append("<")
                at = lt + 1
            continue
        if not m[4]:
            break  # a tag that never ends holds the rest of the page
        at, name, closing = m.end(), m[2].lower(), bool(m[1])
        if name in HIDDEN:
            if not closing and not (name in ("svg", "math") and m[3].endswith("/")):
                until = CLOSING[name].search(page, at)
                at = end if until is None or (gt := page.find(">", until.end())) < 0 else gt + 1
            pieces.append(" ")
        elif name == "a":
            links = not closing
        elif name == "br":
            pieces.append(" ")
        elif name in BLOCKS:
            close()
            tag, own = ("", False) if closing or name in CONTAINERS else (name, bool(m[3]) and _named(m[3]))
            if name in CONTAINERS:
                if not closing:
                    out.parent.append(stack[-1])
                    out.tag.append(name)
                    out.named.append(bool(m[3]) and _named(m[3]))
                    stack.append(len(out.tag) - 1)
                    held[name] += 1
                elif held[name]:
                    links = False
                    while (gone := out.tag[stack.pop()]) != name:
                        held[gone] -= 1
                    held[name] -= 1
    close()
    return out


def _wrappers(page: Page, under: np.ndarray) -> set[int]:
    """Containers whose names don't tell of what they hold, whatever its length: those of the page's main element or article, else those of its title and other parts; and those of all there is."""
    nodes = range(1, len(page.tag))
    whole = {i for i in nodes if under[i] == under[0]}
    begin = next((i for i in nodes if page.tag[i] == "main"), None) or next((i for i in nodes if page.tag[i] == "article" and not page.named[i]), None)
    parts = [True] * len(page.tag)
    if begin is None:
        parts = [False] * len(page.tag)
        for i in reversed(nodes):
            parts[page.parent[i]] |= parts[i] or page.named[i] or page.tag[i] in AROUND
        begin = next((b.node for b in page.blocks if b.tag == "h1"), 0)
    while begin:
        if parts[begin]:
            whole.add(begin)
        begin = page.parent[begin]
    return whole


def described(page: Page) -> np.ndarray:
    """FEATURES of each block."""
    found, nodes = page.blocks, len(page.tag)
    words, linked = np.array([b.words for b in found], float), np.array([b.linked for b in found], float)
    density, free = linked / np.maximum(words, 1), words - linked
    before, after = np.concatenate([[0], words[:-1]]), np.concatenate([words[1:], [0]])
    density_before, density_after = np.concatenate([[0], density[:-1]]), np.concatenate([density[1:], [0]])
    prose = np.concatenate([np.zeros(3), np.where(density < 0.3, words, 0), np.zeros(3)])
    near = np.lib.stride_tricks.sliding_window_view(prose, 7).max(1)

    node = np.array([b.node for b in found])
    under = np.bincount(node, words, nodes)  # words of all that a container holds
    section, around, named, main, header = list(range(nodes)), [0] * nodes, [0] * nodes, [0] * nodes, [0] * nodes
    for i in range(nodes - 1, 0, -1):
        under[page.parent[i]] += under[i]
    wrappers = _wrappers(page, under)
    for i in range(1, nodes):
        up, tag = page.parent[i], page.tag[i]
        section[i] = section[up] if tag in PARTS else i
        around[i] = around[up] + (tag in AROUND and i not in wrappers)
        named[i] = named[up] + (page.named[i] and i not in wrappers)
        main[i] = main[up] + (tag in MAIN)
        header[i] = header[up] + (tag == "header" and not main[i])
    sections = np.array(section)[node]
    total, total_linked = np.bincount(sections, words, nodes), np.bincount(sections, linked, nodes)
    section_free = total - total_linked
    heading = np.array([HEADINGS.get(b.tag, 0) for b in found])
    top = np.full(nodes, 7)
    np.minimum.at(top, sections, np.where(heading, heading, 7))
    rank = top[sections]
    outside = np.array(around)[node] + np.array(named)[node] + np.array([b.named for b in found])
    titles = np.flatnonzero((heading == 1) & (outside == 0) & (np.array(header)[node] == 0))
    after_title = np.arange(len(found)) >= titles[0] if len(titles) else np.full(len(found), 0.5)
    own = np.array([(b.tag in ITEMS, b.tag == "", b.named) for b in found], float)
    return np.column_stack([
        words, density, before, density_before, after, density_after, near,
        section_free[sections], section_free[sections] / max(1.0, section_free.max()), total_linked[sections] / np.maximum(total[sections], 1), rank, heading > 0, own[:, :2], after_title,
        np.array(around)[node], np.array(named)[node] + own[:, 2], np.array(main)[node], np.array(header)[node], under[0] - total[sections], outside,
    ])


@dataclass
class Node:
    share: float
    feature: int = -1
    split: float = 0.0
    below: Node | None = field(default=None, repr=False)
    above: Node | None = field(default=None, repr=False)


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH, least: int = LEAST, first: int | None = None) -> Node:
    """A decision tree by Gini impurity, on rows of features and labels 0 or 1; first is a feature of two values or more that is asked before all others."""
    node = Node(float(y.mean()))
    if first is not None:
        node.feature, node.split = first, 0.5
        low = x[:, first] < 0.5
        node.below, node.above = grow(x[low], y[low], depth, least), grow(x[~low], y[~low], depth, least)
        return node
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return node
    best = (2 * node.share * (1 - node.share) * len(y) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y) + 1)
        cut = np.flatnonzero(v[1:] > v[:-1])
        cut = cut[(n[cut] >= least) & (len(y) - n[cut] >= least)]
        if len(cut):
            a, b, k = n[cut], len(y) - n[cut], ones[cut]
            impurity = 2 * k * (a - k) / a + 2 * (ones[-1] - k) * (b - ones[-1] + k) / b
            i = int(np.argmin(impurity))
            if impurity[i] < best[0]:
                best = (impurity[i], f, (v[cut[i]] + v[cut[i] + 1]) / 2)
    if best[1] >= 0:
        node.feature, node.split = best[1], best[2]
        low = x[:, node.feature] < node.split
        node.below, node.above = grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)
    return node


def judged(tree: Node, x: np.ndarray) -> np.ndarray:
    """Which rows the tree takes for main text."""
    out = np.zeros(len(x), bool)
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if node.feature < 0:
            out[rows] = node.share >= 0.5
        elif len(rows):
            low = x[rows, node.feature] < node.split
            todo += [(node.below, rows[low]), (node.above, rows[~low])]
    return out


@functools.cache
def trained() -> Node:
    """The tree grown on the labelled pages beside this module."""
    from tidefleet.llm.html_examples import MARKED, pages

    x, y = [], []
    for page in pages():
        found = parsed(page)
        x.append(described(found))
        y += [b.text.startswith(MARKED) for b in found.blocks]
    # what an element or a name tells comes first: a tree that asks for lengths before it would know only those of the table
    return grow(np.concatenate(x), np.array(y, float), first=FEATURES.index("outside"))


def main_text(page: str | None, tree: Node) -> str:
    found = parsed(page)
    if not found.blocks:
        return ""
    return " ".join(b.text for b, main in zip(found.blocks, judged(tree, described(found)), strict=True) if main)


def extract(pages: DataFrame) -> DataFrame:
    """Per row of pages: page_id, url, text (main text), n_chars.

    Null and empty html give an empty text; a page without surroundings is main
    text as a whole, be it one word or text without a tag; elements that don't close are closed
    at the page's end, and a tag without an end holds the rest of the page; a
    page of any length takes time in proportion to it; repeated rows and null ids
    get their results; ties cannot arise; an empty table gives none. Other
    columns are not read.
    """
    tree = trained()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, tree) for part in slices(batch, "html") for h in part.column("html").to_pylist()]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    return small_batches(rows).mapInArrow(extracted, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars long")
