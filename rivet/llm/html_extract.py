"""Main-text extraction with a tree-structured graphical model.

A page becomes a tree: its block elements, and its text blocks as leaves.
Every node has a hidden label, content (1) or not (0); an element is content
when the article runs through it. Parent-child potentials connect the labels,
node potentials tie them to what a node looks like (tag, class and id words,
length, links). Sum-product messages go up from the leaves and down again,
which on a tree gives the exact marginals; text blocks with a content
marginal of at least one half are the main text.

The potentials are smoothed counts over labelled pages: the templates of
``html_training``, a few hundred pages built from a fixed seed. A model is a
few kilobytes and is trained once per call.

Extraction is one map over the pages, without a shuffle.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES: element kinds of the HTML standard.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu
nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
NOT_TEXT = frozenset("noscript template svg".split())
#: an element that starts closes an open one of these kinds, up to the limit given
CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}),
          "tr": ("tr caption colgroup", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}),
          **dict.fromkeys(("tbody", "thead", "tfoot"), ("tbody thead tfoot caption colgroup", {"table"})),
          "colgroup": ("caption colgroup", {"table"}), "option": ("option", {"select"}),
          "optgroup": ("option optgroup", {"select"}), "rt": ("rt rp", {"ruby"}), "rp": ("rt rp", {"ruby"}),
          "body": ("head", {"body"})}
P_CLOSERS = BLOCKS - {"html", "head", "body", "title", "button", "caption", "td", "th", "tr", "tbody", "thead", "tfoot",
                      "option", "optgroup", "legend", "select"}

_OTHER = r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
TOKEN = re.compile(_OTHER + r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*)>""", re.S)
TAIL = re.compile(_OTHER + "|(?!)()()", re.S)  # behind the last >, where no start tag ends
NAMES = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?""")
MAY_HIDE = re.compile("hidden|none", re.I)
MAY_LACK_TEXT = re.compile("</(?:noscript|template|svg)", re.I)
NOT_SHOWN = re.compile(r"(?:^|[;\s])display\s*:\s*none", re.I)
WORD = re.compile("[a-z]+")


@dataclass
class Node:
    parent: int
    tag: str  # "" for a text block
    names: tuple[str, ...] = ()
    text: list[str] = field(default_factory=list)
    linked: int = 0  # characters inside links


def hides(given: str) -> bool:
    """Whether a start tag's attributes hide the element; values are read only
    of the attributes ``style`` and ``aria-hidden``."""
    if not MAY_HIDE.search(given):
        return False
    for name, value in ATTRIBUTE.findall(given):
        name, value = name.lower(), value.strip("\"'")
        if (name == "hidden" or name == "style" and NOT_SHOWN.search(value)
                or name == "aria-hidden" and value.strip().lower() == "true"):
            return True
    return False


def tokens(page: str) -> Iterator[tuple[int, re.Match | None]]:
    """(place of the text in front, tag or comment) in page order, and None
    with the text that is left. The content of raw-text elements is skipped;
    a slash ends such a start tag at once inside ``svg``, or where no end tag
    follows."""
    at, last, svg = 0, page.rfind(">") + 1, 0
    missing: set[str] = set()  # raw-text elements without a further end tag
    while at < len(page):
        m = TOKEN.search(page, at, last) if at < last else None
        if m is None or m.end() == last and not m[1] and not m[2]:  # a comment may go on behind the last >
            m = TAIL.search(page, m.start() if m else at)
        if m is None:
            break
        yield at, m
        at = m.end()
        tag, empty = (m[1] or m[2] or "").lower(), (m[3] or "").endswith("/")
        if tag == "svg":
            svg = max(svg - 1, 0) if m[1] else svg + (not empty)
        elif m[2] and tag in RAW and not (empty and svg):
            end = None if tag in missing else re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            if end:
                at = end.end()
            else:
                missing.add(tag)
                at = at if empty else len(page)
    if at < len(page):
        yield at, None


def without_text(page: str) -> dict[int, int]:
    """Start -> end of the elements of ``NOT_TEXT`` that have an end tag, each
    end tag going with the last open start tag of its kind. A start tag that
    is never closed hides nothing."""
    open_: dict[str, list[int]] = defaultdict(list)
    ends = {}
    if MAY_LACK_TEXT.search(page):
        for _, m in tokens(page):
            tag = (m[1] or m[2] or "").lower() if m else ""
            if tag not in NOT_TEXT:
                continue
            if m[1] and open_[tag]:
                ends[open_[tag].pop()] = m.end()
            elif m[2] and not (tag == "svg" and (m[3] or "").endswith("/")):
                open_[tag].append(m.start())
    return ends


def parse(page: str) -> list[Node]:
    """Nodes in page order, parents first; inline markup dissolves into text.

    Unclosed and misnested elements, hidden ones too, end where the standard
    ends them: a block start ends an open paragraph, an end tag ends what is
    open inside it, and an end tag without a start is ignored. Raw-text
    elements, comments, hidden elements and closed ``svg``, ``noscript`` and
    ``template`` have no text. The time is linear in the page: the open
    elements of each tag, and the open blocks, are kept by their places.
    """
    nodes = [Node(-1, "root")]
    open_: list[tuple[str, int, bool]] = [("root", 0, False)]  # (tag, node, hidden); inline ones have their block's node
    places: dict[str, list[int]] = defaultdict(list)  # of the open elements of a tag
    blocks: list[int] = [0]  # places of the open blocks
    links = concealed = skipped = 0  # open links, open hidden elements, end of the last element without text
    block = None  # the text block being filled
    ends = without_text(page)

    def end(n: int) -> None:
        nonlocal links, concealed, block
        while len(open_) > n:
            tag, _, hidden = open_.pop()
            places[tag].pop()
            links -= tag == "a"
            concealed -= hidden
            if tag in BLOCKS:
                blocks.pop()
                block = None

    def start(tag: str, node: int, hidden: bool) -> None:
        nonlocal links
        places[tag].append(len(open_))
        if tag in BLOCKS:
            blocks.append(len(open_))
        links += tag == "a"
        open_.append((tag, node, hidden))

    def innermost(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def add(text: str) -> None:
        nonlocal block
        if not text or concealed:
            return
        if block is None:
            if text.isspace():
                return
            nodes.append(block := Node(open_[-1][1], ""))
        block.text.append(text)
        if links:
            block.linked += len(text)

    for at, m in tokens(page):
        add(page[max(at, skipped):m.start() if m else len(page)])
        if not m:
            break
        if m.start() < skipped:
            continue
        if m[1]:
            tag = m[1].lower()
            if tag == "br":
                add(" ")
            i = innermost((tag,))
            # an inline end tag does not reach out of its block
            if i and (tag in BLOCKS or tag == "object" or i > blocks[-1]):
                end(i)
            continue
        if not m[2]:
            continue
        tag, given = m[2].lower(), m[3] or ""
        if tag in NOT_TEXT:
            skipped = ends.get(m.start(), skipped)
            continue
        hidden = tag not in VOID and not given.endswith("/") and hides(given)
        if tag in RAW:
            if tag in BLOCKS or hidden:
                block = None
            continue
        if tag in P_CLOSERS and open_[blocks[-1]][0] == "p":
            end(blocks[-1])
        if tag in CLOSES:
            kinds, limit = CLOSES[tag]
            outer = innermost(limit)
            if tag == "optgroup":  # an option is closed with its group
                inside = [p[i] for k in kinds.split() if (i := bisect_right(p := places[k], outer)) < len(p)]
                end(min(inside, default=len(open_)))
            elif (i := innermost(kinds.split())) > outer:
                end(i)
        if tag in VOID:
            if tag in BLOCKS:
                block = None
            elif tag == "br":
                add(" ")
            continue
        concealed += hidden
        if tag in BLOCKS or hidden:
            block = None
        if tag in BLOCKS and not concealed:
            names = tuple(sorted({w for n in NAMES.findall(given) for w in WORD.findall(n.lower())}))
            nodes.append(Node(open_[-1][1], tag, names))
            start(tag, len(nodes) - 1, False)
        else:
            start(tag, open_[-1][1], hidden)
    return nodes


def block_text(node: Node) -> str:
    """Character references decoded, white space as one space, trimmed."""
    return " ".join(html.unescape("".join(node.text)).split())


def looks(node: Node, parent: Node) -> tuple[tuple[str, str], ...]:
    """What the node potentials see, as (kind, value). A tag is judged among
    the children of its parent's tag: below a list, an item says nothing."""
    if node.tag:
        tag = node.tag + "+" * bool(node.names)
        return ((f"below {parent.tag}", tag), *(("name", n) for n in node.names))
    size = sum(map(len, node.text))
    return (("size", str(min(size, 4095).bit_length() // 2)), ("links", str(4 * node.linked // max(size, 1))))


Edge = tuple[tuple[float, float], tuple[float, float]]


@dataclass(frozen=True)
class Model:
    """Log potentials. ``edges`` has [parent label][child label] for elements
    and texts, by the parent's tag and, for other tags, over all parents;
    ``seen`` has the log ratio of content to the rest of each look."""

    edges: dict[tuple[bool, str], Edge]
    seen: dict[tuple[str, str], float]

    def edge(self, node: Node, parent: Node) -> Edge:
        return self.edges.get((not node.tag, parent.tag)) or self.edges[not node.tag, ""]

    def ratio(self, node: Node, parent: Node) -> float:
        return sum(self.seen.get(x, 0.0) for x in looks(node, parent))


LEAST_SEEN = 20  # edges below a tag for potentials of its own


def train(pages: list[tuple[list[Node], list[int]]]) -> Model:
    """Smoothed counts over (nodes, labels); the root is content."""
    edges: dict[tuple[bool, str], Counter] = defaultdict(Counter)
    looks_of = {0: Counter(), 1: Counter()}
    kinds: dict[str, set] = defaultdict(set)
    for nodes, labels in pages:
        for node, label in zip(nodes[1:], labels[1:], strict=True):
            parent = nodes[node.parent]
            for tag in (parent.tag, ""):
                edges[not node.tag, tag][labels[node.parent], label] += 1
            for look in looks(node, parent):
                looks_of[label][look] += 1
                kinds[look[0]].add(look)
    seen = {}
    for names in kinds.values():
        total = [sum(looks_of[y][look] for look in names) for y in (0, 1)]
        for look in names:
            p = [(looks_of[y][look] + 0.5) / (total[y] + 0.5 * len(names)) for y in (0, 1)]
            seen[look] = math.log(p[1] / p[0])
    logs = {}
    for key, n in edges.items():
        if n.total() >= LEAST_SEEN or not key[1]:
            rows = [[n[a, b] + 0.5 for b in (0, 1)] for a in (0, 1)]
            logs[key] = tuple(tuple(math.log(x / sum(row)) for x in row) for row in rows)
    return Model(logs, seen)


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """Content marginal of every node by sum-product over the tree.

    Messages are kept as log ratios of content to the rest, so pages of any
    size neither underflow nor lose precision.
    """
    def soft(a: float, b: float) -> float:
        return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))

    edges = [model.edge(n, nodes[n.parent]) for n in nodes]
    own = [0.0] * len(nodes)  # log ratio of the node's potential and the messages from below
    up = [0.0] * len(nodes)
    own[0] = 50.0  # the root is content
    for i in range(len(nodes) - 1, 0, -1):
        node = nodes[i]
        own[i] += model.ratio(node, nodes[node.parent])
        (a00, a01), (a10, a11) = edges[i]
        up[i] = soft(a10, a11 + own[i]) - soft(a00, a01 + own[i])
        own[node.parent] += up[i]
    belief = own[:]
    for i in range(1, len(nodes)):
        above = belief[nodes[i].parent] - up[i]  # the parent without this child
        (a00, a01), (a10, a11) = edges[i]
        belief[i] = own[i] + soft(a01, a11 + above) - soft(a00, a10 + above)
    return [1 / (1 + math.exp(-max(-700.0, b))) for b in belief]


def main_text(page: str, model: Model) -> str:
    nodes = parse(page)
    kept = (block_text(n) for n, m in zip(nodes, marginals(nodes, model), strict=True) if not n.tag and m >= 0.5)
    return "\n\n".join(t for t in kept if t)


def extract(pages: DataFrame, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html",
            model: Model | None = None) -> DataFrame:
    """One row per input row: ``id_cols`` and text, the main text.

    Null or empty html gives an empty text, as does a page without content.
    Ids may be null or repeat. Other columns are ignored, whatever their
    names. An empty table gives an empty result.
    """
    from rivet.llm.html_training import labelled_pages

    model = model or train(labelled_pages())
    fields = [T.StructField(c, pages.schema[c].dataType) for c in id_cols]
    schema = T.StructType([*fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p or "", model) for p in batch.column(len(id_cols)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], schema.fieldNames())
    return pages.select(*id_cols, F.col(html_col)).mapInArrow(run, schema)
