"""Main text of web pages by a tree-structured graphical model over the elements.

Every element is a node with two states, main text or not. Its own potential is the log-odds of
its features (tag, words of class, id and role, words of its own text, share of link text inside);
an edge potential joins it to its parent. Sum-product messages go from the leaves to the root and
back and give the exact marginal of each node; text right below an element is kept if the
element's marginal is at least one half. Potentials are smoothed counts over labelled pages.

Scripts, styles, templates and comments are no text. Character references are decoded, white
space inside a block becomes one space, blocks are joined by one space. Broken markup never
fails: unknown end tags are passed over, open elements end with the page. Null and empty pages
give the empty text. Rows, repeats and other columns stay; ``main_text`` replaces a column of
that name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.llm.shipping import map_batches

#: Fixed values of HTML: elements without content, with raw content, that break lines, and that
#: end an open element of the same kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe noembed noframes xmp".split())
TEXT_ONLY = frozenset("title textarea".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img input button select svg math".split()
)
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dt dd".split()
)
BARRIERS = frozenset("ul ol dl table div article section main aside nav header footer form body html blockquote figure".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_OPEN = re.compile(r"<[a-zA-Z/!?]")
_MARK = re.compile(r"[>\"']")
#: Elements that may stand outside a body.
OUTSIDE = frozenset("html head body frameset title meta link base script style noscript template".split())
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")


#: The tag of a body that a page lacks.
IMPLIED = "implied-body"


class Node:
    """An element: its parent's place, tag, attributes, own words, and words and link words inside."""

    __slots__ = ("attributes", "inside", "linked", "own", "parent", "tag")

    def __init__(self, parent: int, tag: str, attributes: str):
        self.parent, self.tag, self.attributes = parent, tag, attributes
        self.own = self.inside = self.linked = 0


class _Ends:
    """Finds the ends of tags in one pass: a quote hides ``>`` up to its partner, if it has one.

    Where no ``>`` is left outside quotes, the quotes of the page are broken and hide nothing from there on.
    """

    def __init__(self, page: str):
        self._page, self._alone, self._broken = page, set(), False
        self.last = page.rfind(">")

    def of(self, at: int) -> int:
        """The place of the ``>`` that ends the tag whose attributes begin at ``at``; there is one."""
        place = at
        while not self._broken:
            mark = _MARK.search(self._page, place)
            if mark is None:
                self._broken = True
                break
            kind, place = mark[0], mark.end()
            if kind == ">":
                return mark.start()
            if kind not in self._alone:
                partner = self._page.find(kind, place)
                if partner < 0:
                    self._alone.add(kind)  # nor has any later one
                else:
                    place = partner + 1
        return self._page.find(">", at)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str | None]]]:
    """Elements in page order, and what they show: (element, text), or (element, None) at a break.

    What stands outside every element belongs to the body, which is implied where there is none. A
    tag that the page ends in shows nothing. Time grows with the length of the page.
    """
    nodes, shown, stack = [Node(-1, "", "")], [], [0]
    at, n, body, ends = 0, len(page), 0, _Ends(page)

    def home() -> int:
        nonlocal body
        if not body:
            nodes.append(Node(0, IMPLIED, ""))
            body = len(nodes) - 1
        return body

    def text(end: int) -> None:
        if end > at:
            piece = page[at:end]
            owner = stack[-1]
            if owner == 0 and not piece.isspace():
                owner = home()
            shown.append((owner, html.unescape(piece) if "&" in piece else piece))
            nodes[owner].own += piece.count(" ") + 1 if not piece.isspace() else 0

    while at < n:
        if at > ends.last:  # no tag ends any more
            cut = _OPEN.search(page, at)
            text(cut.start() if cut else n)
            break
        found = _TOKEN.search(page, at, ends.last + 1)
        if not found:
            text(ends.last + 1)
            at = ends.last + 1
            continue
        text(found.start())
        closing, tag = found.groups()
        if tag is None:
            at = found.end()
            if page.startswith("<!--", found.start()) and not page.startswith("-->", at - 3):
                end = page.find("-->", found.start() + 4)
                at = end + 3 if end >= 0 else n
            continue
        end = ends.of(found.end())
        attributes, at = page[found.end() : end], end + 1
        tag = tag.lower()
        if tag not in INLINE:
            shown.append((stack[-1], None))
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                name = nodes[stack[depth]].tag
                if name == tag:
                    del stack[depth:]
                    break
                if (name in BARRIERS and (tag in INLINE or tag not in BARRIERS)) or name == "body":
                    break
            continue
        if tag in CLOSES_P:
            _end(nodes, stack, ("p",))
        if tag in CLOSES:
            _end(nodes, stack, CLOSES[tag])
        if tag in VOID:
            continue
        if stack[-1] == 0 and tag not in OUTSIDE:
            stack.append(home())
        nodes.append(Node(stack[-1], tag, attributes))
        if tag == "body" and not body:
            body = len(nodes) - 1
        if tag in RAW or tag in TEXT_ONLY:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            stop = end.start() if end else n
            if tag in TEXT_ONLY:
                stack.append(len(nodes) - 1)
                text(stop)
                stack.pop()
                shown.append((stack[-1], None))
            at = end.end() if end else n
        elif not attributes.endswith("/") or tag not in ("svg", "math", "path"):
            stack.append(len(nodes) - 1)
    return nodes, shown


def _end(nodes: list[Node], stack: list[int], tags: tuple[str, ...]) -> None:
    """End the innermost open element of ``tags`` that no barrier stands before, and all inside it."""
    for depth in range(len(stack) - 1, 0, -1):
        name = nodes[stack[depth]].tag
        if name in tags:
            del stack[depth:]
            return
        if name in BARRIERS:
            return


def features(nodes: list[Node]) -> list[list[str]]:
    """Names of the features of every element."""
    for k in range(len(nodes) - 1, 0, -1):
        node = nodes[k]
        node.inside += node.own
        if node.tag == "a":
            node.linked = node.inside
        around = nodes[node.parent]
        around.inside += node.inside
        around.linked += node.linked
    out = []
    for node in nodes:
        own = [f"tag:{'body' if node.tag == IMPLIED else node.tag}", f"own:{min(node.own, 64).bit_length()}", f"inside:{min(node.inside, 255).bit_length() // 2}"]
        if node.inside:
            own.append(f"links:{4 * node.linked // node.inside}")
        if "=" in node.attributes:
            words = {w for m in _NAMES.finditer(node.attributes) for w in _WORD.findall((m[2] or m[3] or m[4] or "").lower())}
            own += [f"name:{w}" for w in sorted(words)]
        out.append(own)
    return out


@dataclass
class Model:
    """Log-odds of features, and the chance of main text below main text and below other elements."""

    odds: dict[str, float] = field(default_factory=dict)
    below_main: float = 0.5
    below_rest: float = 0.5

    def marginals(self, nodes: list[Node]) -> list[float]:
        """The chance of main text of every element, by messages up and down the tree."""
        odds = self.odds
        local = [max(-30.0, min(30.0, sum(odds.get(f, 0.0) for f in own))) for own in features(nodes)]
        up = [0.0] * len(nodes)
        # Edge potentials (parent's state, own state); the root's stand for "not main".
        p1, p0 = self.below_main, self.below_rest
        for k in range(len(nodes) - 1, 0, -1):
            b = exp(min(60.0, local[k]))
            up[k] = log(((1 - p1) + p1 * b) / ((1 - p0) + p0 * b))
            local[nodes[k].parent] += up[k]
        out = [0.0] * len(nodes)
        total = [0.0] * len(nodes)
        total[0] = -30.0
        for k in range(1, len(nodes)):
            r = exp(max(-60.0, min(60.0, total[nodes[k].parent] - (up[k] if nodes[k].parent else 0.0))))
            total[k] = local[k] + log((p0 + p1 * r) / ((1 - p0) + (1 - p1) * r))
            out[k] = 1 / (1 + exp(-max(-60.0, min(60.0, total[k]))))
        return out

    def shows(self, nodes: list[Node]) -> list[bool]:
        """Whether the own text of every element is main text; nothing speaks against text that stands outside all of them."""
        out = [chance >= 0.5 for chance in self.marginals(nodes)]
        bare = [False] * len(nodes)
        for k in range(1, len(nodes)):
            bare[k] = nodes[k].tag == IMPLIED or (bare[nodes[k].parent] and nodes[k].tag in INLINE)
            out[k] = out[k] or bare[k]
        return out

    def text(self, page: str | None) -> str:
        if not page:
            return ""
        nodes, shown = parse(page)
        main = self.shows(nodes)
        blocks, block = [], []
        for element, piece in [*shown, (0, None)]:
            if piece is None:
                if block and (joined := _SPACE.sub(" ", "".join(block)).strip(" ")):
                    blocks.append(joined)
                block = []
            elif main[element] and nodes[element].tag not in RAW:
                block.append(piece)
        return " ".join(blocks)


def labels(nodes: list[Node]) -> list[bool]:
    """Whether each element of a labelled page is main text."""
    out = []
    for node in nodes:
        own = node.attributes
        out.append("data-main" in own or ("data-rest" not in own and node.parent >= 0 and out[node.parent]))
    return out


def train(pages: DataFrame, html_column: str = "html", weight: float = 0.5) -> Model:
    """Count features and edges of labelled pages in Spark; the driver gets a row for each feature.

    ``weight`` is the share of each feature's log-odds that counts: features of one element say
    partly the same.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, mains = [], []
            for page in batch.column(0).to_pylist():
                nodes, _ = parse(page or "")
                known = labels(nodes)
                for node, own, main in zip(nodes[1:], features(nodes)[1:], known[1:], strict=True):
                    edge = f"edge:{int(known[node.parent])}"
                    names += [edge, *own]
                    mains += [main] * (len(own) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(mains, pa.bool_())], ["name", "main"])

    counted = map_batches(pages.select(html_column), count, "name string, main boolean")
    rows = counted.groupBy("name").agg(F.count_if("main").alias("yes"), F.count_if(~F.col("main")).alias("no")).collect()
    counts = {r["name"]: (r["yes"], r["no"]) for r in rows}
    edges = [counts.get(f"edge:{k}", (0, 0)) for k in (0, 1)]
    all_yes, all_no = (edges[0][i] + edges[1][i] + 1 for i in (0, 1))
    odds = {
        name: weight * log(((yes + 0.5) / all_yes) / ((no + 0.5) / all_no))
        for name, (yes, no) in sorted(counts.items())
        if not name.startswith("edge:")
    }
    below = [(yes + 1) / (yes + no + 2) for yes, no in edges]
    return Model(odds, below[1], below[0])


def with_main_text(pages: DataFrame, model: Model, html_column: str = "html") -> DataFrame:
    """``pages`` with ``main_text`` of every whole page."""
    kept = [f for f in pages.schema.fields if f.name != "main_text"]
    schema = T.StructType([*kept, T.StructField("main_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [model.text(page) for page in part.column(part.schema.get_field_index(html_column)).to_pylist()]
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], schema.names)

    return map_batches(pages, run, schema)
