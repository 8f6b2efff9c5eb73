"""Main text of pages by a tree-structured graphical model.

The nodes are a page's block elements and runs of text, the labels are content and boilerplate.
A node's own potential comes from its tag, names, length and links, a parent-child potential
from how often a child has its parent's label. On a tree, sum-product messages sent once from
the leaves to the root and once back give every node's exact marginal; runs of text whose
marginal is above one half are the main text.

All potentials are counts: of labelled nodes in a bounded sample of the given pages, where the
page's own markup (<article>, <main>, <nav>, ...) is the label, and in the labelled pages of this package.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.html_tree import Node, parse
from obslake.llm.labelled_pages import labelled_pages

#: Pages the model is fitted on, about; a documented bound. All pages are extracted.
SAMPLE_PAGES = 2000
#: The labelled pages of this package count so many times each.
OWN_WEIGHT = 50
SMOOTHING = 1.0
#: A feature moves a node's log odds no further, names no further than the second.
MOST_ODDS, MOST_ODDS_NAMES = 3.0, 12.0
THRESHOLD = 0.5

_CONTENT_TAGS = frozenset(["article", "main"])
_OTHER_TAGS = frozenset(["nav", "header", "footer", "aside", "menu", "dialog", "search"])
#: Parts of class and id names that tell what an element is for.
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent"
    " cookie cookies copyright disclaimer disqus feedback foot footer form gdpr head header login masthead menu menubar meta modal"
    " nav navbar navigation newsletter notice overlay pager pagination paywall popup promo promoted promotion reader recommended"
    " related replies reply respond rss search share sharing shoutbox sidebar sidebars signup skip social sponsor sponsored"
    " subscribe subscription tags teaser toolbar topbar tracking widget widgets".split()
)
CONTENT_NAMES = frozenset("article body content entry main page post story text".split())


def features(nodes: list[Node], k: int) -> list[str]:
    """Names of what is seen at a node; a bounded set over all pages."""
    node = nodes[k]
    if node.text is None:
        seen = [f"tag={node.tag}" if len(node.tag) < 12 else "tag=?"]
        if node.hidden:
            seen.append("hidden")
        other = node.names & OTHER_NAMES
        if other:
            seen.append("names=other")
        elif node.names & CONTENT_NAMES:
            seen.append("names=content")
        return seen
    solid = len(node.text) - node.text.count(" ")
    share = min(3, 4 * node.linked // max(1, solid))
    return [
        f"length={min(8, len(node.text).bit_length())}",
        f"links={share}",
        f"ends={node.text[-1] in '.!?:;…'}",
    ]


def edge_kind(parent: Node, child: Node) -> str:
    """What an edge joins; edges of a kind share a potential."""
    if child.text is not None:
        return "text"
    if child.tag in _OTHER_TAGS or child.names & OTHER_NAMES:
        return "aside"
    if parent.tag in _OTHER_TAGS or parent.names & OTHER_NAMES:
        return "other"
    if parent.tag in ("html", "body"):
        return "root"
    return "box" if parent.tag in ("div", "section", "center", "td") else "inner"


EDGE_KINDS = ("text", "aside", "other", "root", "box", "inner")


def markup_labels(nodes: list[Node]) -> list[int | None]:
    """Labels a page's own markup gives: 1 inside <article> or <main>, 0 outside of them.

    Parts made for navigation are 0 wherever they stand, and so are parts named for anything else
    than content. A page without <article> and <main> gives no labels.
    """
    if not any(n.tag in _CONTENT_TAGS for n in nodes):
        return [None] * len(nodes)
    labels: list[int | None] = []
    for node in nodes:
        above = labels[node.parent] if node.parent >= 0 else 0
        fixed = node.parent >= 0 and above == -1
        if node.never or fixed or node.tag in _OTHER_TAGS or (node.text is None and node.names & OTHER_NAMES):
            labels.append(-1)
        else:
            labels.append(1 if node.tag in _CONTENT_TAGS else above)
    return [max(0, label) for label in labels]


def count_page(nodes: list[Node], labels: list[int | None]) -> Counter:
    """Counts of (feature, label), and of (edge, label of the parent, label of the child)."""
    counts: Counter = Counter()
    for k, node in enumerate(nodes):
        label = labels[k]
        if label is None or node.never:
            continue
        for seen in features(nodes, k):
            counts[seen, label] += 1
        counts["all", label] += 1
        above = labels[node.parent] if node.parent >= 0 else None
        if above is not None:
            counts[f"edge {above} {edge_kind(nodes[node.parent], node)}", label] += 1
    return counts


class TreeModel:
    """Potentials of nodes and edges as logarithms, from counts by (name, label)."""

    def __init__(self, counts: dict[tuple[str, int], float]):
        total = [counts.get(("all", y), 0) + 2 * SMOOTHING for y in (0, 1)]
        self.odds = {}
        for name in {name for name, _ in counts if name != "all" and not name.startswith("edge ")}:
            share = [(counts.get((name, y), 0) + SMOOTHING) / total[y] for y in (0, 1)]
            odds = math.log(share[1] / share[0])
            most = MOST_ODDS_NAMES if name.startswith("names=") else MOST_ODDS
            self.odds[name] = max(-most, min(most, odds))
        self.edges = {kind: [self._edge(counts, kind, above) for above in (0, 1)] for kind in EDGE_KINDS}

    @staticmethod
    def _edge(counts: dict[tuple[str, int], float], kind: str, above: int) -> tuple[float, ...]:
        """log P(label of the child | label of the parent) below parents of a kind."""
        row = [counts.get((f"edge {above} {kind}", y), 0) + SMOOTHING for y in (0, 1)]
        return tuple(math.log(v / sum(row)) for v in row)

    def own(self, nodes: list[Node], k: int) -> float:
        """Log odds of content at a node by itself; minus infinity where no text can stand."""
        if nodes[k].never:
            return -math.inf
        return sum(self.odds.get(name, 0.0) for name in features(nodes, k))

    def marginals(self, nodes: list[Node]) -> list[float]:
        """The probability of content at every node, by one pass up and one down."""
        kinds = [self.edges[edge_kind(nodes[n.parent], n)] for n in nodes]
        inside = [[0.0, self.own(nodes, k)] for k in range(len(nodes))]
        up: list[tuple[float, float]] = [(0.0, 0.0)] * len(nodes)
        for k in range(len(nodes) - 1, 0, -1):
            if nodes[k].never:
                continue  # no text can stand there, which says nothing about what is around
            no, yes = inside[k]
            edges = kinds[k]
            up[k] = tuple(_sum(edges[above][0] + no, edges[above][1] + yes) for above in (0, 1))
            at = inside[nodes[k].parent]
            at[0] += up[k][0]
            at[1] += up[k][1]
        beliefs = [inside[0]] + [[0.0, 0.0]] * (len(nodes) - 1)
        for k in range(1, len(nodes)):
            above, edges = beliefs[nodes[k].parent], kinds[k]
            # What the parent believes without this child.
            no, yes = above[0] - up[k][0], above[1] - up[k][1]
            down = [_sum(no + edges[0][y], yes + edges[1][y]) for y in (0, 1)]
            beliefs[k] = [inside[k][0] + down[0], inside[k][1] + down[1]]
        return [_probability(b[1] - b[0]) for b in beliefs]


def _sum(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def _probability(odds: float) -> float:
    if odds == -math.inf:
        return 0.0
    return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def main_text(html: str | None, model: TreeModel) -> str:
    """Blocks of the main text in page order, joined by line feeds; empty if there are none."""
    nodes = parse(html or "")
    chances = model.marginals(nodes)
    return "\n".join(n.text for n, p in zip(nodes, chances, strict=True) if n.text is not None and p > THRESHOLD)


def own_counts() -> Counter:
    """Counts over the labelled pages of this package."""
    total: Counter = Counter()
    for html in labelled_pages():
        nodes = parse(html)
        labels = [n.label if n.label is not None else 0 for n in nodes]
        for key, value in count_page(nodes, labels).items():
            total[key] += OWN_WEIGHT * value
    return total


def fit(pages: DataFrame, page_id: str = "page_id", html: str = "html", sample: int = SAMPLE_PAGES) -> TreeModel:
    """The model from about ``sample`` pages, chosen by a hash of their id, and the labelled ones.

    Counting is done in the tasks; the driver gets one number per feature and label.
    """
    every = max(1, pages.count() // sample)
    chosen = pages.where(F.pmod(F.xxhash64(page_id), F.lit(every)) == 0).select(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                nodes = parse(text or "")
                total.update(count_page(nodes, markup_labels(nodes)))
        yield pa.RecordBatch.from_pylist(
            [{"name": name, "label": label, "n": n} for (name, label), n in total.items()],
            pa.schema([("name", pa.string()), ("label", pa.int32()), ("n", pa.int64())]),
        )

    counted = chosen.mapInArrow(run, "name string, label int, n long").groupBy("name", "label").agg(F.sum("n").alias("n"))
    counts = own_counts()
    for row in counted.collect():
        counts[row.name, row.label] += row.n
    return TreeModel(counts)


def text_column(model: TreeModel, html: Column) -> Column:
    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(page, model) for page in pages.to_pylist()], pa.string())

    return run(html)


def extract(pages: DataFrame, page_id: str = "page_id", html: str = "html", column: str = "text") -> DataFrame:
    """``pages`` with the main text of each page in ``column``; other columns stay.

    A null or empty html, or a page without main text, gives an empty text. Rows are independent:
    repeated pages get equal texts, and an empty table gives an empty result.
    """
    return pages.withColumn(column, text_column(fit(pages, page_id, html), F.col(html)))
