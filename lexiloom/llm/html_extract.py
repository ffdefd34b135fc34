"""Main text of pages by a tree-structured graphical model over their nodes.

Every node of a page's tree (html_tree) is content or not. A node's potential is linear in what it looks like: its
tag, the words of its class and id, its text and that of its subtree. An edge's potential is a table over the two
labels, one for each kind of parent and child. Sum-product messages go upward to the root and downward again, level
by level for all pages of a batch at once, and give each text run's marginal; runs that are more likely content than
not are the main text. The weights maximise the likelihood of labelled pages, whose gradient takes the same marginals.

Edge cases: null, empty and blank pages have the empty text. A page without markup is one run. Blocks are joined by
an empty line; white space inside a block becomes one space. Repeated rows are read each for itself. Only the named
columns are read; no page is cut.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import read
from lexiloom.llm.html_pages import labelled_pages
from lexiloom.llm.html_tree import GROUP, LEAF, N_HINTS, Trees

#: Characters of markup whose trees are held at once; a longer page is held alone.
CHARS = 2_000_000
_LENGTHS = np.array([1, 15, 40, 80, 160, 400, 1000])
_SHARES = np.array([0.02, 0.1, 0.3, 0.6, 0.9])
_LINKED = np.array([0.01, 0.25, 0.6, 0.95])
_N_TAGS = LEAF + 1
#: Kinds of nodes that edge tables tell apart: root and page, article, header, other boilerplate, heading, text block, list and table, division, inline, run.
_KIND = np.array([0, 0, 1, 3, 2, 3, 3, 3, 4, 5, 6, 6, 6, 6, 5, 7, 8, 9])
_N_KINDS = 10


def _buckets(values: np.ndarray, edges: np.ndarray, where: np.ndarray) -> np.ndarray:
    out = np.zeros((len(values), len(edges) + 1))
    rows = np.flatnonzero(where)
    out[rows, np.searchsorted(edges, values[rows], "right")] = 1
    return out


class _Level:
    """The nodes of one depth. They stand in page order, and so the children of a parent stand together."""

    def __init__(self, rows: np.ndarray, parent: np.ndarray):
        self.rows, self.parents = rows, parent[rows]
        self.starts = np.flatnonzero(np.diff(self.parents, prepend=-2))
        self.above = self.parents[self.starts]

    def lift(self, total: np.ndarray, values: np.ndarray) -> None:
        """Adds the values of the nodes to their parents' totals."""
        total[self.above] += np.add.reduceat(values, self.starts)


def _levels(depth: np.ndarray, parent: np.ndarray) -> list[_Level]:
    """Without the roots, from the top."""
    by = np.argsort(depth, kind="stable")
    return [_Level(rows, parent) for rows in np.split(by, np.flatnonzero(np.diff(depth[by])) + 1)[1:]] if len(by) else []


class Graph:
    """Features, edges and levels of some pages' trees."""

    def __init__(self, trees: Trees):
        a = trees.arrays()
        n = len(a["parent"])
        self.parent, self.levels, self.page, self.group = a["parent"], _levels(a["depth"], a["parent"]), a["page"], a["group"]
        leaf = self.leaf = a["group"] == LEAF
        length, stops, ends, signs = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
        self.clean: dict[int, str] = {}
        for i, text in trees.texts.items():
            t = self.clean[i] = " ".join(text.split())
            length[i] = len(t)
            stops[i] = t.count(". ") + t.count("? ") + t.count("! ")
            ends[i] = t[-1:] in ".!?:\"”»…" and bool(t)
            signs[i] = "©" in t or "|" in t or "·" in t
        under, linked, inside = length.copy(), np.minimum(a["link"].astype(float), length), np.zeros(n)
        good = np.where(leaf & (a["label"] == 2), length, 0.0)
        in_p = np.where(leaf & (a["group"][np.maximum(a["parent"], 0)] == GROUP["p"]), length, 0.0)
        for level in reversed(self.levels):
            for total in (under, linked, good, in_p):
                level.lift(total, total[level.rows])
            level.lift(inside, np.ones(len(level.rows)))
        self.label = (2 * good >= under) & (good > 0)
        whole = np.maximum(1, under[self.parent < 0])[self.page] if n else under
        share, link = under / whole, linked / np.maximum(1, under)
        place = np.arange(n) - np.flatnonzero(self.parent < 0)[self.page] if n else under
        many = np.bincount(self.page, minlength=trees.n_pages)[self.page] if n else under
        tags, tag_of_parent = np.zeros((n, _N_TAGS)), np.zeros((n, _N_TAGS))
        tags[np.arange(n), a["group"]] = 1
        rows = np.flatnonzero(leaf)
        tag_of_parent[rows, a["group"][np.maximum(self.parent[rows], 0)]] = 1
        hints = (a["hints"][:, None] >> np.arange(N_HINTS)) & 1
        element = ~leaf
        self.x = np.concatenate(
            (
                tags,
                tag_of_parent,
                hints,
                _buckets(length, _LENGTHS, leaf),
                _buckets(link, _LINKED, leaf & (length > 0)),
                _buckets(link, _LINKED, element & (under > 0)),
                _buckets(share, _SHARES, element),
                _buckets(share, _SHARES, leaf),
                _buckets(in_p / np.maximum(1, under), _SHARES, element),
                _buckets(place / np.maximum(1, many), np.array([0.1, 0.3, 0.7, 0.9]), np.ones(n, bool)),
                np.stack((ends * leaf, (stops > 0) & leaf, (stops > 2) & leaf, signs, (inside == 1) & element, element), 1),
            ),
            axis=1,
        )
        self.edge = _KIND[a["group"][np.maximum(self.parent, 0)]] * _N_KINDS + _KIND[a["group"]]

    def marginals(self, w: np.ndarray, edges: np.ndarray, pairs: bool = False):
        """The log of each node's marginal odds; and, if asked for, of each node's and its parent's labels together (n, parent's, own)."""
        unary = np.zeros((len(self.x), 2))
        unary[:, 1] = self.x @ w
        table = edges[self.edge]
        up, message = unary.copy(), np.zeros_like(unary)
        for level in reversed(self.levels):
            rows = level.rows
            both = table[rows] + up[rows][:, None, :]
            message[rows] = np.logaddexp(both[:, :, 0], both[:, :, 1])
            level.lift(up, message[rows])
        belief = up.copy()
        joint = np.zeros((len(self.x), 2, 2)) if pairs else None
        for level in self.levels:
            rows = level.rows
            rest = belief[level.parents] - message[rows]
            both = table[rows] + up[rows][:, None, :] + rest[:, :, None]
            belief[rows] = np.logaddexp(both[:, 0], both[:, 1])
            belief[rows] -= belief[rows].max(1, keepdims=True)  # on deep trees the sums would grow
            if pairs:
                joint[rows] = both
        odds = belief[:, 1] - belief[:, 0]
        return (odds, joint) if pairs else odds


def fit(pages: list[str], rounds: int = 150, ridge: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and edge tables that maximise the likelihood of pages labelled by data-content attributes, which hold for all that is inside."""
    trees = Trees()
    for page in pages:
        trees.add(page)
    g = Graph(trees)
    y = g.label.astype(int)
    child = np.flatnonzero(g.parent >= 0)
    seen_x = g.x[y == 1].sum(0)
    seen_e = np.zeros((_N_KINDS**2, 2, 2))
    np.add.at(seen_e, (g.edge[child], y[g.parent[child]], y[child]), 1)
    w, e = np.zeros(g.x.shape[1]), np.zeros_like(seen_e)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(e), np.zeros_like(e)]
    n = len(g.x)
    for step in range(1, rounds + 1):
        odds, joint = g.marginals(w, e, True)
        p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        both = np.exp(joint[child] - joint[child].max((1, 2), keepdims=True))
        both /= both.sum((1, 2), keepdims=True)
        mean_e = np.stack([np.bincount(g.edge[child], both[:, a, b], len(e)) for a in (0, 1) for b in (0, 1)], 1).reshape(e.shape)
        grads = ((seen_x - p @ g.x) / n - ridge * w, (seen_e - mean_e) / n - ridge * e)
        for k, (param, grad) in enumerate(zip((w, e), grads, strict=True)):  # steps of Adam
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param += 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return w, e


@functools.lru_cache(maxsize=1)
def trained() -> tuple[np.ndarray, np.ndarray]:
    """The model of the made pages, trained once a process."""
    return fit(labelled_pages())


def main_texts(pages: list[str | None], model: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """The main text of each page."""
    trees = Trees()
    for page in pages:
        trees.add(page)
    g = Graph(trees)
    odds = g.marginals(*model)
    blocks: list[dict[int, list[str]]] = [{} for _ in pages]
    for i, text in trees.texts.items():
        if odds[i] > 0:
            blocks[g.page[i]].setdefault(trees.block[i], []).append(text)
    return ["\n\n".join(t for parts in page.values() if (t := " ".join("".join(parts).split()))) for page in blocks]


def extract(pages: DataFrame, id_cols: list[str], html_col: str = "html", model: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """id_cols, text and n_chars of each row. No shuffle: each batch of the scan is read by itself."""
    w, e = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, at = batch.column(len(id_cols)), 0
            while at < batch.num_rows:
                group, chars = [], 0
                while at + len(group) < batch.num_rows and (chars < CHARS or not group):
                    group.append(column[at + len(group)].as_py())
                    chars += len(group[-1] or "")
                texts = main_texts(group, (w, e))
                part = batch.slice(at, len(group))
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in range(len(id_cols))], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)
                at += len(group)

    names = [*[f"_c{k}" for k in range(len(id_cols))], "text", "n_chars"]
    rows = pages.select(*[F.col(c).alias(f"_c{k}") for k, c in enumerate(id_cols)], F.col(html_col).alias("_html"))
    schema = ", ".join([*[f"_c{k} {rows.schema[f'_c{k}'].dataType.simpleString()}" for k in range(len(id_cols))], "text string", "n_chars long"])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(id_cols)], "text", "n_chars")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"), ["page_id", "url"])
