"""A quality classifier: histogram gradient-boosted trees over document statistics.

Tasks turn texts into a row of statistics each. The trees are grown on a bounded labelled
sample, on binned columns (a node's split is read off a histogram of gradients), then
flattened into arrays; tasks walk all rows down all trees with array indexing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import LOWER, gram_hashes, released, text_slices, word_hashes, word_spans
from gridspark.llm.sample import fold, labelled_sample

# Bounds of the sample: documents per label value, and bytes of one document.
SAMPLE_ROWS = 8_000
SAMPLE_BYTES = 64 << 10
TREES, DEPTH, BINS, RATE, LEAF, SHRINK = 80, 4, 64, 0.15, 10, 1.0

# Byte classes counted in a text.
CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": bytes(range(48, 58)), "space": b" \t",
    "line": b"\n", "stop": b".!?", "bang": b"!", "comma": b",;:", "pipe": b"|", "mark": b"#$%&*@^~+=_", "brace": b"<>{}[]()\\/",
    "wide": bytes(range(128, 256)), "control": bytes([*range(9), 11, 12, *range(14, 32), 127]),
}
NAMES = ("bytes", "words", *CLASSES, "word_size", "distinct", "top_word", "repeat", "pair_repeat", "letterless", "line_words", "stops_per_word")


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of statistics (``NAMES``) per text; an empty text is all zeros."""
    n = len(offs) - 1
    size = np.diff(offs)
    out = np.zeros((n, len(NAMES)), np.float32)
    if not len(data):
        return out
    counts = {}
    for name, members in CLASSES.items():
        table = np.zeros(256, bool)
        table[list(members)] = True
        at = np.flatnonzero(table[data])
        counts[name] = np.diff(np.searchsorted(at, offs))
    start, end, first = word_spans(data, offs)
    words = word_hashes(LOWER[data], start, end)
    pairs = gram_hashes(words, 2)
    letters = np.zeros(256, bool)
    letters[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
    lettered = np.concatenate(([0], np.cumsum(letters[data])))
    plain = lettered[end] == lettered[start]
    n_words = np.diff(first)
    full = np.maximum(size, 1)
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(n_words)
    for k, name in enumerate(CLASSES):
        out[:, 2 + k] = counts[name] / full
    k = 2 + len(CLASSES)
    out[:, k] = (size - counts["space"] - counts["line"]) / np.maximum(n_words, 1)
    for r in np.flatnonzero(n_words):
        own = words[first[r]: first[r + 1]]
        m = len(own)
        order = np.sort(own)
        new = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1], [True])))
        out[r, k + 1] = (len(new) - 1) / m
        out[r, k + 2] = np.diff(new).max() / m
        if m > 1:
            out[r, k + 3] = (own[1:] == own[:-1]).mean()
            two = np.sort(pairs[first[r]: first[r + 1] - 1])
            out[r, k + 4] = (two[1:] == two[:-1]).mean() if m > 2 else 0
        out[r, k + 5] = plain[first[r]: first[r + 1]].mean()
    out[:, k + 6] = n_words / (counts["line"] + 1)
    out[:, k + 7] = counts["stop"] / np.maximum(n_words, 1)
    return out


@dataclass
class Trees:
    """All trees in one set of arrays. A node with feature -1 is a leaf pointing to itself."""

    feature: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 of each row of statistics."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                f = self.feature[node]
                low = x[rows, np.maximum(f, 0)] <= self.bound[node]
                node = np.where(f < 0, node, np.where(low, self.left[node], self.right[node]))
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Trees:
    """Grow the trees on rows of statistics, labels (0 or 1) and row weights."""
    weight = np.ones(len(y)) if weight is None else weight
    share = (weight[y == 1].sum() + 0.5) / (weight.sum() + 1)
    base = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []
    roots = []
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])).astype(np.float32) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
        margin = np.full(len(y), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
            roots.append(len(nodes))
            nodes.append([])
            margin += _grow(nodes, roots[-1], np.arange(len(y)), binned, edges, g, h, 0, np.zeros(len(y)))
    a = np.array(nodes, np.float64).reshape(-1, 5)
    return Trees(a[:, 0].astype(np.int64), a[:, 1].astype(np.float32), a[:, 2].astype(np.int64), a[:, 3].astype(np.int64), a[:, 4],
                 np.array(roots, np.int64), base)


def _grow(nodes, at, rows, binned, edges, g, h, depth, out) -> np.ndarray:
    """Fill node ``at`` and those below it for ``rows``; returns the rows' leaf values in ``out``."""
    gs, hs = g[rows].sum(), h[rows].sum()
    best = (1e-6, -1, 0)
    if depth < DEPTH and len(rows) >= 2 * LEAF:
        for j, e in enumerate(edges):
            b = binned[rows, j]
            hg, hh = (np.cumsum(np.bincount(b, v[rows], len(e) + 1))[:-1] for v in (g, h))
            count = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
            gain = hg**2 / (hh + SHRINK) + (gs - hg) ** 2 / (hs - hh + SHRINK) - gs**2 / (hs + SHRINK)
            gain[(count < LEAF) | (len(rows) - count < LEAF)] = 0
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), j, int(gain.argmax()))
    if best[1] < 0:
        value = -RATE * gs / (hs + SHRINK)
        nodes[at] = [-1, 0, at, at, value]
        out[rows] = value
        return out
    _, j, k = best
    low = binned[rows, j] <= k
    left, right = len(nodes), len(nodes) + 1
    nodes += [[], []]
    nodes[at] = [j, edges[j][k], left, right, 0]
    _grow(nodes, left, rows[low], binned, edges, g, h, depth + 1, out)
    return _grow(nodes, right, rows[~low], binned, edges, g, h, depth + 1, out)


@released
def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offs in text_slices(batch, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(lo, hi - lo), pa.array([x.tobytes() for x in statistics(data, offs)], pa.binary())],
                names=["label", "x"])


def train(docs: DataFrame, labels: DataFrame, condition: F.Column, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> Trees:
    """Fit on at most ``rows`` documents per label value, of at most ``most_bytes`` bytes each,
    weighted back to the label's frequency."""
    got = labelled_sample(docs, labels, "quality", condition, rows, most_bytes).mapInArrow(_sample_rows, "label int, x binary").toArrow()
    y = got.column("label").to_numpy().astype(int)
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, len(NAMES))
    order = np.lexsort((*x.T, y))  # the same trees whatever order the rows came in
    y, x = y[order], x[order]
    counts = {r["quality"]: r["n"] for r in labels.filter(condition).groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = np.array([counts.get(0, 0) / max(1, (y == 0).sum()), counts.get(1, 0) / max(1, (y == 1).sum())])[y]
    return fit(x, y, weight / max(1e-9, weight.mean()) if len(weight) else weight)


def _score(trees) -> callable:
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(trees.value.score(statistics(data, offs)), pa.float64())],
                    names=["doc_id", "score"])

    return run


def quality(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier) for every row of ``docs`` (doc_id,
    text; other columns are ignored). Null texts are scored as empty ones; rows repeat as given."""
    every = docs.sparkSession.sparkContext.broadcast(trees)  # bounded: TREES trees of DEPTH levels
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score(every), "doc_id long, score double")


FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: fitted on the rows outside the held-out fold
    (crc32 of the id as text modulo 5 is 0), which is never learnt from."""
    trees = train(docs, labels, fold("doc_id", FOLDS) != HELD_OUT)
    return quality(docs, trees).select(
        "doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
