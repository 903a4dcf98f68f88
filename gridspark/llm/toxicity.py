"""A toxicity classifier regularised by counterfactuals.

Features are the presence of a word and of its first bytes (stems), so inflected forms of
learnt words count too. A logistic regression is fitted on a bounded labelled sample,
with a penalty on the squared change of the logit when identity terms in a sample's text
are swapped for other ones: what the model says of a neutral group mention must not depend on
the group. Scoring runs over all documents inside Spark's tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.llm.common import BYTE_VALUES, U, WORD_BASE, fresh, mix, powers, released, seeds, text_slices, word_hashes, word_spans
from gridspark.llm.sample import fold, labelled_sample

# Bounds of the sample: documents per label value, and bytes of one document.
SAMPLE_ROWS = 4_000
SAMPLE_BYTES = 24 << 10
# Word beginnings used as features, in bytes.
STEMS = (4, 5, 6, 7, 8)
STEM_SALTS = seeds(max(STEMS), 11)
# Features kept: those most associated with the label (G statistic of at least LEAST_G).
FEATURES, LEAST_G = 600, 20.0
# Sample texts with label 1 that a feature must be in.
LEAST_TOXIC = 3
RIDGE, COUNTERFACTUAL = 0.05, 5.0

# Identity terms, in groups whose members stand for one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "citizens", "refugees", "natives"),
    ("immigrant", "citizen", "refugee", "native"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
)
_NEXT = {w: g[(i + 1) % len(g)] for g in IDENTITY_TERMS for i, w in enumerate(g)}
_TERM = re.compile(r"\b(" + "|".join(sorted(_NEXT, key=len, reverse=True)) + r")\b")

# Separators: every ASCII byte but letters.
APART = np.ones(256, bool)
APART[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def swapped(text: str) -> str:
    """A lower-cased text with each identity term replaced by the next of its group."""
    return _TERM.sub(lambda m: _NEXT[m[1]], text)


def feature_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For whole words and for each stem length: (hashes); with the word index of each
    stem's word list given by its length mask. Returns (hashes per kind, word row bounds, sizes)."""
    start, end, first = word_spans(data, offs, APART)
    size = end - start
    kinds = [word_hashes(data, start, end)]
    total = np.zeros(len(start), U)
    p = powers(WORD_BASE, max(STEMS))
    for k in range(max(STEMS)):
        inside = size > k
        at = np.where(inside, start + k, 0)
        if len(start):
            total = total + np.where(inside, BYTE_VALUES[data[at]] * p[k], U(0))
        if k + 1 in STEMS:
            kinds.append(mix(total + STEM_SALTS[k]))
    return kinds, first, size


def row_features(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """The distinct features of each row."""
    kinds, first, size = feature_hashes(data, offs)
    out = []
    for r in range(len(offs) - 1):
        own = slice(first[r], first[r + 1])
        parts = [kinds[0][own]] + [k[own][size[own] >= n] for n, k in zip(STEMS, kinds[1:], strict=True)]
        out.append(np.unique(np.concatenate(parts)))
    return out


@released
def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sample's features, and those of the texts with swapped terms where they hold any."""
    for batch in batches:
        for lo in range(0, len(batch), 100):
            part = batch.slice(lo, 100)
            texts = part.column("text").to_pylist()
            other = [swapped(t) if t and _TERM.search(t) else None for t in texts]
            cols = []
            for column in (pa.array([t or "" for t in texts]), pa.array([o or "" for o in other])):
                rows = []
                one = pa.RecordBatch.from_arrays([column], names=["text"])
                for _, _, data, offs in text_slices(one, "text"):
                    rows += row_features(data, offs)
                cols.append([x.view(np.int64) for x in rows])
            cols[1] = [x if o is not None else None for x, o in zip(cols[1], other, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), *(pa.array(c, pa.list_(pa.int64())) for c in cols)], names=["label", "own", "other"])


def _bits(chosen: np.ndarray) -> callable:
    """The rows of ``_sample_features`` with one bit for each chosen feature."""
    def row(x: pa.ListScalar) -> bytes | None:
        return np.packbits(np.isin(chosen, x.values.to_numpy().view(U))).tobytes() if x.is_valid else None

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [pa.array(map(row, batch.column(c)), pa.binary()) for c in ("own", "other")]
            yield pa.RecordBatch.from_arrays([batch.column("label"), *cols], names=["label", "own", "other"])

    return run


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def filter(self) -> np.ndarray:
        """By the lowest 20 bits of a hash: whether a feature can have it."""
        out = np.zeros(1 << 20, bool)
        out[(self.features & U((1 << 20) - 1)).astype(np.int64)] = True
        return out


def fit(label: np.ndarray, own: list[np.ndarray], other: list[np.ndarray | None], prior: float | None = None) -> Model:
    """Select the features of a sample in memory and fit the weights; ``prior`` as in ``fit_weights``."""
    n1, n0 = int((label == 1).sum()), int((label == 0).sum())
    if not n1 or not n0:
        return constant(n1, n0)
    hashes, place = np.unique(np.concatenate(own), return_inverse=True)
    marks = np.repeat(label, [len(x) for x in own])
    toxic, clean = (np.bincount(place, marks == k, len(hashes)) for k in (1, 0))

    def part(o, e):
        return np.where(o > 0, o * np.log(np.maximum(o, 1e-9) / e), 0)

    both = toxic + clean
    g = 2 * (part(toxic, both * n1 / (n1 + n0)) + part(clean, both * n0 / (n1 + n0)))
    g[(toxic < LEAST_TOXIC) | (toxic / n1 <= clean / n0)] = 0
    top = np.argsort(-g, kind="stable")[:FEATURES]
    chosen = np.sort(hashes[top[g[top] >= LEAST_G]])
    x = np.array([np.isin(chosen, f) for f in own], np.float32).reshape(len(own), len(chosen))
    delta = [x[i] - np.isin(chosen, f) for i, f in enumerate(other) if f is not None]
    return fit_weights(label, chosen, x, np.array(delta, np.float32).reshape(len(delta), len(chosen)), prior)


def constant(n1: int, n0: int) -> Model:
    """Without labels of both kinds every text gets the share of label 1."""
    share = (n1 + 0.5) / (n1 + n0 + 1)
    return Model(np.zeros(0, U), np.zeros(0), float(np.log(share / (1 - share))))


def fit_weights(label: np.ndarray, chosen: np.ndarray, x: np.ndarray, delta: np.ndarray, prior: float | None = None) -> Model:
    """Fit the weights of the ``chosen`` features by Newton steps: ``x`` marks each sample's features, ``delta`` is
    what the swapped terms take from them. ``prior`` is the share of label 1 to calibrate for (default: the sample's)."""
    n1, n0 = int((label == 1).sum()), int((label == 0).sum())
    share = prior if prior is not None else n1 / (n1 + n0)
    weight = np.where(label == 1, share / n1, (1 - share) / n0) * len(label)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    ridge = np.r_[np.full(len(chosen), RIDGE * len(label) / 1000), 1e-6]
    pull = np.zeros((len(chosen) + 1,) * 2)
    pull[:-1, :-1] = 2 * COUNTERFACTUAL * (delta.T @ delta)
    w = np.zeros(len(chosen) + 1)
    w[-1] = np.log(share / (1 - share))
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - label)) + ridge * w + pull @ w
        h = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None].astype(np.float32)).T @ x + np.diag(ridge) + pull
        step = np.linalg.solve(h + 1e-6 * np.eye(len(w)), grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-3:
            break
    return Model(chosen, w[:-1].astype(np.float64), float(w[-1]))


def chosen_features(sample: DataFrame, n1: int, n0: int) -> np.ndarray:
    """The features most associated with label 1, counted over the sample in Spark; only they reach the driver."""
    held = sample.select("label", F.explode("own").alias("feature")).groupBy("feature").agg(
        F.sum("label").cast("double").alias("toxic"), F.sum(1 - F.col("label")).cast("double").alias("clean"))
    held = held.filter((F.col("toxic") >= LEAST_TOXIC) & (F.col("toxic") / n1 > F.col("clean") / n0))

    def part(column: str, share: float) -> F.Column:
        return F.when(F.col(column) > 0, F.col(column) * F.log(F.col(column) / ((F.col("toxic") + F.col("clean")) * share))).otherwise(0.0)

    scored = held.select("feature", (2 * (part("toxic", n1 / (n1 + n0)) + part("clean", n0 / (n1 + n0)))).alias("g"))
    top = scored.filter(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "feature").limit(FEATURES).collect()
    return np.sort(np.array([r["feature"] for r in top], np.int64).view(U))


def train(docs: DataFrame, labels: DataFrame, condition: F.Column, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on at most ``rows`` documents per label value, of at most ``most_bytes`` bytes each. The sample's features
    are written to the shared folder; the driver gets ``FEATURES`` bits for each document."""
    sample = labelled_sample(docs, labels, "toxic", condition, rows, most_bytes).withColumn("text", F.lower("text"))
    sample = fresh(sample.mapInArrow(_sample_features, "label int, own array<long>, other array<long>"), "toxicity-sample")
    held = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = held.get(1, 0), held.get(0, 0)
    if not n1 or not n0:
        return constant(n1, n0) if n1 or n0 else Model(np.zeros(0, U), np.zeros(0), 0.0)
    chosen = chosen_features(sample, n1, n0)
    got = sample.mapInArrow(_bits(chosen), "label int, own binary, other binary").toArrow()
    label = got.column("label").to_numpy().astype(int)

    def matrix(rows: list[bytes]) -> np.ndarray:
        bits = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), (len(chosen) + 7) // 8)
        return np.unpackbits(bits, axis=1, count=len(chosen)).astype(np.float32)

    own, other = got.column("own").to_pylist(), got.column("other").to_pylist()
    x = matrix(own)
    changed = [i for i, o in enumerate(other) if o is not None]
    delta = x[changed] - matrix([other[i] for i in changed]) if changed else np.zeros((0, len(chosen)), np.float32)
    counts = {r["toxic"]: r["n"] for r in labels.filter(condition).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    return fit_weights(label, chosen, x, delta, n1 / (n0 + n1) if n0 and n1 else None)


def _score(model, text: str) -> callable:
    """Each batch without the column ``text``, with its scores at the end."""
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        may = m.filter()
        for batch in batches:
            scores = []
            for _, _, data, offs in text_slices(batch, text):
                kinds, first, size = feature_hashes(data, offs)
                hits = []
                for n, k in zip((0, *STEMS), kinds, strict=True):
                    at = np.flatnonzero(may[(k & U((1 << 20) - 1)).astype(np.int64)] & (size >= n))
                    if len(at) and len(m.features):
                        f = np.minimum(np.searchsorted(m.features, k[at]), len(m.features) - 1)
                        good = m.features[f] == k[at]
                        hits.append(np.stack([np.searchsorted(first, at[good], "right") - 1, f[good]]))
                logit = np.full(len(offs) - 1, m.bias)
                if hits:
                    row, f = np.unique(np.concatenate(hits, axis=1), axis=1)
                    np.add.at(logit, row, m.weights[f])
                scores.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != text]
            yield pa.RecordBatch.from_arrays(
                [c for _, c in rest] + [pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())],
                names=[n for n, _ in rest] + ["score"])

    return run


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """Every row and column of ``docs`` with its ``score`` (0 to 1) from the column ``text``
    (a column of that name is replaced). Null and empty texts get the model's base rate."""
    every = docs.sparkSession.sparkContext.broadcast(model)  # bounded: FEATURES weights
    rows = docs.drop("score").withColumn("lowered text", F.lower("text"))
    fields = [f for f in rows.schema.fields if f.name != "lowered text"]
    return rows.mapInArrow(_score(every, "lowered text"), T.StructType([*fields, T.StructField("score", T.DoubleType())]))


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for every row of ``docs`` (doc_id, text; other columns are ignored)."""
    every = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text")).mapInArrow(
        _score(every, "text"), "doc_id long, score double")


FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: fitted on the rows outside the held-out fold
    (crc32 of the id as text modulo 3 is 1), which is never learnt from."""
    model = train(docs, labels, fold("doc_id", FOLDS) != HELD_OUT)
    return toxicity(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
