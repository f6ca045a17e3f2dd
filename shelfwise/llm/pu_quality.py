"""Text quality by positive-unlabelled learning.

A logistic model is fitted to trusted positives and to unlabelled documents by the
non-negative unbiased risk: with class prior p, loss l and score g,

    p E_pos[l(g)] + max(0, E_unl[l(-g)] - p E_pos[l(-g)])

so no negative label is needed. The prior is estimated first: a positive-against-unlabelled
model scores both samples out of fold, and the smallest ratio of the share of unlabelled to the share of
positives above a score bounds the prior (with a confidence margin for small shares).

Features are shares and rates of the whole text, expanded into piecewise linear functions with
knots at the samples' quantiles. The fit sees at most ``positives`` and about ``unlabelled``
documents, picked by hash from the whole corpus; every document is scored.

Nulls and edges: null and empty texts have zero features and get a score; without
positives every score is the prior's start value 0.5; a null id is never a labelled row; an
empty table gives an empty result; repeated rows are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import tokens
from shelfwise.llm.common import map_arrow, row_key


@dataclass(frozen=True)
class Fit:
    #: Bounds of the samples that the fit sees.
    positives: int = 8_000
    unlabelled: int = 8_000
    knots: int = 6
    folds: int = 3
    steps: int = 400
    rate: float = 0.05
    l2: float = 1e-3
    seed: int = 11


def _bytes_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


_CLASSES = {
    "symbols": _bytes_table(b"#*$%&<>@^~_=\\+"),
    "bars": _bytes_table(b"|"),
    "exclamations": _bytes_table(b"!"),
    "stops": _bytes_table(b".,;:?"),
    "digits": _bytes_table(b"0123456789"),
    "upper": _bytes_table(bytes(range(65, 91))),
    "lower": _bytes_table(bytes(range(97, 123))),
    "breaks": _bytes_table(b"\n"),
    "other": _bytes_table(bytes(range(128, 256))),
}
FEATURES = ("words", "word_bytes", *_CLASSES, "upper_share", "distinct", "repeats", "distinct_windows", "short", "long")


def features(chunk: tokens.Chunk) -> np.ndarray:
    """One row of ``FEATURES`` for each row of a chunk."""
    found = tokens.words(chunk.data, chunk.bounds, tokens.SPACED)
    ptr = found.ptr

    def by_row(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        return (total[ends[1:]] - total[ends[:-1]]).astype(float)

    n = np.diff(ptr).astype(float)
    per_word = np.maximum(n, 1)
    length = found.end - found.start
    counts = {name: by_row(table[chunk.data], chunk.bounds) for name, table in _CLASSES.items()}
    same = np.zeros(len(found.hash), bool)
    same[1:] = found.hash[1:] == found.hash[:-1]
    inner = ptr[:-1][n > 0]
    same[inner] = False
    triples = tokens.combine(found.hash, 3)
    distinct = np.ones(chunk.rows)
    windows = np.ones(chunk.rows)
    for row in np.flatnonzero(n).tolist():
        a, b = int(ptr[row]), int(ptr[row + 1])
        distinct[row] = len(np.unique(found.hash[a:b])) / (b - a)
        if b - a > 3:
            windows[row] = len(np.unique(triples[a : b - 2])) / (b - a - 2)
    letters = np.maximum(counts["upper"] + counts["lower"], 1)
    columns = [np.log1p(n), by_row(length, ptr) / per_word, *[counts[c] / per_word for c in _CLASSES], counts["upper"] / letters]
    columns += [distinct, by_row(same, ptr) / per_word, windows, by_row(length <= 2, ptr) / per_word, by_row(length > 15, ptr) / per_word]
    return np.column_stack(columns)


def feature_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, f): the features of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in tokens.chunks(batch.column("_text")):
                found = features(chunk)
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)), pa.array(found.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays([batch.column("row")[chunk.first : chunk.first + chunk.rows], flat], names=["row", "f"])

    source = docs.select(row_key(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("_text"))
    return map_arrow(source, work, "row long, f array<double>")


@dataclass
class Basis:
    """Piecewise linear functions of each feature, scaled by the sample."""

    cuts: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    @classmethod
    def of(cls, sample: np.ndarray, knots: int) -> Basis:
        cuts = np.quantile(sample, np.linspace(0.02, 0.98, knots), axis=0)
        basis = cls(cuts, np.zeros(1), np.ones(1))
        raw = basis.raw(sample)
        return cls(cuts, raw.mean(axis=0), np.maximum(raw.std(axis=0), 1e-6))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, *[np.maximum(x - cut, 0) for cut in self.cuts]])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        scaled = (self.raw(x) - self.mean) / self.scale
        return np.column_stack([np.clip(scaled, -6, 6), np.ones(len(x))])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(start: np.ndarray, gradient, fit: Fit) -> np.ndarray:  # noqa: ANN001
    """Adam with a decaying rate."""
    w, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, fit.steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        rate = fit.rate * (1 - step / (fit.steps + 1))
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def class_prior(pos: np.ndarray, unl: np.ndarray, fit: Fit) -> float:
    """Share of positives among the unlabelled, from out-of-fold scores of a positive-against-unlabelled model."""
    scores = [np.zeros(len(pos)), np.zeros(len(unl))]
    for fold in range(fit.folds):
        held = [np.arange(len(x)) % fit.folds == fold for x in (pos, unl)]
        x = np.vstack([pos[~held[0]], unl[~held[1]]])
        y = np.concatenate([np.ones((~held[0]).sum()), np.zeros((~held[1]).sum())])
        weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
        w = _descend(np.zeros(x.shape[1]), lambda w: x.T @ (weight * (sigmoid(x @ w) - y)) + fit.l2 * w, fit)
        for k, rows in enumerate((pos, unl)):
            scores[k][held[k]] = rows[held[k]] @ w
    cuts = np.quantile(scores[0], np.linspace(0, 0.9, 91))
    share_pos = np.array([(scores[0] >= c).mean() for c in cuts])
    share_unl = np.array([(scores[1] >= c).mean() for c in cuts])
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(pos)) + 1 / np.sqrt(len(unl)))
    return float(np.clip(((share_unl + margin) / np.maximum(share_pos, 1e-9)).min(), 0.05, 0.95))


def minimise_risk(pos: np.ndarray, unl: np.ndarray, prior: float, fit: Fit) -> np.ndarray:
    """Weights that minimise the non-negative risk under the logistic loss.

    While the estimated negative part is below zero, steps only undo that.
    """

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = pos @ w, unl @ w
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up = unl.T @ sigmoid(zu) / len(unl) - prior * (pos.T @ sigmoid(zp)) / len(pos)
        if negative < 0:
            return -up
        return up - prior * (pos.T @ sigmoid(-zp)) / len(pos) + fit.l2 * w

    return _descend(np.zeros(pos.shape[1]), gradient, fit)


@dataclass
class Model:
    basis: Basis | None
    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), 0.5) if self.basis is None else sigmoid(self.basis(x) @ self.weights)


def fit_model(docs: DataFrame, positives: DataFrame, fit: Fit | None = None, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit to the documents named in ``positives`` (column ``doc_id``) and to unlabelled ones.

    The positives' ids (at most ``fit.positives``) are broadcast; no text leaves its task.
    """
    fit = fit or Fit()
    ids = positives.select(F.col(doc_id).alias("_id")).where("_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("_id", F.lit(fit.seed)), "_id").limit(fit.positives)
    trusted = docs.join(F.broadcast(ids), F.col(doc_id) == F.col("_id"), "left_semi")
    pos = _matrix(feature_rows(trusted, doc_id, text))
    share = min(1.0, fit.unlabelled / max(1, docs.select(doc_id).count()))
    picked = F.pmod(F.xxhash64(row_key(F.col(doc_id), F.col(text)), F.lit(fit.seed)), F.lit(1_000_003)) <= int(share * 1_000_003)
    unl = _matrix(feature_rows(docs.where(picked), doc_id, text))
    if not len(pos) or not len(unl):
        return Model(None, np.zeros(0), 0.5)
    basis = Basis.of(unl, fit.knots)
    pos, unl = basis(pos), basis(unl)
    prior = class_prior(pos, unl, fit)
    return Model(basis, minimise_risk(pos, unl, prior, fit), prior)


def _matrix(rows: DataFrame) -> np.ndarray:
    """Collected features in an order that doesn't depend on the partitions."""
    table = rows.toArrow()
    values = np.array(table["f"].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    keys = table["row"].to_numpy()
    return values[np.lexsort((*values.T, keys))]


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in tokens.chunks(batch.column("_text")):
                ids = batch.column("doc_id")[chunk.first : chunk.first + chunk.rows]
                yield pa.RecordBatch.from_arrays([ids, pa.array(shared.value.score(features(chunk)))], names=["doc_id", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), work, f"doc_id {kind}, score double")
