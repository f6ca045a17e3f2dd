"""Toxicity by a chain of linear classifiers.

Categories are learned in order. Each logistic model sees which vocabulary words a
text holds and the probabilities of all earlier categories; for training, those come out of fold, so
a later model meets earlier ones as unsure as they will be on new texts. Applied,
the models fitted to all training rows run one after the other.

The fit sees at most ``max_docs`` labelled documents, picked by hash. Their words are counted on
Spark; the ``vocabulary`` words that tell most about some category (chi-squared) become
features, so the driver holds a matrix of at most max_docs times vocabulary bits. Every word of every
document is scored.

Nulls and edges: a null or empty text holds no words and gets the chain's prior; a
null label is no label; labels of an unknown document are ignored; several labels of a document count
as their largest; without any labels every probability is 0.5; repeated rows are
scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import tokens
from shelfwise.llm.common import map_arrow, materialise, row_key

#: Words whose presence in a document labelled toxic names the kind of toxicity.
INSULTS = ("bastard", "clown", "coward", "fool", "idiot", "imbecile", "jerk", "loser", "moron", "scum")
CONTEMPT = ("awful", "disgusting", "garbage", "pathetic", "rubbish", "stupid", "trash", "useless", "vile", "worthless")


@dataclass(frozen=True)
class Fit:
    max_docs: int = 12_000
    vocabulary: int = 512
    min_docs: int = 3
    #: Least chi-squared value of a feature (1 degree of freedom, p = 0.00001).
    min_chi: float = 19.5
    folds: int = 3
    l2: float = 0.05
    steps: int = 20
    seed: int = 5


@dataclass
class Chain:
    """Sorted vocabulary hashes, and of each category weights of words, earlier categories and 1."""

    categories: tuple[str, ...]
    vocabulary: np.ndarray
    weights: list[np.ndarray]

    def probabilities(self, present: np.ndarray) -> np.ndarray:
        """One column per category from a boolean matrix of vocabulary words."""
        out = np.zeros((len(present), 0))
        words = present.astype(np.float32)
        for w in self.weights:
            size = len(self.vocabulary)
            z = words @ w[:size] + out @ w[size:-1] + w[-1]
            out = np.column_stack([out, _sigmoid(z)])
        return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, fit: Fit) -> np.ndarray:
    """Ridge logistic regression with weights of 0 or more by projected Newton steps; the last weight is the intercept.

    All inputs speak for the category by choice. Without the sign, chance words of
    long harmless texts would speak against it.
    """
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    w = np.zeros(x.shape[1])
    if not len(x):
        return w
    # Half a row of either class keeps the intercept finite where a class is missing.
    w[-1] = np.log((y.sum() + 0.5) / ((1 - y).sum() + 0.5))
    ridge = np.full(len(w), fit.l2)
    ridge[-1] = 1e-3
    for _ in range(fit.steps):
        p = _sigmoid(x @ w)
        gradient = x.T @ (p - y) + ridge * w
        free = (w > 0) | (gradient < 0)
        free[-1] = True
        part = x[:, free]
        hessian = (part * (p * (1 - p))[:, None].astype(x.dtype)).T @ part + np.diag(ridge[free])
        step = np.linalg.solve(hessian.astype(float), gradient[free])
        size, risk = 1.0, _risk(x, y, w, ridge)
        while size > 1e-4:
            moved = w.copy()
            moved[free] -= size * step
            moved[:-1] = np.maximum(moved[:-1], 0)
            if _risk(x, y, moved, ridge) < risk:
                break
            size /= 2
        if size <= 1e-4 or np.abs(moved - w).max() < 1e-4:
            break
        w = moved
    return w


def _risk(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: np.ndarray) -> float:
    z = x @ w
    return float((np.logaddexp(0, z) - y * z).sum() + 0.5 * (ridge * w * w).sum())


def train_chain(x: np.ndarray, y: np.ndarray, fold: np.ndarray, fit: Fit) -> list[np.ndarray]:
    """Weights of each category; columns of ``y`` in chain order, ``fold`` of each row."""
    extra = np.zeros((len(x), 0), np.float32)
    weights: list[np.ndarray] = []
    for k in range(y.shape[1]):
        inputs = np.column_stack([x, extra])
        weights.append(logistic(inputs, y[:, k], fit))
        out = np.zeros(len(x), np.float32)
        for held in range(fit.folds):
            w = logistic(inputs[fold != held], y[fold != held, k], fit)
            rows = inputs[fold == held]
            out[fold == held] = _sigmoid(rows @ w[:-1] + w[-1])
        extra = np.column_stack([extra, out])
    return weights


def distinct_words(chunk: tokens.Chunk) -> Iterator[np.ndarray]:
    """Sorted distinct word hashes of each row."""
    found = tokens.words(chunk.data, chunk.bounds, tokens.ALNUM)
    for a, b in zip(found.ptr[:-1].tolist(), found.ptr[1:].tolist()):
        yield np.unique(found.hash[a:b].view(np.int64))


def fit_chain(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], fit: Fit | None = None, doc_id: str = "doc_id", text: str = "text") -> Chain:
    """Fit to ``labels`` (doc_id and a 0/1 column per category, in chain order).

    The picked labels (at most ``fit.max_docs`` rows of numbers) are broadcast to the documents.
    """
    fit = fit or Fit()
    flags = [F.max(F.col(c).cast("int")).alias(f"_y{k}") for k, c in enumerate(categories)]
    known = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(*flags).dropna()
    known = known.orderBy(F.xxhash64("_id", F.lit(fit.seed)), "_id").limit(fit.max_docs)
    labelled = docs.join(F.broadcast(known), F.col(doc_id) == F.col("_id"))
    names = [f"_y{k}" for k in range(len(categories))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in tokens.chunks(batch.column("_text")):
                sets = list(distinct_words(chunk))
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))
                rows = slice(chunk.first, chunk.first + chunk.rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row")[rows], words, *[batch.column(n)[rows] for n in names]], names=["row", "words", *names]
                )

    source = labelled.select(row_key(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("_text"), *names)
    rows = materialise(
        map_arrow(source, work, "row long, words array<long>, " + ", ".join(f"{n} int" for n in names)), "toxic-words"
    )
    vocabulary = _telling_words(rows, names, fit)
    wanted = F.array(*[F.lit(int(w)) for w in vocabulary]) if len(vocabulary) else F.array().cast("array<long>")
    table = rows.select("row", F.array_intersect("words", wanted).alias("words"), *names).toArrow()
    order = np.lexsort((*[table[n].to_numpy() for n in names], table["row"].to_numpy()))
    x = np.zeros((table.num_rows, len(vocabulary)), np.float32)
    for at, words in enumerate(table["words"].to_pylist()):
        x[at, np.searchsorted(vocabulary, words)] = 1
    y = np.column_stack([table[n].to_numpy() for n in names]).astype(float).reshape(-1, len(names))
    keys = table["row"].to_numpy()[order]
    return Chain(categories, vocabulary, train_chain(x[order], y[order], np.mod(keys, fit.folds), fit))


def _telling_words(rows: DataFrame, names: list[str], fit: Fit) -> np.ndarray:
    """Sorted hashes of the words with the largest chi-squared value for some category.

    Only words that are more frequent in it count: all others would make long texts look harmless.
    """
    n, *positive = rows.agg(F.count(F.lit(1)), *[F.sum(c) for c in names]).first()
    held = rows.select(F.explode("words").alias("word"), *names).groupBy("word")
    counts = held.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names]).where(F.col("n") >= fit.min_docs)
    chi = F.lit(0.0)
    for name, total in zip(names, positive):
        if total and total < n:
            off = F.col(name) * F.lit(float(n)) - F.col("n") * F.lit(float(total))
            spread = F.col("n") * (F.lit(float(n)) - F.col("n") + F.lit(1e-9)) * F.lit(float(total) * (n - total))
            chi = F.greatest(chi, F.when(off > 0, off * off * F.lit(float(n)) / spread))
    best = counts.select("word", chi.alias("chi")).where(F.col("chi") >= fit.min_chi).orderBy(F.desc("chi"), "word").limit(fit.vocabulary)
    return np.sort(best.toArrow()["word"].to_numpy())


def score_documents(docs: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, p_<category> for each category) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        vocabulary = chain.vocabulary.view(np.uint64)
        order = np.argsort(vocabulary)
        ranked = vocabulary[order]
        for batch in batches:
            for chunk in tokens.chunks(batch.column("_text")):
                found = tokens.words(chunk.data, chunk.bounds, tokens.ALNUM)
                present = np.zeros((chunk.rows, len(vocabulary)), bool)
                if len(ranked):
                    at = np.minimum(np.searchsorted(ranked, found.hash), len(ranked) - 1)
                    hit = np.flatnonzero(ranked[at] == found.hash)
                    row = np.searchsorted(found.ptr, hit, side="right") - 1
                    present[row, order[at[hit]]] = True
                p = chain.probabilities(present)
                ids = batch.column("doc_id")[chunk.first : chunk.first + chunk.rows]
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(p[:, k].astype(float)) for k in range(len(names))]], names=["doc_id", *names])

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"`{n}` double" for n in names)
    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), work, schema)


def kinds_of_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", max_docs: int = Fit.max_docs, seed: int = Fit.seed) -> DataFrame:
    """Labels (doc_id, insult, contempt, toxic): a toxic document is also of the kinds whose words it holds.

    At most ``max_docs`` labelled documents, picked by hash as ``fit_chain`` does.
    """
    known = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(toxic).alias("_toxic")).dropna()
    known = known.orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(max_docs)
    body = F.lower(F.col(text))
    held = lambda words: F.when(F.col("_toxic") == 1, F.coalesce(body.rlike(rf"\b({'|'.join(words)})\b"), F.lit(False)).cast("int")).otherwise(0)
    return docs.join(F.broadcast(known), F.col(doc_id) == F.col("_id")).select(
        F.col("_id").alias(doc_id), held(INSULTS).alias("insult"), held(CONTEMPT).alias("contempt"), F.col("_toxic").alias("toxic")
    )
