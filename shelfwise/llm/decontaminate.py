"""Benchmark decontamination by latent semantic retrieval and sequence checks.

1. *Weights*: document frequencies of the benchmark's words, over all documents.
2. *Latent space*: randomised SVD of TF-IDF passages. Tasks add up A'A for their
   passages; the driver holds that sum over pairs of the items' words, whatever the corpus. It is fitted to
   the benchmark's items and the passages of all documents, whose word products one pass adds up.
3. *Search*: every passage of every document (windows of 32 and of 64 words, a new one each 16
   words) is folded in and compared with every item's part. A cosine of ``min_cosine`` makes a candidate.
4. *Checks*, in the same task: the longest common subsequence of words must cover
   ``min_lcs`` of the item's part, and ``min_answer`` of its answer, so that reworded
   passages count and chance topics don't. Without an answer column, the last third is the answer.

Long items are searched in parts of 48 words; one part found is enough. Items are
taken ``block_items`` at a time, so what is broadcast has a bound; each block reads the corpus anew.

Nulls and edges: null or empty texts hold no passage; an item without words is never
found; items with the same id are searched apart and reported under that id; repeated rows
are reported one by one; an empty table gives an empty result.
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

STEP = 16
#: Passages in steps; neighbouring passages overlap.
SPANS = (2, 4)
PART = 48
#: Cells of A'A that the driver spreads out at a time, and that a task holds as an array (128 MB).
GRAM_CELLS = 1 << 24
#: Pairs of words that a task holds before it adds them up.
GRAM_PAIRS = 1 << 20
#: Logarithm of the number of slots that find a hash in the vocabulary.
SLOTS_LOG2 = 16
_SLOT_SHIFT = np.uint64(64 - SLOTS_LOG2)
#: Candidates whose words are compared with their parts' at a time.
CANDIDATES = 1 << 13


@dataclass(frozen=True)
class Search:
    rank: int = 128
    oversample: int = 16
    passes: int = 3
    block_items: int = 500
    min_cosine: float = 0.25
    min_lcs: float = 0.7
    min_answer: float = 0.6
    seed: int = 7


@dataclass(frozen=True)
class Part:
    """Up to PART words of an item: what is searched and what must be found."""

    item: int
    words: list[int]
    answer: list[int]


def item_parts(items: list[tuple[int, str | None, str | None]]) -> list[Part]:
    """Parts of (id, text, answer); the answer belongs to the last part."""
    parts: list[Part] = []
    for item, text, answer in items:
        body = _hashes(text)
        closing = _hashes(answer)
        count = -(-len(body) // PART)
        for k in range(count):
            words = body[k * len(body) // count : (k + 1) * len(body) // count]
            tail = closing if closing and k == count - 1 else words[-max(1, len(words) // 3) :]
            parts.append(Part(item, words, tail))
    return parts


def _hashes(text: str | None) -> list[int]:
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    return tokens.words(raw, np.array([0, len(raw)]), tokens.ALNUM).hash.tolist()


class Vocabulary:
    """Sorted word hashes; words that it lacks get the index -1.

    A hash's upper bits tell the few hashes that it may equal.
    """

    def __init__(self, parts: list[Part]) -> None:
        self.hashes = np.unique(np.array([w for p in parts for w in p.words], dtype=np.uint64))
        slots = (self.hashes >> _SLOT_SHIFT).astype(np.int64)
        self._first = np.searchsorted(slots, np.arange((1 << SLOTS_LOG2) + 1)).astype(np.int32)
        self._most = int(np.diff(self._first).max())

    def index(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = self._first[(hashes >> _SLOT_SHIFT).astype(np.int64)].astype(np.int64)
        last = len(self.hashes) - 1
        out = np.full(len(hashes), -1)
        for k in range(self._most):
            near = np.minimum(at + k, last)
            np.copyto(out, near, where=self.hashes[near] == hashes)
        return out


class Lcs:
    """Longest common subsequences with one fixed sequence, a bit vector at a time."""

    def __init__(self, words: list[int]) -> None:
        self._full = (1 << len(words)) - 1
        self._places: dict[int, int] = {}
        for k, word in enumerate(words):
            self._places[word] = self._places.get(word, 0) | 1 << k

    def with_(self, words: list[int]) -> int:
        open_ = self._full
        places = self._places
        for word in words:
            if word in places:
                hit = open_ & places[word]
                open_ = (open_ + hit | open_ - hit) & self._full
        return (self._full ^ open_).bit_count()


def document_frequencies(docs: DataFrame, vocabulary: Vocabulary, text: str) -> tuple[np.ndarray, int]:
    """Documents that hold each vocabulary word, and the number of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    size = len(vocabulary.hashes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            total[size] += batch.num_rows
            for chunk in tokens.chunks(batch.column(0)):
                found = tokens.words(chunk.data, chunk.bounds, tokens.ALNUM)
                at = shared.value.index(found.hash)
                doc = np.repeat(np.arange(chunk.rows), np.diff(found.ptr))
                doc, at = doc[at >= 0], at[at >= 0]
                rows = max(1, GRAM_CELLS // max(1, size))
                for first in range(0, chunk.rows, rows):
                    low, high = np.searchsorted(doc, (first, first + rows))
                    held = np.zeros((min(rows, chunk.rows - first), size), bool)
                    held[doc[low:high] - first, at[low:high]] = True
                    total[:size] += np.count_nonzero(held, axis=0)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["word", "n"])

    counts = map_arrow(docs.select(text), work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size + 1, np.int64)
    total[counts["word"].to_numpy()] = counts["n"].to_numpy()
    return total[:size], int(total[size])


class Passages:
    """Folds the passages of a chunk into a space of vocabulary word vectors."""

    def __init__(self, chunk: tokens.Chunk, vocabulary: Vocabulary, weights: np.ndarray, unknown: float) -> None:
        """``weights`` of the vocabulary's words; all others weigh ``unknown``."""
        found = tokens.words(chunk.data, chunk.bounds, tokens.ALNUM)
        self.hash = found.hash
        self.ptr = found.ptr
        counts = np.diff(found.ptr)
        steps = -(-counts // STEP)
        #: Of each step: first word; of each row: first step.
        self.step_ptr = np.concatenate(([0], np.cumsum(steps)))
        within = np.arange(self.step_ptr[-1]) - np.repeat(self.step_ptr[:-1], steps)
        self.step_row = np.repeat(np.arange(chunk.rows), steps)
        self.start = found.ptr[self.step_row] + within * STEP
        self.at = at = vocabulary.index(found.hash)
        weight = np.where(at >= 0, weights[at] if len(weights) else 0.0, unknown).astype(np.float32)
        self._squares = np.add.reduceat(weight * weight, self.start) if len(self.start) else np.zeros(0, np.float32)
        self.word = np.flatnonzero(at >= 0)
        self.index = at[self.word]
        self.weight = weight[self.word]
        self.word_step = np.searchsorted(self.start, self.word, side="right") - 1

    def _fold_words(self, vectors: np.ndarray, used: np.ndarray) -> np.ndarray:
        """Sums over the steps of the ``used`` words' weighted vectors.

        A step has at most STEP words: round k adds each step's k-th word, all in one go.
        """
        step = self.word_step[used]
        out = np.zeros((len(self.start), vectors.shape[1]), vectors.dtype)
        first = np.flatnonzero(np.diff(step, prepend=-1))
        place = np.arange(len(step)) - np.repeat(first, np.diff(np.append(first, len(step))))
        for k in range(STEP):
            at = np.flatnonzero(place == k)
            words = used[at]
            out[step[at]] += vectors[self.index[words]] * self.weight[words, None]
        return out

    def _span(self, values: np.ndarray, span: int) -> np.ndarray:
        """Sums of up to ``span`` steps from each step on, within the row."""
        out = values.copy()
        last = self.step_ptr[1:][self.step_row]
        for k in range(1, span):
            inside = np.flatnonzero(np.arange(len(values)) + k < last)
            out[inside] += values[inside + k]
        return out

    def folded(self, vectors: np.ndarray, least: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(span, first steps, unit-weight passages in the space) of the passages that may reach a cosine of ``least``.

        A passage's part in the space is no longer than its vocabulary words' part of its
        norm, so passages with less than that are left out before anything is folded in.
        """
        known = np.bincount(self.word_step, self.weight * self.weight, len(self.start))
        norms = [np.maximum(self._span(self._squares, span), 1e-12) for span in SPANS]
        picked = [np.flatnonzero(self._span(known, span) >= least * least * norm * 0.999) for span, norm in zip(SPANS, norms)]
        needed = np.zeros(len(self.start) + max(SPANS), bool)
        for span, steps in zip(SPANS, picked):
            for k in range(span):
                needed[steps + k] = True
        used = np.flatnonzero(needed[self.word_step])
        sums = self._fold_words(vectors, used)
        last = self.step_ptr[1:][self.step_row]
        for span, norm, steps in zip(SPANS, norms, picked):
            out = sums[steps]
            for k in range(1, span):
                inside = np.flatnonzero(steps + k < last[steps])
                out[inside] += sums[steps[inside] + k]
            yield span, steps, out / np.sqrt(norm[steps])[:, None]

    def gram(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Products in A'A for A of the chunk's single steps as passages, to be summed: codes row * size + column with row <= column, and values.

        A step has at most STEP words: round k takes each word with the k-th after it in its step.
        """
        codes, values = [np.zeros(0, np.int64)], [np.zeros(0)]
        norm = np.maximum(self._squares, 1e-12)
        for k in range(STEP):
            at = np.flatnonzero(self.word_step[k:] == self.word_step[: max(0, len(self.word_step) - k)])
            i, j = self.index[at], self.index[at + k]
            value = self.weight[at].astype(float) * self.weight[at + k] / norm[self.word_step[at]]
            codes.append(np.minimum(i, j) * size + np.maximum(i, j))
            # A word that comes twice meets itself in both orders.
            values.append(np.where((i == j) & (k > 0), 2 * value, value))
        return np.concatenate(codes), np.concatenate(values)


def gram_sums(docs: DataFrame, vocabulary: Vocabulary, weights: np.ndarray, unknown: float, text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums of A'A over the steps of all documents as (codes row * size + column with row <= column, values), and the number of steps."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, weights, unknown))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, unknown = shared.value
        size = len(vocabulary.hashes)
        # A small vocabulary's cells fit an array; else distinct pairs are sorted out.
        cells = np.zeros(size * size if size * size <= GRAM_CELLS else 0)
        codes, values, steps = np.zeros(0, np.int64), np.zeros(0), 0
        new: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _summed(np.concatenate([codes, *(c for c, _ in new)]), np.concatenate([values, *(v for _, v in new)]))

        for batch in batches:
            for chunk in tokens.chunks(batch.column(0)):
                passages = Passages(chunk, vocabulary, weights, unknown)
                steps += len(passages.start)
                products = passages.gram(size)
                if len(cells):
                    np.add.at(cells, *products)
                    continue
                new.append(products)
                if sum(len(c) for c, _ in new) > max(GRAM_PAIRS, len(codes)):
                    codes, values = merged()
                    new.clear()
        codes, values = merged()
        if len(cells):
            codes = np.flatnonzero(cells)
            values = cells[codes]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(codes, -1)), pa.array(np.append(values, steps))], names=["code", "value"])

    sums = map_arrow(docs.select(text), work, "code long, value double").groupBy("code").agg(F.sum("value").alias("value")).orderBy("code").toArrow()
    codes, values = sums["code"].to_numpy(), sums["value"].to_numpy()
    return codes[1:], values[1:], int(values[0]) if len(values) else 0


def _summed(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sums of their values."""
    distinct, place = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(place, values, len(distinct)).astype(float)  # empty: whole numbers


def latent_space(docs: DataFrame, parts: list[Part], vocabulary: Vocabulary, weights: np.ndarray, unknown: float, search: Search, text: str = "text") -> np.ndarray:
    """Leading right singular vectors (vocabulary x rank) of the items and all documents' passages, by subspace iteration."""
    size = len(vocabulary.hashes)
    columns = min(search.rank + search.oversample, size)
    items = item_vectors(parts, vocabulary, weights)
    codes, values, steps = gram_sums(docs, vocabulary, weights, unknown, text)
    off = codes // max(1, size) != codes % max(1, size)
    codes = np.concatenate((codes, codes[off] % size * size + codes[off] // size))
    order = np.argsort(codes)
    codes, values = codes[order], np.concatenate((values, values[off]))[order]
    block = max(1, GRAM_CELLS // max(1, size))
    q = np.linalg.qr(np.random.default_rng(search.seed).standard_normal((size, columns)))[0]
    for _ in range(search.passes):
        total = np.zeros(q.shape)
        for first in range(0, size, block):
            a, b = np.searchsorted(codes, (first * size, (first + block) * size))
            rows = np.zeros((min(block, size - first), size))
            rows.reshape(-1)[codes[a:b] - first * size] = values[a:b]
            total[first : first + block] = rows @ q
        # Items count as much as all passages together.
        product = total / max(1, steps) + items.T @ (items @ q) / max(1, len(items))
        small = q.T @ product
        basis = q
        q = np.linalg.qr(product)[0]
    found, turn = np.linalg.eigh((small + small.T) / 2)
    lead = np.argsort(found)[::-1][: search.rank]
    return (basis @ turn[:, lead]).astype(np.float32)


def item_vectors(parts: list[Part], vocabulary: Vocabulary, weights: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors of the parts, one row each."""
    out = np.zeros((len(parts), len(vocabulary.hashes)))
    for k, part in enumerate(parts):
        at = vocabulary.index(np.array(part.words, np.uint64))
        np.add.at(out[k], at, weights[at])
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def _may_hold(passages: Passages, held: np.ndarray, least: np.ndarray, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Which words low[i]:high[i] may have a common subsequence of least[k[i]] words with part k[i].

    It has no more words than those of the passage that the part ``held`` (a row of the vocabulary for each part, and a
    last column for all other words), each as often as either has it.
    """
    out = np.zeros(len(k), bool)
    for first in range(0, len(k), CANDIDATES):
        some = slice(first, first + CANDIDATES)
        place = low[some, None] + np.arange(int((high[some] - low[some]).max()))
        inside = place < high[some, None]
        word = np.where(inside, passages.at[np.minimum(place, len(passages.at) - 1)], -1)
        part = k[some]
        rest = np.flatnonzero((held[part[:, None], word] > 0).sum(axis=1) >= least[part])
        # Words that the passage repeats count as often as the part has them.
        word, part = np.sort(word[rest], axis=1), part[rest]
        start = np.concatenate((np.ones((len(rest), 1), bool), word[:, 1:] != word[:, :-1]), axis=1)
        place = np.arange(word.shape[1])
        nth = place - np.maximum.accumulate(np.where(start, place, 0), axis=1)
        out[first + rest] = (held[part[:, None], word] > nth).sum(axis=1) >= least[part]
    return out


def _part_words(parts: list[Part], vocabulary: Vocabulary) -> np.ndarray:
    """How often each part has each word of the vocabulary; the last column, of all other words, is 0."""
    held = np.zeros((len(parts), len(vocabulary.hashes) + 1), np.uint8)
    for k, part in enumerate(parts):
        np.add.at(held[k], vocabulary.index(np.array(part.words, np.uint64)), 1)
    return held


def _search_block(docs: DataFrame, parts: list[Part], search: Search, doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = Vocabulary(parts)
    frequency, n_docs = document_frequencies(docs, vocabulary, text)
    weights = np.log((n_docs + 1) / (frequency + 1)) + 0.1
    unknown = float(np.log(n_docs + 1) + 0.1)
    key = row_key(F.col(doc_id), F.col(text))
    space = latent_space(docs, parts, vocabulary, weights, unknown, search, text)
    queries = (item_vectors(parts, vocabulary, weights) @ space).astype(np.float32)
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-6)
    shared = spark.sparkContext.broadcast((parts, vocabulary, weights.astype(np.float32), unknown, space, queries))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, vocabulary, weights, unknown, space, queries = shared.value
        whole = [Lcs(p.words) for p in parts]
        answers = [Lcs(p.answer) for p in parts]
        held = _part_words(parts, vocabulary)
        sizes = np.array([len(p.words) for p in parts])
        # The least whole number of words that min_lcs lets pass.
        counts = np.arange(PART + 1)
        least = (counts / sizes[:, None] < search.min_lcs).sum(axis=1)
        for batch in batches:
            for chunk in tokens.chunks(batch.column("_text"), tokens.CHUNK_BYTES // 2):
                passages = Passages(chunk, vocabulary, weights, unknown)
                best: dict[tuple[int, int], tuple[float, float, float]] = {}
                for span, steps, folded in passages.folded(space, search.min_cosine):
                    close = folded @ queries.T
                    at, part = np.nonzero(close >= search.min_cosine)
                    step = steps[at]
                    in_row = passages.step_row[step]
                    lows = np.maximum(passages.ptr[in_row], passages.start[step] - STEP)
                    highs = np.minimum(passages.ptr[in_row + 1], passages.start[step] + (span + 1) * STEP)
                    may = np.flatnonzero(_may_hold(passages, held, least, lows, highs, part))
                    for at, k, row, low, high in zip(*(x[may].tolist() for x in (at, part, in_row, lows, highs))):
                        words = passages.hash[low:high].tolist()
                        lcs = whole[k].with_(words) / len(parts[k].words)
                        if lcs < search.min_lcs:
                            continue
                        answer = answers[k].with_(words) / len(parts[k].answer)
                        if answer >= search.min_answer:
                            found = (lcs, answer, float(close[at, k]))
                            hit = (row, parts[k].item)
                            best[hit] = max(found, best.get(hit, found))
                rows = pa.array([chunk.first + row for row, _ in best], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows),
                        batch.column("row").take(rows),
                        pa.array([item for _, item in best], pa.int64()),
                        *[pa.array([v[k] for v in best.values()], pa.float64()) for k in range(3)],
                    ],
                    names=["doc_id", "row", "item_id", "lcs", "answer", "cosine"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("doc_id"), key.alias("row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return map_arrow(source, work, f"doc_id {kind}, row long, item_id long, lcs double, answer double, cosine double")


def leaks(docs: DataFrame, benchmark: DataFrame, search: Search | None = None, doc_id: str = "doc_id", text: str = "text", answer: str | None = None) -> DataFrame:
    """(doc_id, row, item_id, lcs, answer, cosine): each document with each item that it holds.

    ``lcs`` and ``answer`` are the shares of the item's best part and of its answer, in word order, in one passage.
    """
    search = search or Search()
    items = benchmark.select("item_id", "text", (F.col(answer) if answer else F.lit(None).cast("string")).alias("answer"))
    items = items.where("item_id is not null and text is not null").orderBy("item_id", "text")
    out: DataFrame | None = None
    taken = 0
    while True:
        block = [tuple(r) for r in items.offset(taken).limit(search.block_items).collect()]
        parts = item_parts(block)
        if parts:
            found = materialise(_search_block(docs, parts, search, doc_id, text), "leaks")
            out = found if out is None else out.unionAll(found)
        taken += len(block)
        if len(block) < search.block_items:
            break
    if out is None:
        kind = docs.schema[doc_id].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, row long, item_id long, lcs double, answer double, cosine double")
    return out
