"""Statistics come from the whole corpus, whatever its size; a term is one row of a task's counts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import decontaminate, line_dedup, pii, tokens


def test_line_frequencies_count_every_document(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("alpha beta gamma delta").alias("text"))
    assert line_dedup.word_frequencies(docs).least == pytest.approx(np.log2(30_000) - 3, abs=1e-6)


def _edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("percent", [80, 60])
def test_similar_lines_share_a_block_however_common_their_words(monkeypatch, percent):
    """Words that tell little, repeated words and long lines: no similar pair is without a block and no bitmap rules one out."""
    rng = random.Random(3)
    pairs, texts = [], []
    for k in range(2000):
        line = [rng.choice("abcdefghijkl") * rng.choice((1, 1, 2)) for _ in range(rng.randrange(4, 70))]
        other = list(line)
        for _ in range(rng.randrange(1, max(2, len(line) * (100 - percent) // 100 + 1))):
            at = rng.randrange(len(other)) if other else 0
            other[at : at + rng.randrange(2)] = rng.choice([[], ["x"], ["a"], ["b"]])
        longest = max(len(line), len(other))
        if line != other and 100 * _edit_distance(line, other) <= (100 - percent) * longest:
            pairs.append((len(texts), len(texts) + 1))
            texts += [" ".join(line), " ".join(other)]
    assert len(pairs) > 500
    monkeypatch.setattr(line_dedup, "_MASKS", np.zeros(0, np.int64))
    lines = line_dedup.Lines(next(tokens.chunks(pa.array(texts), 1 << 30)))
    bits = np.full(1 << line_dedup.SLOTS_LOG2, 1.0, np.float32)
    which = np.arange(len(texts))
    ptr, digests = line_dedup.line_blocks(lines, lines.simhashes(), which, line_dedup.Frequencies(bits, 40.0), percent)
    blocks = [set(digests[a:b].tolist()) for a, b in zip(ptr[:-1], ptr[1:])]
    assert all(blocks[a] & blocks[b] for a, b in pairs)
    monkeypatch.setattr(line_dedup, "MOST_LINES", 7)
    again = line_dedup.line_blocks(lines, lines.simhashes(), which, line_dedup.Frequencies(bits, 40.0), percent)
    assert [set(again[1][a:b].tolist()) for a, b in zip(again[0][:-1], again[0][1:])] == blocks
    monkeypatch.setattr(line_dedup, "MAX_BITS", 64)
    run = line_dedup.Run(np.array([0, len(texts)]), which, lines.keys(), lines.simhashes(), lines.count.astype(np.int32), lines.bags(), percent)
    a, b = np.array(pairs).T
    assert run.near(a, b).all()


def test_blocks_compare_all_lines_or_bring_them_back(monkeypatch):
    """Near pairs of small, large and very large blocks: handed out, or both lines come back."""
    monkeypatch.setattr(line_dedup, "ALL_PAIRS", 150)
    rng = np.random.default_rng(7)
    sizes = [2, 5, 40, 64, 65, 140, 160, 400]
    block = np.repeat(np.arange(len(sizes)), sizes)
    centre = rng.integers(-(1 << 62), 1 << 62, (len(sizes), 40))
    spread = np.where(block % 2, 3, 40)
    flips = np.array([sum(1 << int(b) for b in rng.choice(60, rng.integers(0, 14), replace=False)) for _ in block], np.int64)
    sim = centre[block, rng.integers(0, spread)] ^ flips
    key, n = np.arange(len(block)), np.full(len(block), 30, np.int32)
    bags = [np.zeros(len(block), np.int64) for _ in line_dedup.BAG]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (block, key, sim, n, *bags)], names=["block", "key", "sim", "n", *line_dedup.BAG])
    near = {(i, j) for i in key.tolist() for j in range(i + 1, len(key)) if block[i] == block[j] and (int(sim[i] ^ sim[j]) & (1 << 64) - 1).bit_count() <= line_dedup.MAX_BITS}
    found = pa.Table.from_batches(line_dedup._first_pairs(iter([batch]), 80)).to_pylist()
    pairs = {tuple(sorted((r["a"], r["b"]))) for r in found if r["b"] is not None}
    back = {(r["block"], r["a"]) for r in found if r["b"] is None}
    assert pairs < near
    assert all((a, b) in pairs or {(block[a], a), (block[b], b)} <= back for a, b in near)
    assert len(pairs) <= line_dedup.SMALL_RUN * len(block)


def test_latent_space_sums_every_passage(spark):
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), F.lit("one two three two " * 5).alias("text"))
    parts = decontaminate.item_parts([(1, "one two three four", None)])
    vocabulary = decontaminate.Vocabulary(parts)
    weights = np.array([1.0, 2.0, 3.0, 4.0])
    codes, values, steps = decontaminate.gram_sums(docs, vocabulary, weights, 5.0, "text")
    assert steps == 10_000  # two of 16 words at most a document
    at = vocabulary.index(np.array(decontaminate._hashes("one two three two " * 5), np.uint64))
    want = np.zeros((4, 4))
    for words in (at[:16], at[16:]):
        row = np.bincount(words, weights[words], 4)
        want += 5_000 * np.outer(row, row) / (weights[words] ** 2).sum()
    got = np.zeros((4, 4))
    got[codes // 4, codes % 4] = values
    got = got + np.triu(got, 1).T
    assert np.allclose(got, want, rtol=1e-5)


def test_term_counts_are_one_row_a_task(spark, monkeypatch):
    made = []

    def watched(df, work, schema):
        made.append(df.mapInArrow(work, schema))
        return made[-1]

    monkeypatch.setattr(pii, "map_arrow", watched)
    docs = spark.range(0, 3_000, 1, 1).select(F.repeat(F.lit("alpha beta "), 100).alias("text"))
    wanted = spark.createDataFrame([(int(np.uint64(tokens.hash_word(w)).view(np.int64)) if tokens.hash_word(w) > 2**63 else tokens.hash_word(w),) for w in ("alpha", "beta")], "term long")
    counts, total = pii.word_counts(docs, wanted)
    assert total == 600_000 and sorted(r["n"] for r in counts.collect()) == [300_000, 300_000]
    assert made[0].count() == 3


def test_sums_are_the_same_with_and_without_cells(spark, monkeypatch):
    docs = spark.range(50).select(F.concat_ws(" ", F.lit("one two three two four"), F.col("id") % 7).alias("text"))
    vocabulary = decontaminate.Vocabulary(decontaminate.item_parts([(1, "one two three four 5", None)]))
    weights = np.array([1.0, 2.0, 3.0, 4.0, 5.0])
    one = decontaminate.gram_sums(docs, vocabulary, weights, 5.0, "text")
    monkeypatch.setattr(decontaminate, "GRAM_CELLS", 1)
    two = decontaminate.gram_sums(docs, vocabulary, weights, 5.0, "text")
    assert one[2] == two[2] == 50 and one[0].tolist() == two[0].tolist() and np.allclose(one[1], two[1])


def test_word_counts_spare_sequences_and_lose_no_passage():
    """Clean windows that share common words with an item go without a sequence check; whatever reaches min_lcs gets one."""
    rng = np.random.default_rng(5)
    words = np.array([f"w{k}" for k in range(60)])
    items = [(k, " ".join(rng.choice(words, size)), None) for k, size in enumerate((1, 2, 9, 40, 48, 100))]
    parts = decontaminate.item_parts(items)
    vocabulary = decontaminate.Vocabulary(parts)
    texts = [items[3][1], " ".join(rng.choice([*words, "x", "y"], 90)), "w1 w1 w1", "", " ".join(rng.choice(["x", "w3", "w4"], 70)), items[5][1] + " x"]
    for part in parts:
        held = rng.permutation(len(part.words))[: len(part.words) // 4]
        texts.append(" ".join("x" if k in held else w for k, w in enumerate(items[part.item][1].split())))
    raw = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, raw)])
    chunk = tokens.Chunk(0, np.frombuffer(b"".join(raw), np.uint8), bounds)
    passages = decontaminate.Passages(chunk, vocabulary, np.ones(len(vocabulary.hashes), np.float32), 1.0)
    wanted = [int(np.searchsorted(vocabulary.hashes, h)) if h in vocabulary.hashes else -1 for h in passages.hash]
    assert passages.at.tolist() == wanted
    rows, k = (x.ravel() for x in np.meshgrid(np.flatnonzero(np.diff(passages.ptr)), np.arange(len(parts))))
    low, high = passages.ptr[rows], passages.ptr[rows + 1]
    least = np.array([-(-7 * len(p.words) // 10) for p in parts])
    may = decontaminate._may_hold(passages, decontaminate._part_words(parts, vocabulary), least, low, high, k)
    found = [decontaminate.Lcs(parts[p].words).with_(passages.hash[a:b].tolist()) >= least[p] for p, a, b in zip(k, low, high)]
    assert any(found) and not (np.array(found) & ~may).any()
    assert may.sum() < len(may) // 2
