"""Joins, line groups, retrieval and classifiers against brute force and held-out rows; the pipeline."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import SF_SMALL, edge_docs, no_docs  # noqa: F401

import corpus_pipeline
from shelfwise.llm import decontaminate, line_dedup, ngram_join, pu_quality, queries, tokens, toxicity
from shelfwise.llm.common import components, in_bitmap, membership_bitmap

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def find(parent, x):
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def groups(nodes, links):
    parent = {}
    for a, b in links:
        parent[find(parent, a)] = find(parent, b)
    out = defaultdict(list)
    for n in nodes:
        out[find(parent, n)].append(n)
    return list(out.values())


def test_components_of_paths_stars_and_cycles(spark):
    random.seed(4)
    edges = [(k, k + 1) for k in range(100, 160)] + [(0, k) for k in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    edges += [(random.randrange(300, 400), random.randrange(300, 400)) for _ in range(60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert got == {n: min(g) for g in groups(nodes, edges) for n in g}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmap_has_no_false_negatives(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63, 5000)
    bitmap = membership_bitmap(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k")
    assert in_bitmap(bitmap, keys).all()
    assert in_bitmap(bitmap, keys + 64).mean() < 0.05


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) or frozenset([tuple(words)] if words else [])


def plain_components(rows, size, percent):
    sets = {k: shingles(t, size) for k, t in rows}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {k: (len(sets[k]), min(g)) for g in groups(sets, links) for k in g}


def edited(words, count, rng):
    words = list(words)
    for _ in range(count):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_join_finds_every_component(spark):
    rng = random.Random(3)
    rows = []
    passage = [f"p{k}" for k in range(40)]
    for base in range(6):
        words = [f"b{base}w{k}" for k in range(rng.choice([30, 120]))]
        rows += [edited(words, rng.randrange(0, 5), rng) for _ in range(rng.choice([5, 40]))]
        chain = words
        for _ in range(8):
            chain = edited(chain, 1, rng)
            rows.append(chain)
    rows += [passage + [f"u{k}x{j}" for j in range(60)] for k in range(30)]
    rows += [["a", "b"], ["A", "b"], ["a"], []]
    rows = [(k, " ".join(w)) for k, w in enumerate(rows)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for size, percent in ((4, 85), (5, 80)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs, size, percent).collect()}
        assert got == plain_components(rows, size, percent)


def test_join_edge_cases(edge_docs, no_docs):
    rows = ngram_join.near_duplicates(edge_docs, 4, 85).collect()
    assert len(rows) == edge_docs.count()
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows}
    assert {(2, 0, 2), (3, 0, 3), (7, 0, 7), (5, 11, 5), (6, 11, 5), (None, 11, 5)} <= got
    assert ngram_join.near_duplicates(no_docs).count() == 0


def normal(line):
    return tuple(re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[0-9]", "0", line.translate(FOLD))))


def simhash(words):
    hashes = np.array([tokens.hash_word(w, line_dedup.LINE_WORDS) for w in words], np.int64).view(np.uint8).reshape(-1, 8)
    ones = np.unpackbits(hashes, axis=1).sum(axis=0, dtype=int)
    return int.from_bytes(np.packbits(2 * ones > len(words)).tobytes(), "big")


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_removed(rows, percent=80):
    places = defaultdict(list)
    for k, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            if normal(line):
                places[normal(line)].append((k, n))
    keys = list(places)
    sims = [simhash(k) for k in keys]
    links = [
        (keys[i], keys[j])
        for i in range(len(keys))
        for j in range(i)
        if (sims[i] ^ sims[j]).bit_count() <= line_dedup.MAX_BITS
        and 100 * levenshtein(keys[i], keys[j]) <= (100 - percent) * max(len(keys[i]), len(keys[j]))
    ]
    out = defaultdict(list)
    for group in groups(keys, links):
        for k, n in sorted(p for key in group for p in places[key])[1:]:
            out[k].append(n)
    return {k: sorted(v) for k, v in out.items()}


def edited_numbers(line, edits, rng):
    line = list(line)
    for _ in range(edits):
        at = rng.randrange(len(line))
        line[at : at + rng.randrange(2)] = rng.choice([[], [rng.randrange(1000, 2000)]])
    return line


def test_line_groups_equal_brute_force(spark):
    rng = random.Random(8)
    base = [[f"l{b}w{k}" for k in range(rng.choice([3, 30, 90]))] for b in range(12)]
    rows = []
    for k in range(60):
        lines = [" ".join(edited(rng.choice(base), rng.randrange(0, 3), rng)) for _ in range(4)]
        rows.append((k, "\n".join([*lines, "", f"Page {k}", "..."])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["removed"] for r in line_dedup.removed_lines(docs).collect()}
    assert got == plain_removed(rows)
    texts = {r["doc_id"]: r["text"] for r in line_dedup.deduplicate(docs).collect()}
    for k, text in rows:
        assert texts[k] == "\n".join(x for n, x in enumerate(text.split("\n")) if n not in got.get(k, []))


def test_edited_lines_are_found(spark):
    """Recall against edit similarity alone, by length and share of changed words."""
    rng = random.Random(12)
    vocabulary = [f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(4000)]
    words = lambda n: [vocabulary[int(4000 ** rng.random()) - 1] for _ in range(n)]
    rows, kinds = [], defaultdict(list)
    for size in (5, 8, 10, 14, 20, 30, 50, 90, 180):
        for share in (0.1, 0.2):
            for _ in range(60):
                line = words(size)
                other = list(line)
                for at in rng.sample(range(size), max(1, int(size * share))):
                    other[at] = rng.choice(vocabulary)
                k = len(rows)
                rows += [(k, " ".join(line)), (k + 1, " ".join(other))]
                if 5 * levenshtein(line, other) <= size and line != other:
                    kinds[size, share].append(k + 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"] for r in line_dedup.removed_lines(docs).collect()}
    recall = {kind: np.mean([k in got for k in pairs]) for kind, pairs in kinds.items()}
    print(recall)
    assert min(recall.values()) >= 0.8 and np.mean(list(recall.values())) >= 0.95


def test_large_blocks_lose_no_link(monkeypatch):
    monkeypatch.setattr(line_dedup, "SMALL_RUN", 2)
    rng = np.random.default_rng(2)
    key, n = np.arange(40), np.full(40, 30, np.int32)
    flips = np.array([sum(1 << int(b) for b in rng.choice(40, rng.integers(0, 4), replace=False)) for _ in key], np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(40, np.int32)), pa.array(key), pa.array(flips), pa.array(n)], names=["mask", "key", "sim", "n"])
    monkeypatch.setattr(line_dedup, "_MASKS", np.zeros(1, np.int64))
    near = {(i, j) for i in range(40) for j in range(40) if i < j and int(flips[i] ^ flips[j]).bit_count() <= line_dedup.MAX_BITS}
    found = pa.Table.from_batches(line_dedup._first_pairs(iter([batch]), 80)).to_pylist()
    first = {tuple(sorted((r["a"], r["b"]))) for r in found if r["b"] is not None}
    waiting = [r for r in found if r["b"] is None]
    assert first < near and len(waiting) == 40


def test_links_across_components_lose_no_link(spark, monkeypatch):
    """Lines of one block: the components are those of all pairs, however the block is cut into cells."""
    rng = random.Random(5)
    base = [list(range(100 * b, 100 * b + 30)) for b in range(3)]
    lines = {tuple(edited_numbers(rng.choice(base), rng.randrange(0, 8), rng)) for _ in range(150)}
    lines = dict(enumerate(sorted(lines)))
    near = [(a, b) for a in lines for b in lines if a < b and 5 * levenshtein(lines[a], lines[b]) <= max(len(lines[a]), len(lines[b]))]
    first = [p for p in near if p[0] % 3 == p[1] % 3 == 0]
    component = {k: min(g) for g in groups(list(lines), first) for k in g}
    waiting = spark.createDataFrame([(1, k, 0, len(x), component[k]) for k, x in lines.items()], "block long, key long, sim long, n int, component long")
    sequences = spark.createDataFrame([(k, list(x)) for k, x in lines.items()], "key long, words array<int>")
    want = {tuple(sorted(g)) for g in groups(list(lines), near)}
    for size in (1 << 19, 1500):
        monkeypatch.setattr(line_dedup, "CELL_WORDS", size)
        links = [(r["a"], r["b"]) for r in line_dedup._links_across(waiting, sequences, 80).collect()]
        assert links and set(map(tuple, map(sorted, links))) <= set(near)
        assert {tuple(sorted(g)) for g in groups(list(lines), first + links)} == want


def test_shared_blocks_are_found_across_batches():
    rng = random.Random(4)
    rows = sorted((rng.randrange(60), rng.randrange(4)) for _ in range(120))
    want = [r for r in dict.fromkeys(rows) if len({k for b, k in rows if b == r[0]}) > 1]
    for size in (1, 2, 7, 200):
        cuts = [rows[k : k + size] for k in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*cut)], names=["block", "key"]) for cut in cuts]
        got = [(r["block"], r["key"]) for r in pa.Table.from_batches(line_dedup._shared(iter(batches))).to_pylist()]
        assert got == want, size


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(3000):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(13))] for _ in range(2))
        assert line_dedup.edit_distance(a, b) == levenshtein(a, b)


def test_line_edge_cases(edge_docs, no_docs):
    out = line_dedup.deduplicate(edge_docs).collect()
    assert len(out) == edge_docs.count()
    by_id = defaultdict(list)
    for r in out:
        by_id[r["doc_id"]].append((r["text"], r["n_removed"]))
    assert by_id[2] == [(None, 0)] and by_id[3] == [("", 0)]
    assert by_id[8] == [("One. two\nthree\n\nthree 4444 5555", 1)]
    # Repeats of a whole row are one document; its copies elsewhere lose the line.
    assert len(by_id[5]) == 2 and all(n == 0 for _, n in by_id[5])
    assert by_id[6] == [("", 1)] and by_id[None] == [("", 1)]
    assert line_dedup.deduplicate(no_docs).count() == 0


def test_leaks_are_found_and_chance_is_not(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    common = ["the", "of", "and", "in", "to"]
    words = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(n)]
    items = [(k, words(rng.randrange(15, 120))) for k in range(40)]
    rows, planted = [], set()
    for k in range(400):
        body = words(rng.randrange(20, 400))
        if k % 5 == 0:
            item, text = items[rng.randrange(40)]
            passage = list(text)
            if k % 10 == 0:  # a paraphrase: every ninth word is another
                passage[::9] = words(len(passage[::9]))
            at = rng.randrange(len(body))
            body[at:at] = passage
            planted.add((k, item))
        rows.append((k, " ".join(body)))
    rows += [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items] + [(70, ""), (71, None)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert len(planted - found) <= 0.1 * len(planted)
    assert found <= planted
    blocks = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark, decontaminate.Search(block_items=15)).collect()}
    assert len(planted - blocks) <= 0.1 * len(planted) and blocks <= planted
    assert decontaminate.leaks(docs.limit(0), benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0


def test_common_subsequences():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 13))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.Lcs(a).with_(b) == table[-1, -1]


def test_quality_on_held_out_rows(spark):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    scored = queries.op4_pu_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.9
    assert scored.count() == 1000 and scored.where("score < 0 or score > 1 or score is null").isEmpty()


def test_class_prior_and_risk():
    rng = np.random.default_rng(3)
    fit = pu_quality.Fit(steps=200)
    pos = np.column_stack([rng.normal(1.5, 1, (3000, 1)), np.ones(3000)])
    unl = np.column_stack([np.concatenate([rng.normal(1.5, 1, (1800, 1)), rng.normal(-1.5, 1, (1200, 1))]), np.ones(3000)])
    prior = pu_quality.class_prior(pos, unl, fit)
    assert 0.55 <= prior <= 0.75
    score = unl @ pu_quality.minimise_risk(pos, unl, 0.6, fit)
    assert ((score > 0) == (np.arange(3000) < 1800)).mean() > 0.9


@pytest.mark.parametrize("with_labels", [True, False])
def test_classifiers_on_edge_cases(spark, edge_docs, no_docs, with_labels):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (10, 0, 1), (77, 1, 1), (None, 1, 1)] if with_labels else [], "doc_id long, quality int, toxic int")
    model = pu_quality.fit_model(edge_docs, labels.where("quality = 1"))
    scored = pu_quality.score_documents(edge_docs, model).collect()
    assert len(scored) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    kinds = toxicity.kinds_of_toxicity(edge_docs, labels)
    chain = toxicity.fit_chain(edge_docs, kinds, ("insult", "contempt", "toxic"), toxicity.Fit(min_docs=1, min_chi=0.0))
    out = toxicity.score_documents(edge_docs, chain).collect()
    assert len(out) == edge_docs.count() and all(0 <= r["p_toxic"] <= 1 for r in out)
    if with_labels:
        p = {r["doc_id"]: r["p_toxic"] for r in out}
        assert p[10] > p[1]
    assert pu_quality.score_documents(no_docs, model).count() == toxicity.score_documents(no_docs, chain).count() == 0


def test_chain_uses_earlier_categories():
    """The second category can only be read off the first one's probability."""
    rng = np.random.default_rng(4)
    x = (rng.random((600, 30)) < 0.2).astype(np.float32)
    first = x[:, 0]
    y = np.column_stack([first, first])
    weights = toxicity.train_chain(x, y, np.arange(600) % 3, toxicity.Fit())
    assert [len(w) for w in weights] == [31, 32] and weights[1][30] > 0
    chain = toxicity.Chain(("a", "b"), np.arange(30), weights)
    p = chain.probabilities(x.astype(bool))
    assert ((p > 0.5) == y.astype(bool)).all()


def test_pipeline_equals_its_parts(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    rows = out.collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    judged = {r["doc_id"] for r in queries.op9_host_rules(spark, SF_SMALL).where("kept").collect()}
    kept = sorted((k, docs[k]["text"]) for k in judged)
    removed = plain_removed(kept)
    left = {}
    for k, text in kept:
        lines = [x for n, x in enumerate(text.split("\n")) if n not in removed.get(k, [])]
        if k not in removed or any(normal(x) for x in lines):
            left[k] = "\n".join(lines)
    group = plain_components(left.items(), corpus_pipeline.SHINGLE, corpus_pipeline.SIMILAR)
    left = {k: t for k, t in left.items() if group[k][1] == k}
    frame = spark.createDataFrame(list(left.items()), "doc_id long, text string")
    leaked = {r["doc_id"] for r in decontaminate.leaks(frame, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
    assert {r["doc_id"]: r["text"] for r in rows} == {k: t for k, t in left.items() if k not in leaked}
    assert all(r["round_trip"] and r["n_chars"] == len(r["text"]) for r in rows)


def test_one_row_of_each_group_stays(spark):
    body = [f"w{k}" for k in range(60)]
    near = " ".join([*body, "more"])
    lone, other = (" ".join(f"{c}{k}" for k in range(30)) for c in "no")
    rows = [(1, " ".join(body)), (1, " ".join(body)), (1, near), (2, near), (None, near)]
    rows += [(None, lone), (None, lone), (None, lone + " end"), (9, other), (8, ""), (8, ""), (None, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SF_SMALL).collect()]
    by_id = defaultdict(list)
    for k, text in out:
        by_id[k].append(text)
    assert len(by_id[1]) == 1 and by_id[1][0] in (" ".join(body), near) and by_id[2] == []
    assert by_id[9] == [other] and by_id[8] == ["", ""]
    assert len(by_id[None]) == 2 and None in by_id[None] and len(out) == 6


def test_stages_take_edge_cases(spark, edge_docs, no_docs):
    for docs in (edge_docs.select(*corpus_pipeline.COLUMNS), no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            if name != "byte_bpe":
                assert out.columns == list(corpus_pipeline.COLUMNS)
            assert out.count() <= docs.count()
