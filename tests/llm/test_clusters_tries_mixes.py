"""Centroid clustering, the conversation trie and the source mix against brute force, on edge cases and on hot groups."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import centroids, conversation_trie, mixing
from llm_fixtures import SCHEMA, edge_docs, no_docs  # noqa: F401

# --- centroid clustering


def brute_clusters(rows, k=8, rounds=10, dims=64):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [int(np.floor(1024 * float(x))) for x in v]))
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    cs = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        cs = [[sum(x) // len(x) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(cs)]
    out = [(vec_id, *nearest(v)[::-1]) for vec_id, v in kept]
    by = defaultdict(int)
    for _, c, d in out:
        by[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(((i, c, d, by[c], sum(by.values()), digest[c]) for i, c, d in out), key=key)


def clusters(df, **more):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r) for r in centroids.cluster(df, **more).collect()), key=key)


VECTORS = "vec_id long, embedding array<float>, cluster string, v string, part string, distance string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], VECTORS).repartition(3)


def random_vectors(n, dims=64, seed=1):
    r = np.random.default_rng(seed)
    spots = r.normal(size=(5, dims))
    return [(i, [float(np.float32(x)) for x in spots[i % 5] + 0.7 * r.normal(size=dims)]) for i in range(n)]


def test_clusters_equal_brute_force(spark):
    rows = random_vectors(120)
    assert clusters(vectors(spark, rows)) == brute_clusters(rows)


def test_clusters_of_odd_vectors(spark):
    rows = random_vectors(30)
    good = rows[3][1]
    rows += [(100, None), (101, []), (102, good[:63]), (103, good + [0.5]), (104, [None, *good[1:]]), (105, [float("nan"), *good[1:]])]
    rows += [(106, [float("inf"), *good[1:]]), (107, [float("-inf"), *good[1:]]), (3, good), (None, good), (None, good), (108, [-0.0004] * 64)]
    assert clusters(vectors(spark, rows)) == brute_clusters(rows)


def test_equal_vectors_go_to_the_smallest_number_and_empty_clusters_stay(spark):
    rows = [(i, [0.25] * 64) for i in range(40)] + [(40 + i, [1.0 + i] * 64) for i in range(3)]
    found = clusters(vectors(spark, rows))
    assert found == brute_clusters(rows)
    assert len({r[1] for r in found[:40]}) == 1


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = random_vectors(3)
    assert clusters(vectors(spark, rows)) == brute_clusters(rows)
    none = centroids.cluster(vectors(spark, rows).limit(0))
    assert none.collect() == []
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_huge_components_are_cut_to_the_limit(spark):
    most = float(centroids.limit(64) // 1024)
    rows = [(0, [3e38] * 64), (1, [-3e38] * 64), (2, [0.0] * 64)]
    cut = [(i, [min(max(x, -most), most) for x in v]) for i, v in rows]
    assert clusters(vectors(spark, rows), k=2) == brute_clusters(cut, k=2)


def test_tournament_names_the_nearest_centroid_with_ties_to_the_smaller():
    r = np.random.default_rng(5)
    for _ in range(50):
        cs = r.integers(-3, 4, size=(7, 4))
        x = r.integers(-4, 5, size=(60, 4))
        won = centroids.Bisectors.of(cs.tolist()).winners(x)
        distances = ((x[:, None, :] - cs[None]) ** 2).sum(axis=2)
        assert (won == distances.argmin(axis=1)).all()  # argmin gives the first of equals
    with pytest.raises(ValueError):
        centroids.cluster(None, k=centroids.MAX_CENTROIDS + 1)


# --- conversation trie


def brute_trie(rows):
    """rows: (conv_id, turn, role, text); turns tie by the digest of role and text."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            by[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    turns = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in by.items()}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        whole[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for p, own in members.items():
        n_words = len([w for w in p[-1][1].translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(own) - 1) * n_words
            leaves[p[:d]] += children[p] == 0
    out = []
    for p, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(whole[c]) == len(p))
        out.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def trie(df, **more):
    convs, turns = conversation_trie.rebuild(conversation_trie.ranked(df))
    return sorted((tuple(r) for r in conversation_trie.prefix_trie(convs, turns, **more).collect()), key=lambda r: (r[1], r[0]))


TURNS = "conv_id long, turn long, role string, text string, rank string, digest string, words string, k string, pos string, key string"


def turn_rows(spark, rows, parts=4):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], TURNS).repartition(parts)


def random_turns(seed, convs=60, words=("a", "b c", "d  e\tf")):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"]) if t > 2 else "user", r.choice(words)) for c in range(convs) for t in range(r.randrange(0, 12))]


@pytest.mark.parametrize("seed, block", [(1, 4), (2, 4), (3, 1), (4, 3)])
def test_trie_equals_brute_force(spark, seed, block):
    rows = random_turns(seed)
    assert trie(turn_rows(spark, rows), block=block) == brute_trie(rows)


def test_trie_of_odd_turns(spark):
    rows = [
        (0, 0, "user", "hi there"), (0, 1, "assistant", None), (0, 2, None, ""), (0, None, "user", "first"),
        (1, 0, "user", "x"), (1, 0, "user", "y"), (1, 0, "user", "y"), (20, 5, "a", "b"), (21, 1, "a", "b"), (-3, 0, "a", "b c"),
        (None, 0, "user", "lost"), (45, 0, "ab", "c"), (46, 0, "a", "bc"), (47, 0, "a", "bc"), (2**40, 0, "", ""),
    ]
    assert trie(turn_rows(spark, rows)) == brute_trie(rows)


def test_long_conversations_and_one_conversation_in_many_partitions(spark):
    long = [(c, t, "user", f"turn {t}") for c in (5, 6) for t in range(700)] + [(7, t, "user", f"turn {t}" if t < 650 else "other") for t in range(660)]
    rows = long + random_turns(9, convs=5)
    rows = [r for r in rows if r[0] not in (5, 6, 7)] + long
    found = trie(turn_rows(spark, rows, parts=16))
    slow = {(r[1], r[0]): r for r in found}
    assert len(slow) == len(found)
    assert found == brute_trie(rows)


def test_many_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 40_000, 20) for t in range(3)]
    found = trie(turn_rows(spark, rows))
    n = 2000
    ids = hashlib.sha256(",".join(str(c) for c in range(0, 40_000, 20)).encode()).hexdigest()
    none = hashlib.sha256(b"").hexdigest()
    assert found == [(0, d, 0 if d else None, n, int(d < 3), 1, (n - 1) * 2 * (3 - max(d - 1, 0)), ids if d == 3 else none) for d in range(4)]


def test_no_conversations(spark):
    assert trie(turn_rows(spark, [(1, 1, "a", "b")]).limit(0)) == []


# --- source mix


def brute_targets(sizes, weights, share=1.0, most=3):
    budget, fixed = sum(sizes.values()) * share, {}
    while True:
        open_ = {s: w for s, w in weights.items() if s not in fixed}
        left = budget - sum(fixed.values())
        target = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = {s for s in target if target[s] > most * sizes[s]}
        if not over:
            return fixed | target
        fixed |= {s: float(most * sizes[s]) for s in over}
        if len(fixed) == len(weights):
            return fixed


def brute_mix(rows, share=1.0):
    """rows: (doc_id, source, text). (doc_id, size, source_size, target, taken), sorted."""
    ids = [(i, s, len([w for w in (t or "").translate({k: " " for k in range(9, 14)}).split(" ") if w]), hashlib.md5(f"13:{'' if i is None else i}:{t or ''}".encode()).hexdigest()) for i, s, t in rows]
    names = sorted({s for _, s, *_ in ids}, key=lambda s: (s is None, s))
    sizes = {s: sum(n for _, x, n, _ in ids if x == s) for s in names}
    targets = brute_targets(sizes, {s: k % 3 + 1 for k, s in enumerate(names)}, share)
    copies = []
    for k, s in enumerate(names):
        upto = 0
        for epoch in (1, 2, 3):
            for at, (i, x, n, h) in sorted(enumerate(ids), key=lambda e: (e[1][3], e[0])):
                if x == s and n:
                    if upto < targets[s]:
                        copies.append(((upto + n) / targets[s], k, epoch, h, at, n))
                    upto += n
    spent, taken = 0, defaultdict(int)
    for *_, at, n in sorted(copies):
        spent += n
        if spent <= sum(sizes.values()) * share:
            taken[at] += n
    return sorted(((str(i), n, sizes[s], round(targets[s], 6), taken[at]) for at, (i, s, n, _) in enumerate(ids)))


def mixed(df, **more):
    return sorted((str(r["doc_id"]), r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in mixing.mix(df, **more).collect())


def mix_rows(seed, n=300):
    r = random.Random(seed)
    sources = [None, "", "a", "b", "ab", "Z", "é"]
    return [(i, r.choice(sources) if i % 3 else "hot", " ".join(["w"] * r.randrange(0, 30))) for i in range(n)]


MIXED = "doc_id long, source string, text string, row string, size string, part_ string, before string, words string, weight string"


def mix_docs(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], MIXED).repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_equals_brute_force(spark, seed):
    rows = mix_rows(seed)
    assert mixed(mix_docs(spark, rows)) == brute_mix(rows)


def test_mix_of_half_the_words(spark):
    rows = mix_rows(3)
    assert mixed(mix_docs(spark, rows), share=0.5) == brute_mix(rows, 0.5)


def test_mix_meets_its_targets_and_repeats_nothing_more_than_three_times(spark):
    rows = mix_rows(4, 900)
    found = mixing.mix(mix_docs(spark, rows))
    longest = max(len(t.split()) for *_, t in rows)
    by = found.groupBy("target", "source_size").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) <= longest for r in by)
    assert found.where("taken > 3 * size or (size > 0 and taken % size <> 0)").count() == 0


def test_mix_of_odd_documents(spark, edge_docs, no_docs):  # noqa: F811
    rows = [(r["doc_id"], r["source"], r["text"]) for r in edge_docs.collect()]
    assert mixed(edge_docs) == brute_mix(rows)
    carried = mixing.mix(edge_docs, carry=("doc_id", "n_chars", "row", "kept"))
    assert carried.columns == ["doc_id", "n_chars", "row", "kept", "size", "source_size", "target", "taken"]
    assert mixing.mix(no_docs).collect() == []
    blank = spark.createDataFrame([(1, None, "en", "a", 0), (2, " \n", "en", None, 0)], SCHEMA)
    assert mixed(blank) == [("1", 0, 0, 0.0, 0), ("2", 0, 0, 0.0, 0)]


def test_rows_equal_in_id_and_text(spark):
    rows = [(1, "a", "x y z")] * 40 + [(2, "b", "x y")] * 3 + [(None, "b", "x")] * 4
    found = mixed(mix_docs(spark, rows))
    assert found == mixed(mix_docs(spark, rows)) == brute_mix(rows)


def test_reruns_agree_however_the_rows_lie(spark):
    rows = mix_rows(6)
    assert mixed(mix_docs(spark, rows)) == mixed(mix_docs(spark, rows[::-1]).repartition(11))


def test_the_mix_runs_no_python(spark):
    plan = mixing.mix(mix_docs(spark, mix_rows(7)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
