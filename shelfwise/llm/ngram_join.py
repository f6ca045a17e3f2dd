"""Jaccard self-join of documents on word n-grams by vertical partitioning.

All n-grams follow one global order (rare first). The order is cut into fragments;
a pair's overlap is counted in each fragment apart and summed. Pairs to count come from
the prefixes of the ordered sets: two sets that are similar enough share
a rare n-gram there. Documents with equal sets form a class, and only
classes are joined.

1. *Signatures*, one pass over the texts: size, class digest and the smallest
   hashes of each set, written without texts.
2. *Survivors*: a set whose n-grams are mostly seen in no other class has no partner.
   A fixed share of its hashes, long enough to prove that, is counted over the corpus.
   N-grams that repeat within a task travel as one row, so a passage that many
   documents share isn't a hot key.
3. *Sets* of the survivors, from a second pass that a bitmap of fixed size narrows.
4. *Rounds* of pairs, counted by fragment: first each member of a prefix n-gram's
   block with the block's hub (the member with the fewest n-grams of its own); then
   all pairs of a block that may still join two components. Pairs that
   would link what is linked already are never made, so a large group of near copies
   costs as many pairs as it has members.

The components are exact for 64-bit hashes: no pair that may reach the
threshold and join two components is left out.

Nulls and edges: a text without words (or null) has the empty set and is its own
component; with fewer words than n, the whole sequence is its one n-gram; repeated rows are
members of one class; documents with a null id take their component's smallest
id (null if they are alone); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm import tokens
from shelfwise.llm.common import components, in_bitmap, map_arrow, materialise, membership_bitmap, row_key

#: Hashes that a task gathers before it hands back those it saw once.
GATHER = 1 << 20
#: Fragments of the global order, at most.
FRAGMENTS = 8


def _least_shared(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """n-grams that a set of n must share with a partner: the least whole number of percent of n."""
    return -(-n * percent // 100)


def shingle_sets(chunk: tokens.Chunk, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes (int64) of each row of a chunk."""
    found = tokens.words(chunk.data, chunk.bounds, tokens.SPACED)
    grams = tokens.combine(found.hash, size).view(np.int64)
    for first, last in zip(found.ptr[:-1].tolist(), found.ptr[1:].tolist()):
        if last - first >= size:
            own = grams[first : last - size + 1].copy()
            own.sort()
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif last > first:
            yield tokens.combine(found.hash[first:last], last - first).view(np.int64)
        else:
            yield grams[:0]


def _digest(own: np.ndarray) -> int:
    """64-bit digest of a sorted set."""
    if len(own) == 0:
        return 0
    bits = own.view(np.uint64)
    total = (tokens.mix(bits) * (tokens.mix(bits + np.uint64(0x51ED270B)) | np.uint64(1))).sum(dtype=np.uint64)
    return int(tokens.mix(np.array([total + np.uint64(len(own))], np.uint64)).view(np.int64)[0])


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def signatures(docs: DataFrame, size: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, n, class, sample): the sample is the smallest hashes, 5 % more than may be unshared."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in tokens.chunks(batch.column("_text")):
                sets = list(shingle_sets(chunk, size))
                n = np.array([len(s) for s in sets], np.int64)
                spare = n - _least_shared(n, percent)
                take = np.minimum(n, spare + np.maximum(1, n // 20))
                rows = slice(chunk.first, chunk.first + chunk.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[rows],
                        batch.column("row")[rows],
                        pa.array(n),
                        pa.array([_digest(s) for s in sets], pa.int64()),
                        _lists([s[:k] for s, k in zip(sets, take.tolist())]),
                    ],
                    names=["doc_id", "row", "n", "class", "sample"],
                )

    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), body).alias("row"), body.alias("_text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return map_arrow(source, work, f"doc_id {kind}, row long, n long, class long, sample array<long>")


def survivors(signed: DataFrame, percent: int) -> DataFrame:
    """Classes (class, n, row of one member) whose sample holds enough n-grams of other classes.

    In a set of n, at most n - _least_shared(n) n-grams may be unshared, so of its sample
    of k at least k minus that many must be shared. Counts err upwards only.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            classes = np.repeat(np.fromiter(seen, np.int64, len(seen)), [len(s) for s in seen.values()])
            hashes = np.concatenate(list(seen.values()))
            order = np.argsort(hashes, kind="stable")
            hashes, classes = hashes[order], classes[order]
            same = hashes[1:] == hashes[:-1]
            shared = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            own, counts = np.unique(classes[shared], return_counts=True)
            common, alone = np.unique(hashes[shared]), ~shared
            a, b, c = len(common), int(alone.sum()), len(own)
            void = lambda n: np.ones(n, dtype=bool)
            zero = np.zeros
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((common, hashes[alone], own))),
                    pa.array(np.concatenate((zero(a, np.int64), classes[alone], own)), mask=np.concatenate((void(a), zero(b + c, bool)))),
                    pa.array(np.concatenate((zero(a + b, np.int64), counts)), mask=np.concatenate((void(a + b), zero(c, bool)))),
                ],
                names=["hash", "class", "known"],
            )

        for batch in batches:
            samples = batch.column("sample")
            flat, ends = samples.values.to_numpy(), samples.offsets.to_numpy()
            for k, label in enumerate(batch.column("class").to_pylist()):
                if label not in seen:
                    seen[label] = flat[ends[k] : ends[k + 1]].copy()
                    held += len(seen[label])
                if held >= GATHER:
                    yield flush()
                    seen, held = {}, 0
        if seen:
            yield flush()

    sampled = signed.where("n > 0").select("class", "sample")
    found = map_arrow(sampled, gather, "hash long, class long, known long")
    same = Window.partitionBy("hash")
    marked = found.select(
        "class",
        "known",
        (
            F.max(F.col("class").isNull()).over(same)
            | (F.min("class").over(same) != F.max("class").over(same))
        ).alias("shared"),
    )
    counts = (
        marked.where("class is not null and (shared or known is not null)")
        .groupBy("class")
        .agg(F.sum(F.coalesce("known", F.lit(1))).alias("shared"))
    )
    classes = (
        signed.where("n > 0")
        .groupBy("class")
        .agg(F.first("n").alias("n"), F.min("row").alias("row"), F.max(F.size("sample")).alias("k"))
    )
    need = F.col("k") - (F.col("n") - F.ceil(F.col("n") * percent / 100))
    return classes.join(counts, "class").where(F.col("shared") >= need).select("class", "n", "row")


def full_sets(docs: DataFrame, wanted: DataFrame, size: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(class, n, grams) of the rows in ``wanted``; a bitmap keeps most other texts out."""
    bitmap = docs.sparkSession.sparkContext.broadcast(membership_bitmap(wanted, "row"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            picked = batch.filter(pa.array(in_bitmap(bitmap.value, rows)))
            for chunk in tokens.chunks(picked.column("_text")):
                keys = picked.column("row")[chunk.first : chunk.first + chunk.rows]
                yield pa.RecordBatch.from_arrays([keys, _lists(list(shingle_sets(chunk, size)))], names=["row", "grams"])

    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(row_key(F.col(doc_id), body).alias("row"), body.alias("_text"))
    sets = map_arrow(source, work, "row long, grams array<long>")
    return wanted.join(sets, "row").groupBy("class", "n").agg(F.max("grams").alias("grams"))


def _order_key(g: Column) -> Column:
    """One long that sorts like (df, gram) as far as the gram's upper 41 bits tell."""
    count = F.least(g["df"], F.lit((1 << 21) - 1))
    return F.shiftleft(count, 41) + F.shiftright(g["gram"], 23) + F.lit(1 << 40)


def _may_link(percent: int, shared: Column, n: Column, m: Column) -> Column:
    """Whether an overlap of ``shared`` reaches the threshold for set sizes n and m."""
    return 100 * shared >= percent * (n + m - shared)


class _Overlaps:
    """Counts overlaps of pairs of classes, fragment by fragment."""

    def __init__(self, ordered: DataFrame, percent: int) -> None:
        """``ordered``: (class, n, grams), grams an array of (df, gram) in global order."""
        self._percent = percent
        keys = ordered.select(F.explode("grams").alias("g")).select(_order_key(F.col("g")).alias("k"))
        cuts = keys.agg(F.percentile_approx("k", [i / FRAGMENTS for i in range(1, FRAGMENTS)], 1000)).first()[0]
        cuts = sorted(set(cuts or []))

        def inside(low: int | None, high: int | None) -> Column:
            def picked(g: Column) -> Column:
                above = F.lit(True) if low is None else _order_key(g) >= low
                return above if high is None else above & (_order_key(g) < high)

            return F.transform(F.filter("grams", picked), lambda g: g["gram"])

        parts = F.array(*[inside(a, b) for a, b in zip([None, *cuts], [*cuts, None])])
        pieces = ordered.select("class", "n", F.posexplode(parts).alias("fragment", "part")).where(F.size("part") > 0)
        self._parts = materialise(pieces, "join-fragments")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose summed overlap reaches the threshold."""
        left = self._parts.select(F.col("class").alias("a"), F.col("n").alias("na"), "fragment", F.col("part").alias("pa"))
        right = self._parts.select(F.col("class").alias("b"), F.col("n").alias("nb"), "fragment", F.col("part").alias("pb"))
        partial = (
            pairs.join(left, "a")
            .join(right, ["b", "fragment"])
            .select("a", "b", "na", "nb", F.size(F.array_intersect("pa", "pb")).alias("shared"))
        )
        summed = partial.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared"))
        return summed.where(_may_link(self._percent, F.col("shared"), F.col("na"), F.col("nb"))).select("a", "b")


def similar_classes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the classes of (class, n, grams) that have a link."""
    grams = sets.select("class", "n", F.explode("grams").alias("gram"))
    counts = materialise(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "join-counts")
    shared = grams.join(counts, "gram").groupBy("class", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("grams")
    )
    spare = F.col("n") - F.ceil(F.col("n") * percent / 100)
    own = (F.col("n") - F.size("grams")).alias("own")
    shared = materialise(shared.select("class", "n", own, "grams").where(F.col("own") <= spare), "join-sets")
    overlaps = _Overlaps(shared, percent)
    prefix = F.slice("grams", F.lit(1), (spare + 1 - F.col("own")).cast("int"))
    members = shared.select("class", "n", "own", F.posexplode(prefix).alias("at", "g"))
    members = members.select(F.col("g.gram").alias("gram"), "class", "n", "own", (F.col("at") + F.col("own")).alias("before"))
    members = materialise(members, "join-prefixes")
    hub = F.min(F.struct("own", F.col("class").alias("hub"), F.col("n").alias("hub_n"))).alias("h")
    blocks = members.groupBy("gram").agg(hub, F.count(F.lit(1)).alias("members"), F.min("n").alias("least_n")).where("members > 1")
    blocks = materialise(blocks.select("gram", "h.hub", "h.hub_n", "least_n"), "join-blocks")

    def distinct_pairs(pairs: DataFrame, name: str) -> DataFrame:
        return materialise(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), name)

    in_blocks = members.join(blocks, "gram")
    sizes_fit = (100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
    first = distinct_pairs(
        in_blocks.where((F.col("class") != F.col("hub")) & sizes_fit).select(F.col("class").alias("x"), F.col("hub").alias("y")), "join-pairs"
    )
    links = materialise(overlaps.links(first), "join-links")
    found = materialise(components(links), "join-components")
    labels = found.select(F.col("node").alias("class"), "component")
    hubs = found.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    at = materialise(members.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class")), "join-members")
    # Members outside their hub's component that some partner of the block's sizes could still reach.
    rest = at.join(blocks, "gram").join(hubs, "hub", "left").where(
        (F.col("component") != F.coalesce("hub_component", "hub"))
        & _may_link(percent, F.col("n") - F.col("before"), F.col("n"), F.greatest(F.col("least_n"), F.ceil(F.col("n") * percent / 100)))
    )
    rest = materialise(rest.select("gram", *[F.col(c).alias(f"x_{c}") for c in ("class", "n", "before", "component")]), "join-rest")
    if rest.isEmpty():
        return found
    reach = F.least(F.col("n") - F.col("before"), F.col("x_n") - F.col("x_before"))
    second = distinct_pairs(
        rest.join(at, "gram")
        .where((F.col("component") != F.col("x_component")) & _may_link(percent, reach, F.col("n"), F.col("x_n")))
        .select(F.col("class").alias("x"), F.col("x_class").alias("y"))
        .join(first.select(F.col("a").alias("x"), F.col("b").alias("y")).unionAll(first.select(F.col("b").alias("x"), F.col("a").alias("y"))), ["x", "y"], "left_anti"),
        "join-pairs",
    )
    return components(links.unionAll(overlaps.links(second)))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, n_shingles, class, component, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, itself included, and ``component`` tells
    components apart where it is null. ``row`` is
    ``common.row_key`` of the id and the text, to join back to ``docs``.
    """
    signed = materialise(signatures(docs, size, percent, doc_id, text), "join-signatures")
    wanted = materialise(survivors(signed, percent), "join-survivors")
    sets = materialise(full_sets(docs, wanted, size, doc_id, text), "join-full-sets")
    linked = similar_classes(sets, percent).select(F.col("node").alias("class"), "component")
    lowest = signed.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("lowest"))
    group = materialise(
        lowest.join(linked, "class", "left").withColumn("component", F.coalesce("component", "class")), "join-classes"
    )
    lowest = group.groupBy("component").agg(F.min("lowest").alias("component_id"))
    of_class = materialise(group.join(lowest, "component").select("class", "component", "component_id"), "join-ids")
    own = F.when(F.col("n") > 0, F.col("class"))
    return (
        signed.select("doc_id", "row", F.col("n").alias("n_shingles"), own.alias("class"))
        .join(of_class, "class", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
    )
