"""Prefix trie of conversations by fixed-length block hashing.

Each turn is hashed with its place, and a block of ``block`` turns has the sum of its turns' hashes (four sums of 32-bit
pieces, so two prefixes share a digest with probability about 2**-128). Sums of blocks give the digest of every
prefix that ends with a block. Conversations are grouped by these first. Where all members of a
prefix go on with the same block, its turns are one chain, read off the smallest member. Only
blocks in which siblings diverge are cut at each turn, and only their rows are grouped again.

Subtree sums need no walk. A node belongs to its smallest member, and a conversation is the smallest
member of the nodes from some depth on; with ``x`` as the words before that depth, the words
a member saves below a node are x less the words before the node. Leaves are counted at their smallest member. So a
node's sums are sums over its members.

A conversation may hold a third of all turns: turns are ranked by a range sort (``ranked``) and sums along a
conversation are taken in levels of ``FAN`` blocks (``earlier_sums``), never in one window over it. A
turn or whole conversation that a third of the rows share is pre-aggregated; its members' ids are
hashed from chunks of ``CHUNK`` ids, in constant memory.

Nulls and edges: turns without a conversation id belong to none and are left out; a null role or text is empty; a null turn
comes first; equal turn numbers go by the digest of role and text, repeated rows are turns of their own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import map_arrow, materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Blocks that one window takes together, and ids in a chunk of text.
FAN, CHUNK = 64, 512
PIECES = range(4)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def ranked(conversations: DataFrame) -> DataFrame:
    """Turns in their order: conv_id, rank (from 1), digest, words.

    One range sort over all turns; each task numbers its rows as they stream by. Only a partition's
    last conversation can go on in the next, so the starts that are broadcast have a row per partition at most.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            if len(ids) == 0:
                continue
            first = np.concatenate([[True], ids[1:] != ids[:-1]])
            place = np.arange(len(ids)) - np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0)) + 1
            if last is not None and ids[0] == last:
                place[ids == last] += seen
            last, seen = int(ids[-1]), int(place[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), part, np.int32)), batch.column(0), pa.array(place), *batch.columns[1:]],
                names=["part", "conv_id", "place", "digest", "words"],
            )

    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "words")
    placed = materialise(map_arrow(placed, number, "part int, conv_id long, place long, digest string, words long"), "turns")
    ends = placed.groupBy("part").agg(F.max(F.struct("conv_id", "place")).alias("end")).select("part", "end.*")
    starts = ends.select(
        F.lead("part").over(Window.orderBy("part")).alias("part"),
        "conv_id",
        F.sum("place").over(Window.partitionBy("conv_id").orderBy("part")).alias("start"),
    )
    rank = F.col("place") + F.coalesce("start", F.lit(0).cast("long"))
    return placed.join(F.broadcast(starts), ["part", "conv_id"], "left").select("conv_id", rank.alias("rank"), "digest", "words")


def rebuild(turns: DataFrame, group: int = 20, lengths: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with the first turns of the first conversation of their group.

    Returns all conversations (conv_id) and their turns (conv_id, pos, digest, words). Of conversation c the first
    crc32(c) % ``lengths`` turns are those of conversation c - c % ``group``.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % lengths
    turn = F.struct("rank", "digest", "words")
    base = (
        turns.where((F.col("conv_id") % group == 0) & (F.col("rank") < lengths))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(turn)).alias("first"))  # fewer than ``lengths`` turns
    )
    convs = turns.select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    heads = F.when(F.col("first").isNotNull(), F.slice("first", F.lit(1), taken.cast("int")))
    plan = materialise(convs.join(base, "base", "left").select("conv_id", heads.alias("heads")), "trie-plan")
    n_heads = F.greatest(F.size("heads"), F.lit(0)).cast("long")
    own = (
        turns.where(F.col("rank") > taken)
        .join(plan.select("conv_id", n_heads.alias("n_heads")), "conv_id")
        .select("conv_id", (F.col("rank") - taken + F.col("n_heads")).alias("pos"), "digest", "words")
    )
    shared = plan.select("conv_id", F.explode("heads").alias("t")).select("conv_id", F.col("t.rank").alias("pos"), "t.digest", "t.words")
    return plan.select("conv_id"), own.unionByName(shared)


def earlier_sums(blocks: DataFrame, sums: list[str]) -> DataFrame:
    """Add ``before_<x>``: for each conversation the sum of x over the blocks before k.

    A window holds at most FAN blocks of a conversation; longer ones are summed by FAN blocks and those sums in the same way.
    """
    most = blocks.agg(F.max("k")).first()[0] or 0
    within = [F.col("conv_id")] if most < FAN else [F.col("conv_id"), F.floor(F.col("k") / FAN)]
    window = Window.partitionBy(*within).orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    inner = blocks.withColumns({f"before_{x}": F.coalesce(F.sum(x).over(window), F.lit(0).cast("long")) for x in sums})
    if most < FAN:
        return inner
    level = F.floor(F.col("k") / FAN)
    outer = materialise(blocks.groupBy("conv_id", level.alias("k")).agg(*[F.sum(x).alias(x) for x in sums]), "trie-level")
    outer = earlier_sums(outer, sums).select("conv_id", F.col("k").alias("level"), *[F.col(f"before_{x}").alias(f"outer_{x}") for x in sums])
    joined = inner.withColumn("level", level).join(outer, ["conv_id", "level"])
    return joined.withColumns({f"before_{x}": F.col(f"before_{x}") + F.col(f"outer_{x}") for x in sums}).drop(
        "level", *[f"outer_{x}" for x in sums]
    )


def _digest(sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", *[s.cast("string") for s in sums])))


def _pieces(*names: str) -> list[Column]:
    """Sums of the named columns, piece by piece: '+x' is added, '-x' taken away."""
    out = []
    for i in PIECES:
        total = F.lit(0).cast("long")
        for name in names:
            total = total + F.col(f"{name[1:]}{i}") if name[0] == "+" else total - F.col(f"{name[1:]}{i}")
        out.append(total)
    return out


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, key, ends_sha256) of (depth, key, conv_id): the digest of each group's ids, ascending and comma-joined.

    Ids are range-sorted and joined to chunks of CHUNK ids where they lie; a group's chunks
    then stream through one hash in order, as SHA-256 asks for, so a task holds one batch of chunks and no list of ids.
    """
    order = ["key", "depth", "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids = None, []

        def rows(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "depth", "first", "ids"])

        for batch in batches:
            out = []
            for key, depth, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, depth) != group or len(ids) == CHUNK:
                    if ids:
                        out.append((*group, ids[0], ",".join(map(str, ids))))
                    group, ids = (key, depth), []
                ids.append(conv)
            yield rows(out)
        if ids:
            yield rows([(*group, ids[0], ",".join(map(str, ids)))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state = None, None

        def rows(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[], [], []]
            kinds = (pa.binary(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "depth", "ends_sha256"])

        for batch in batches:
            out = []
            for key, depth, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (key, depth) == group:
                    state.update(b",")
                else:
                    if group is not None:
                        out.append((*group, state.hexdigest()))
                    group, state = (key, depth), hashlib.sha256()
                state.update(text.encode())
            yield rows(out)
        if group is not None:
            yield rows([(*group, state.hexdigest())])

    sorted_ = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = materialise(map_arrow(sorted_, join, "key binary, depth long, first long, ids string"), "trie-ends")
    streams = chunks.repartition("key", "depth").sortWithinPartitions("key", "depth", "first")
    return map_arrow(streams, hashed, "key binary, depth long, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame, block: int = 4) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos from 1 without gaps, digest, words) of ``convs`` (conv_id).

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    k = F.floor((F.col("pos") - 1) / block)
    h = F.md5(F.concat_ws(":", F.col("pos").cast("string"), "digest"))
    own = {f"f{i}": F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long") for i in PIECES}
    sums = [*own, "words"]
    so_far = Window.partitionBy("conv_id", "k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.select("conv_id", "pos", k.alias("k"), "words", *[c.alias(n) for n, c in own.items()])
    turns = turns.withColumns({f"to_{x}": F.sum(x).over(so_far) for x in sums})
    turns = materialise(turns, "trie-turns")
    root = F.unhex(F.md5(F.lit("0:0:0:0")))

    # Whole blocks: k, the digests before (up) and after (key) the block.
    blocks = materialise(turns.groupBy("conv_id", "k").agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(x) for x in sums]), "trie-blocks")
    blocks = earlier_sums(blocks, sums).select(
        "conv_id", "k", "n", "words", F.col("before_words").alias("pw"), *[f"before_f{i}" for i in PIECES],
        _digest(_pieces("+before_f")).alias("up"), _digest(_pieces("+before_f", "+f")).alias("key"),
    )
    blocks = materialise(blocks, "trie-blocks")
    groups = materialise(
        blocks.groupBy("k", "up", "key", "n", "words", "pw").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("rep")), "trie-groups"
    )
    forks = groups.groupBy("k", "up").agg(F.count(F.lit(1)).alias("n_next")).where("n_next > 1").select("k", "up", F.lit(True).alias("fork"))
    groups = groups.join(forks, ["k", "up"], "left").withColumn("fork", F.coalesce("fork", F.lit(False)))
    groups = materialise(groups, "trie-groups")
    members = materialise(blocks.join(groups.select("k", "key", "n_convs", "fork"), ["k", "key"]), "trie-members")

    # Blocks in which siblings diverge, turn by turn.
    cut = (
        turns.join(members.where("fork").select("conv_id", "k", F.col("pw").alias("block_pw"), *[f"before_f{i}" for i in PIECES]), ["conv_id", "k"])
        .select(
            "conv_id", F.col("pos").alias("depth"), "words", (F.col("block_pw") + F.col("to_words") - F.col("words")).alias("pw"),
            _digest(_pieces("+before_f", "+to_f", "-f")).alias("up"), _digest(_pieces("+before_f", "+to_f")).alias("key"),
        )
    )
    cut = materialise(cut, "trie-cut")
    refined = materialise(
        cut.groupBy("depth", "key", "up", "words", "pw").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")), "trie-refined"
    )

    # Blocks that all members share, as chains of turns of the smallest member.
    chain = (
        turns.select("conv_id", "pos", F.col("words").alias("turn_words"), "k", "to_words")
        .join(groups.where("not fork").withColumnRenamed("rep", "conv_id"), ["conv_id", "k"])
        .select(
            "conv_id", "k", F.col("pos").alias("depth"), "n_convs", "pw", F.col("key").alias("block_key"),
            F.when(F.col("pos") == F.col("k") * block + 1, F.col("up")).alias("up"),
            F.when(F.col("pos") == F.col("k") * block + F.col("n"), F.col("key")).alias("key"),
            (F.col("words") - F.col("to_words") + F.col("turn_words")).alias("rest"),
        )
    )
    chain = materialise(chain, "trie-chain")

    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    top = materialise(convs.agg(F.min("conv_id").alias("conv_id")).where("conv_id is not null"), "trie-top")
    top = top.select("conv_id", zero.alias("depth"), root.alias("key"), zero.alias("pw"))
    links = refined.select("depth", "up", "conv_id", "pw").unionByName(chain.where("up is not null").select("depth", "up", "conv_id", "pw"))
    targets = (
        refined.select("depth", "key", "conv_id")
        .unionByName(chain.where("key is not null").select("depth", "key", "conv_id"))
        .unionByName(top.select("depth", "key", "conv_id"))
    )
    kids = materialise(
        links.groupBy((F.col("depth") - 1).alias("depth"), F.col("up").alias("key")).agg(F.count(F.lit(1)).alias("n_children")), "trie-kids"
    )
    leaves = targets.join(kids, ["depth", "key"], "left_anti").select("conv_id", zero.alias("words"), none.alias("pw"), F.lit(1).cast("long").alias("leaf"))
    about = (
        convs.select("conv_id", zero.alias("words"), none.alias("pw"), zero.alias("leaf"))
        .unionByName(blocks.select("conv_id", "words", none.alias("pw"), zero.alias("leaf")))
        .unionByName(links.select("conv_id", zero.alias("words"), "pw", zero.alias("leaf")))
        .unionByName(top.select("conv_id", zero.alias("words"), "pw", zero.alias("leaf")))
        .unionByName(leaves)
        .groupBy("conv_id")
        .agg(F.coalesce(F.min("pw"), F.sum("words")).alias("x"), F.max("leaf").alias("leaf"))
    )
    about = materialise(about, "trie-conversations")

    # Sums over members; a node with one member saves nothing and has one leaf.
    saves = lambda before: F.sum(F.greatest(F.col("x") - before, F.lit(0).cast("long"))).alias("below")
    n_leaves = F.sum("leaf").alias("n_leaves")
    of_cut = materialise(cut.select("conv_id", "depth", "key", "pw").join(about, "conv_id"), "trie-saved")
    of_cut = of_cut.groupBy("depth", "key").agg(saves(F.col("pw")), n_leaves)
    shared = members.where("not fork and n_convs > 1").select("conv_id", "k", F.col("key").alias("block_key"), (F.col("pw") + F.col("words")).alias("pw"))
    of_chain = materialise(shared.join(about, "conv_id"), "trie-saved")
    of_chain = of_chain.groupBy("k", "block_key").agg(saves(F.col("pw")), n_leaves)
    nodes = (
        refined.join(of_cut, ["depth", "key"])
        .select("conv_id", "depth", "n_convs", "key", "up", F.col("below").alias("saved_tokens"), "n_leaves")
        .unionByName(
            chain.join(of_chain, ["k", "block_key"], "left").select(
                "conv_id", "depth", "n_convs", "key", "up",
                (F.coalesce("below", zero) + (F.col("n_convs") - 1) * F.col("rest")).alias("saved_tokens"),
                F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
            )
        )
        .unionByName(
            about.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), saves(zero), n_leaves).where("n_convs > 0").select(
                "conv_id", zero.alias("depth"), "n_convs", root.alias("key"), F.lit(None).cast("binary").alias("up"),
                F.col("below").alias("saved_tokens"), "n_leaves",
            )
        )
    )
    nodes = materialise(nodes, "trie-nodes")

    # Parents, children and ends, where a block or a fork begins or ends; inside a chain they are known.
    above = targets.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    linked = nodes.where("up is not null").join(above, ["depth", "up"]).drop("up")
    inside = nodes.where("up is null").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id"))).drop("up")
    nodes = materialise(linked.unionByName(inside), "trie-linked")
    last = F.struct("k", "n", "key")
    whole = convs.select("conv_id", F.struct(F.lit(-1).cast("long").alias("k"), F.lit(block).cast("long").alias("n"), root.alias("key")).alias("last"))
    ends = whole.unionByName(blocks.select("conv_id", last.alias("last"))).groupBy("conv_id").agg(F.max("last").alias("last"))
    ends = ends.select("conv_id", "last.key", (F.col("last.k") * block + F.col("last.n")).alias("depth"))
    digests = materialise(ends_digests(ends), "trie-digests")
    open_ = nodes.where("key is not null").join(kids, ["depth", "key"], "left").join(digests, ["depth", "key"], "left")
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs")
    return open_.select(
        *columns, F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
    ).unionByName(
        nodes.where("key is null").select(*columns, F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.lit(NO_ENDS).alias("ends_sha256"))
    )
