"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source queues its documents in a shuffled order, again and again up to ``max_epochs``
times. A copy's virtual finish time is the source's cumulative size up to and with it, divided by the
source's target. All copies are sorted by that time over the whole corpus and taken
until the budget is used up, so every source advances in proportion to its target. A source's queue ends with
the copy that reaches its target.

Targets share the budget by weight; one that exceeds ``max_epochs`` times its source's size stops there
and the excess is shared again. That is one water level: sources are sorted by the level
at which they are full, and running sums give the level of each prefix.

Every running sum (places of sources, sizes within a source, the taken total) comes from ``running_sums``:
a range sort, sums by partition, and windows within a partition. No window spans a source, so a source with a third of the
rows is spread like any other. The driver sees the budget, the sum of weights and the level.

Nulls and edges: a null or empty text has size 0, takes nothing and its row is returned; a null source is a source of its own, ordered last;
documents are shuffled by the MD5 digest of seed, id and text, so reruns agree, and rows
equal in id and text share a place in any order; an empty table gives an empty result; columns
that aren't carried are ignored, and a carried one with the name of a result column is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import materialise

WORD = r"[^\x20\x09-\x0D]+"


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """Add to each row, for each of ``sums``, the sum over all rows before it in ``order``.

    Only a partition's rows meet in a window. The table of partitions' sums has a row per
    partition, whatever the input, so it is broadcast.
    """
    values = {f"{k}_": v for k, v in sums.items()}
    placed = materialise(
        df.withColumns(values).repartitionByRange(*order).withColumn("part_", F.spark_partition_id()), name
    )
    earlier = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part_").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = placed.groupBy("part_").agg(*[F.sum(v).alias(v) for v in values])
    starts = parts.select("part_", *[F.coalesce(F.sum(v).over(earlier), zero).alias(f"{v}start") for v in values])
    inside = placed.withColumns({k: F.coalesce(F.sum(f"{k}_").over(within), zero) for k in sums})
    joined = inside.join(F.broadcast(starts), "part_")
    return joined.withColumns({k: F.col(k) + F.col(f"{k}_start") for k in sums}).drop(
        "part_", *values, *[f"{v}start" for v in values]
    )


def source_targets(sources: DataFrame, weights: tuple[int, ...], share: float, max_epochs: int) -> DataFrame:
    """(source, source_size) with start (sizes of the sources before), weight and target."""
    last = F.col("source").asc_nulls_last()
    ranked = running_sums(sources, [last], {"place": F.lit(1).cast("long"), "start": F.col("source_size")}, "mix-places")
    cycle = F.array(*map(F.lit, weights))
    ranked = ranked.withColumn("weight", F.get(cycle, F.pmod("place", F.lit(len(weights))).cast("int")).cast("long"))
    full = F.col("source_size") * max_epochs
    ranked = ranked.withColumn("full_at", full / F.col("weight"))
    filled = materialise(
        running_sums(ranked, [F.col("full_at"), last], {"cap": full, "heavy": F.col("weight")}, "mix-levels"), "mix-levels"
    )
    total, weight = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = (total or 0) * share
    left, rest = F.lit(budget) - F.col("cap"), F.lit(weight or 0) - F.col("heavy")
    open_ = filled.where(F.col("full_at") * rest >= left)
    level = open_.agg(F.min_by(F.struct(left.alias("left"), rest.alias("rest")), F.struct("full_at", "place")).alias("x")).first()["x"]
    target = full.cast("double")
    if level is not None:
        target = F.least(target, F.lit(float(level["left"])) * F.col("weight") / F.lit(float(level["rest"])))
    return filled.select("source", "source_size", "start", "weight", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    share: float = 1.0,
    max_epochs: int = 3,
    seed: str = "13",
    carry: tuple[str, ...] = ("doc_id",),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per document its carried columns, size, source_size, target and taken.

    ``weights`` go to the sources in code point order, again and again; the budget is ``share`` of all sizes.
    taken is the document's size times the copies that the mix takes, at most ``max_epochs``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), body)
    sized = materialise(
        docs.select(
            F.struct(*carry).alias("carried"),
            F.col(source).alias("source"),
            F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
            F.md5(name).alias("shuffled"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mix-documents",
    )
    sources = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    targets = materialise(source_targets(sources, weights, share, max_epochs), "mix-targets")
    by_source = targets.withColumnRenamed("source", "of")
    queue = running_sums(
        sized.where("size > 0").select("source", "size", "shuffled", "row"),
        [F.col("source").asc_nulls_last(), F.col("shuffled"), F.col("row")],
        {"before": F.col("size")},
        "mix-queue",
    )
    queue = materialise(queue, "mix-queued").join(by_source, F.col("source").eqNullSafe(F.col("of")))
    begun = (F.col("epoch") - 1) * F.col("source_size") + F.col("before") - F.col("start")
    copies = (
        queue.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(max_epochs).cast("long"))))
        .where(begun < F.col("target"))
        .select("row", "size", "source", "epoch", "shuffled", ((begun + F.col("size")) / F.col("target")).alias("finish"))
    )
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("epoch"), F.col("shuffled"), F.col("row")]
    served = running_sums(copies, order, {"spent": F.col("size")}, "mix-copies")
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    taken = materialise(
        served.where(F.col("spent") + F.col("size") <= budget).groupBy("row").agg(F.sum("size").alias("words")), "mix-taken"
    )
    results = ("size", "source_size", "target", "taken")
    return (
        sized.join(taken, "row", "left")
        .join(by_source, F.col("source").eqNullSafe(F.col("of")))
        .select(
            *[F.col("carried")[c].alias(c) for c in carry if c not in results],
            "size",
            "source_size",
            "target",
            F.coalesce("words", F.lit(0).cast("long")).alias("taken"),
        )
    )
