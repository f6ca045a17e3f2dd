"""Medians at any volume: exact by radix selection, approximate by a mergeable sketch.

Spark's exact ``median`` merges one count per distinct value in a single
task, which is unbounded for a continuous measure. ``exact_median`` maps
each double to a 64-bit integer of the same order and fixes the two
middle values' bits ``DIGIT_BITS`` at a time: a pass counts the values
under the bits known so far by their next digit (two prefixes of
2**DIGIT_BITS digits at most, pre-aggregated in every task) and picks the digits
that hold the middle ranks. There are ``PASSES`` passes over one written column
whatever the values: no sort, no window, no sample. A hot value is one
count per task.

``median_sketch`` is a KLL sketch of a column (a few KB however many
rows), which can be stored per build or micro-batch and merged later.
The exact result equals ``quantile_cont(0.5)``: ``lo + (hi - lo) * 0.5``.
"""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import is_missing
from shelfwise.session import scratch_path

DIGIT_BITS = 16
PASSES = 64 // DIGIT_BITS
#: Sketch size; its rank error is about 0.7 %.
SKETCH_K = 400


def with_ordered_bits(values: DataFrame, column: str = "x", bits: str = "v") -> DataFrame:
    """Add a long of the same order as the double ``column``: its IEEE bits, negated for negative values (-0.0 is 0).

    Spark has no function for a double's bits, so they are computed: multiplying by powers of two is
    exact. Each step is a projection of its own, as one expression would compute its parts many times over.
    """
    x, size, e = F.col(column), F.col("size_"), F.col("e_")
    power = lambda n: F.pow(F.lit(2.0), n)
    step = values.withColumn("size_", F.abs(x))
    step = step.withColumn("guess_", F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022)))
    step = step.withColumn("near_", power(F.col("guess_")))
    step = step.withColumn("e_", F.col("guess_") + F.when(size < F.col("near_"), -1).when(size / 2 >= F.col("near_"), 1).otherwise(0))
    # 2**(52 - e) itself overflows for small values: scale in two steps.
    fraction = F.when(e < -400, size * F.lit(2.0**600) * power(-548 - e)).otherwise(size * power(52 - e))
    step = step.withColumn("fraction_", F.when(size < F.lit(2.0**-1022), size * F.lit(2.0**537) * F.lit(2.0**537)).otherwise(fraction))
    whole = F.col("fraction_").cast("long") + F.when(size < F.lit(2.0**-1022), 0).otherwise((e + 1022) * F.lit(1 << 52))
    step = step.withColumn("bits_", F.when(size == float("inf"), F.lit(2047 << 52)).otherwise(whole))
    step = step.withColumn(bits, F.when(x < 0, -F.col("bits_")).otherwise(F.col("bits_")).cast("long"))
    return step.drop("size_", "guess_", "near_", "e_", "fraction_", "bits_")


def from_ordered_bits(bits: int) -> float:
    value = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -value if bits < 0 else value


def _digit_of_rank(counts: Column, prefix: Column, rank: Column) -> Column:
    """The digit under ``prefix`` that holds the value of ``rank``, and the rank among that digit's values."""
    none = F.lit(None).cast("long")
    start = F.struct(none.alias("digit"), rank.cast("long").alias("rank"))

    def step(found: Column, x: Column) -> Column:
        inside = prefix.isNull() | (F.shiftright(x["d"], DIGIT_BITS) == prefix)
        hit = found["rank"] < x["n"]
        return (
            F.when(found["digit"].isNotNull() | ~inside, found)
            .when(hit, F.struct(x["d"].alias("digit"), found["rank"].alias("rank")))
            .otherwise(F.struct(none.alias("digit"), (found["rank"] - x["n"]).alias("rank")))
        )

    return F.aggregate(counts, start, step)


def _pass(values: DataFrame, shift: int, low: tuple | None, high: tuple | None) -> tuple[tuple, tuple] | None:
    """One pass over ``values``: the next digits of the two middle values, with their ranks below those digits.

    ``low`` and ``high`` are the (bits, rank) known so far, None before the first pass. The counts are one
    row of at most 2 * 2**DIGIT_BITS pairs, and the driver reads four numbers of it.
    """
    if low is not None:
        values = values.where(F.shiftright("v", shift + DIGIT_BITS).isin(*{low[0], high[0]}))
    digits = values.groupBy(F.shiftright("v", shift).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    counts = digits.agg(F.sort_array(F.collect_list(F.struct("d", "n"))).alias("a"), F.sum("n").alias("total"))
    a, total, none = F.col("a"), F.col("total"), F.lit(None).cast("long")
    ranks = [F.floor((total - 1) / 2), F.floor(total / 2)] if low is None else [F.lit(low[1]), F.lit(high[1])]
    known = [none, none] if low is None else [F.lit(low[0]), F.lit(high[0])]
    found = counts.select(*[_digit_of_rank(a, k, r).alias(name) for name, k, r in zip(("low", "high"), known, ranks, strict=True)], "total").first()
    if not found["total"]:
        return None
    return tuple(found["low"]), tuple(found["high"])


def exact_median(frame: DataFrame, column: str) -> float | None:
    """Exact median of ``column`` (null/NaN ignored); None when there are no values."""
    spark = frame.sparkSession
    x = F.col(column).cast("double")
    path = scratch_path(spark, "median")
    present = frame.select(x.alias("x")).where(~is_missing(F.col("x")))
    with_ordered_bits(present).select("v").write.parquet(path)
    values = spark.read.schema("v long").parquet(path)
    low = high = None
    for step in range(PASSES):
        found = _pass(values, 64 - DIGIT_BITS * (step + 1), low, high)
        if found is None:
            return None
        low, high = found
    lo, hi = from_ordered_bits(low[0]), from_ordered_bits(high[0])
    return lo + (hi - lo) * 0.5


def median_sketch(frame: DataFrame, column: str) -> DataFrame:
    """One row: ``sketch`` (KLL, binary; null without values) and ``n``, over the present values of ``column``."""
    present = F.when(~is_missing(F.col(column)), F.col(column).cast("double"))
    return frame.agg(
        F.when(F.count(present) > 0, F.kll_sketch_agg_double(present, F.lit(SKETCH_K))).alias("sketch"), F.count(present).alias("n")
    )


def merged_median(sketches: DataFrame) -> DataFrame:
    """One row: ``median`` of the merged sketches (null without values) and ``n``."""
    some = sketches.where("sketch is not null")
    merged = F.kll_merge_agg_double("sketch", F.lit(SKETCH_K))
    return some.agg(F.sum("n").alias("n"), merged.alias("sketch")).select(
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5))).alias("median"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )
