"""Business questions answered from the gold star schema (fact ⋈ dims)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import round_half_even
from shelfwise.operators.joins import DEFAULT_BROADCAST_ROWS, sized_broadcast


def sales_by_dim_attributes(fact: DataFrame, dim: DataFrame, key: str, attributes: Sequence[str],
                            max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                            round_to: int | None = 2) -> DataFrame:
    """Total sales and row count per dimension attribute(s).

    The fact is pre-aggregated on the surrogate key first (partial +
    final aggregation, so a hot key collapses before any join), and only
    that per-key aggregate is joined to the dimension — the join input is
    bounded by the number of distinct keys, not by the fact size. The
    dimension is broadcast only behind a size check (see
    :mod:`shelfwise.operators.joins`); otherwise it is a shuffle join in
    which the pre-aggregated side is already partitioned by the key.
    """
    per_key = fact.groupBy(key).agg(
        F.sum("total_sales").alias("_sum"), F.count(F.lit(1)).alias("_cnt")
    )
    attrs = dim.select(key, *attributes)
    joined = per_key.join(sized_broadcast(attrs, max_broadcast_rows), key)
    out = joined.groupBy(*attributes).agg(
        F.sum("_sum").alias("total_sales"), F.sum("_cnt").alias("count")
    )
    if round_to is not None:
        out = out.withColumn("total_sales", round_half_even(F.col("total_sales"), round_to))
    return out
