"""Gold star schema: three dimensions with hash keys and the sales fact.

The surrogate keys are pure functions of the natural key, so the fact can
compute them **inline** from its own row — no join, no shuffle — which is
the default. ``mode="join"`` reproduces the reference's three left joins
(useful for parity: a null natural key then gives a null fact key).

Dimensions are ``dropDuplicates`` over silver: partial (map-side) hash
aggregation first, so a hot key that holds a third of all rows collapses
to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import surrogate_key
from shelfwise.operators.clean import with_event_date
from shelfwise.operators.joins import DEFAULT_BROADCAST_ROWS, DIM_BROADCAST_ROWS, left_join_dim
from shelfwise.schemas import (
    DATE_NATURAL_KEY,
    FACT_COLUMNS,
    ITEM_NATURAL_KEY,
    OUTLET_NATURAL_KEY,
)
from shelfwise.sinks.layers import read_gold, write_gold


def item_key(null_token: str | None = None):
    return surrogate_key(*[F.col(c) for c in ITEM_NATURAL_KEY], null_token=null_token)


def outlet_key(null_token: str | None = None):
    return surrogate_key(*[F.col(c) for c in OUTLET_NATURAL_KEY], null_token=null_token)


def date_key(null_token: str | None = None):
    return surrogate_key(*[F.col(c) for c in DATE_NATURAL_KEY], null_token=null_token)


def dim_item(silver: DataFrame, null_token: str | None = None) -> DataFrame:
    return (
        silver.select(*ITEM_NATURAL_KEY)
        .dropDuplicates()
        .withColumn("item_key", item_key(null_token))
    )


def dim_outlet(silver: DataFrame, null_token: str | None = None) -> DataFrame:
    return (
        silver.select(*OUTLET_NATURAL_KEY)
        .dropDuplicates()
        .withColumn("outlet_key", outlet_key(null_token))
    )


def dim_date(silver: DataFrame, null_token: str | None = None) -> DataFrame:
    frame = silver if "event_date" in silver.columns else with_event_date(silver)
    return (
        frame.select(*DATE_NATURAL_KEY)
        .dropDuplicates()
        .withColumn("date_key", date_key(null_token))
    )


def fact_sales(silver: DataFrame, mode: str = "inline", null_token: str | None = None,
               dims: dict[str, DataFrame] | None = None,
               max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
               extra_columns: tuple[str, ...] = (), null_safe: bool = False) -> DataFrame:
    """Fact rows with item/outlet/date keys and the four measures.

    ``mode="join"`` with ``null_safe=True`` matches natural keys with
    ``<=>``, so a row with a null key part still gets its dimension's key.
    """
    frame = silver if "event_date" in silver.columns else with_event_date(silver)
    if mode == "inline":
        return frame.select(
            item_key(null_token).alias("item_key"),
            outlet_key(null_token).alias("outlet_key"),
            date_key(null_token).alias("date_key"),
            *FACT_COLUMNS[3:],
            *extra_columns,
        )
    if mode != "join":
        raise ValueError(f"unknown fact mode {mode!r}")
    dims = dims or {
        "dim_item": dim_item(frame, null_token),
        "dim_outlet": dim_outlet(frame, null_token),
        "dim_date": dim_date(frame, null_token),
    }
    joined = left_join_dim(frame, dims["dim_item"], list(ITEM_NATURAL_KEY), max_broadcast_rows,
                           null_safe)
    joined = left_join_dim(joined, dims["dim_outlet"], list(OUTLET_NATURAL_KEY), max_broadcast_rows,
                           null_safe)
    joined = left_join_dim(joined, dims["dim_date"], list(DATE_NATURAL_KEY), max_broadcast_rows,
                           null_safe)
    return joined.select(*FACT_COLUMNS, *extra_columns)


def fact_of_written_dims(silver: DataFrame, folder: str) -> DataFrame:
    """The join-mode fact, with its dimensions written to ``folder`` first.

    A join with a dimension that is still to be aggregated shuffles the fact before that dimension's
    size is known. Written ones are counted: a small one is broadcast and the fact is shuffled
    for the others only.
    """
    frame = silver if "event_date" in silver.columns else with_event_date(silver)
    dims = {"dim_item": dim_item(frame), "dim_outlet": dim_outlet(frame), "dim_date": dim_date(frame)}
    paths = write_gold(dims, folder)
    return fact_sales(frame, mode="join", dims=read_gold(frame.sparkSession, paths), max_broadcast_rows=DIM_BROADCAST_ROWS)


def build_gold_layers(silver: DataFrame, mode: str = "inline",
                      null_token: str | None = None) -> dict[str, DataFrame]:
    """All gold tables as lazy DataFrames: silver (+event_date), 3 dims, fact."""
    gold_silver = with_event_date(silver)
    dims = {
        "dim_item": dim_item(gold_silver, null_token),
        "dim_outlet": dim_outlet(gold_silver, null_token),
        "dim_date": dim_date(gold_silver, null_token),
    }
    fact = fact_sales(gold_silver, mode=mode, null_token=null_token,
                      dims=dims if mode == "join" else None)
    return {"silver": gold_silver, **dims, "fact_sales": fact}
