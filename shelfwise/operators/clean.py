"""Silver layer: rename, trim, canonicalise labels, cast, impute.

``clean_frame`` is one ``select`` so analysis stays cheap and Catalyst
sees a single projection it can prune and push filters through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import canonical_fat_content, col, is_missing, nan_to_null
from shelfwise.schemas import DOUBLE_COLUMNS, INT_COLUMNS, RAW_TO_SILVER, TRIMMED_COLUMNS

# ---- fixed values: relative error of the approximate weight median ----
MEDIAN_RELATIVE_ERROR = 0.01


def _silver_name(name: str) -> str:
    return RAW_TO_SILVER.get(name, name)


def clean_frame(frame: DataFrame) -> DataFrame:
    """Raw/bronze → cleaned silver columns (no imputation).

    Missing raw columns are simply absent; unknown columns pass through
    unchanged (open schema). NaN measures become null.
    """
    exprs: list[Column] = []
    for name in frame.columns:
        target = _silver_name(name)
        c = col(name)
        if target in TRIMMED_COLUMNS:
            c = F.trim(c)
        if target == "item_fat_content":
            c = canonical_fat_content(c)
        if target in DOUBLE_COLUMNS:
            c = nan_to_null(c.try_cast("double"))
        elif target in INT_COLUMNS:
            c = c.try_cast("int")
        exprs.append(c.alias(target))
    return frame.select(*exprs)


def median_of(frame: DataFrame, column: str, mode: str = "approx",
              relative_error: float = MEDIAN_RELATIVE_ERROR) -> Column:
    """Column holding the median of ``column`` (NaN and null ignored).

    ``approx`` (default) is a scalar subquery over ``percentile_approx``
    with accuracy ``1/relative_error`` — a mergeable sketch of bounded
    size, evaluated once inside the plan. ``exact`` runs the distributed
    bracket refinement of :mod:`shelfwise.operators.quantiles` now (a few
    passes, bounded final step) and returns the value as a literal.
    """
    if mode == "exact":
        from shelfwise.operators.quantiles import exact_median

        return F.lit(exact_median(frame, column)).cast("double")
    if mode != "approx":
        raise ValueError(f"unknown median mode {mode!r}")
    values = frame.where(~is_missing(F.col(column)))
    agg = F.percentile_approx(column, 0.5, int(round(1.0 / relative_error)))
    return values.agg(agg.cast("double").alias("median")).scalar()


def impute_weight(frame: DataFrame, column: str = "item_weight", mode: str = "approx",
                  relative_error: float = MEDIAN_RELATIVE_ERROR, median: Column | None = None) -> DataFrame:
    """Fill null/NaN values of ``column`` with the column median.

    In ``approx`` mode the median is a scalar subquery (Spark runs it once
    and substitutes the value, so the result stays one lazy plan); in
    ``exact`` mode it is computed first (see :func:`median_of`). When every value is
    missing the median is null and the column stays null (no error).
    ``median`` overrides the value (e.g. a frozen median in streaming).
    """
    m = median if median is not None else median_of(frame, column, mode, relative_error)
    filled = F.when(is_missing(F.col(column)), m).otherwise(F.col(column))
    return frame.withColumn(column, filled)


def to_silver(frame: DataFrame, mode: str = "approx", relative_error: float = MEDIAN_RELATIVE_ERROR) -> DataFrame:
    """Cleaning followed by weight imputation (the reference's silver)."""
    return impute_weight(clean_frame(frame), mode=mode, relative_error=relative_error)


def with_event_date(frame: DataFrame) -> DataFrame:
    """Gold ``silver``: adds ``event_date`` from ``ingest_ts`` (session time zone)."""
    return frame.withColumn("event_date", F.to_date("ingest_ts"))
