"""Dashboard queries over silver: filters, grouped charts, histogram, top-k.

Semantics follow the pandas code they replace:

* group keys that are null are dropped; ``sum`` of an all-null group is 0,
  ``mean`` is null, ``count`` counts non-null measures;
* values are rounded half-even to 2 decimals for display;
* the histogram is ``pd.cut(x, bins=20)``: equal-width, right-closed,
  first edge lowered by 0.1 % of the range, labels rounded to an
  inferred precision.

Everything stays distributed: filters are native predicates that reach
the Parquet scan, aggregations are partial + final hash aggregates, and
scalars (min/max) are scalar subqueries evaluated once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import is_missing, round_numeric
from shelfwise.schemas import FILTER_DIMENSIONS, RECORD_ID

# ---- fixed values: the six dashboard charts (name, key, has mean, order) ----
CHARTS = (
    ("sales_by_item_type", "item_type", True, "total_desc"),
    ("sales_by_outlet_type", "outlet_type", False, "total_desc"),
    ("sales_by_location_type", "outlet_location_type", False, "total_desc"),
    ("sales_by_outlet_size", "outlet_size", False, "total_desc"),
    ("sales_by_fat_content", "item_fat_content", True, "total_desc"),
    ("sales_by_year", "outlet_establishment_year", False, "key_asc"),
)
CHART_BY_NAME = {c[0]: c for c in CHARTS}

# ---- fixed values: histogram (pd.cut defaults), sample size and top-k ----
HISTOGRAM_BINS = 20
LABEL_PRECISION = 3
RANGE_ADJUST = 0.001          # first edge lowered / constant range widened by 0.1 %
SAMPLE_DEFAULT = 50
SAMPLE_MAX = 100
TOP_K = 10


# --------------------------------------------------------------------------
# Filters
# --------------------------------------------------------------------------

def filter_predicate(item_type: Sequence[str] = (), outlet_type: Sequence[str] = (),
                     outlet_location_type: Sequence[str] = (), outlet_size: Sequence[str] = (),
                     item_fat_content: Sequence[str] = (), sales_min: float | None = None,
                     sales_max: float | None = None) -> Column:
    """Conjunction of IN lists (empty list = no filter) and an inclusive range."""
    pred: Column = F.lit(True)
    for name, values in (
        ("item_type", item_type),
        ("outlet_type", outlet_type),
        ("outlet_location_type", outlet_location_type),
        ("outlet_size", outlet_size),
        ("item_fat_content", item_fat_content),
    ):
        if values:
            pred = pred & F.col(name).isin(list(values))
    if sales_min is not None:
        pred = pred & (F.col("total_sales") >= F.lit(float(sales_min)))
    if sales_max is not None:
        pred = pred & (F.col("total_sales") <= F.lit(float(sales_max)))
    return pred


def apply_filters(frame: DataFrame, **filters) -> DataFrame:
    if not any(v not in (None, (), []) for v in filters.values()):
        return frame
    return frame.where(filter_predicate(**filters))


def all_options_filter(frame: DataFrame) -> DataFrame:
    """The dashboard's default state: every option of every dimension and
    the full sales range selected. Equivalent to requiring the five
    dimensions and the measure to be non-null."""
    pred = F.col("total_sales").isNotNull() & ~F.isnan("total_sales")
    for d in FILTER_DIMENSIONS:
        pred = pred & F.col(d).isNotNull()
    return frame.where(pred)


# --------------------------------------------------------------------------
# Grouped charts
# --------------------------------------------------------------------------

def _measure_aggs(with_mean: bool, measure: str = "total_sales") -> list[Column]:
    aggs = [F.coalesce(F.sum(measure), F.lit(0.0)).alias("total_sales")]
    if with_mean:
        aggs.append(F.avg(measure).alias("avg_sales"))
    aggs.append(F.count(measure).alias("count"))
    return aggs


def grouped_sales(frame: DataFrame, key: str, with_mean: bool = False,
                  order: str = "total_desc", round_to: int | None = 2) -> DataFrame:
    """One chart: sum / (mean) / count of total sales per non-null key."""
    out = frame.where(F.col(key).isNotNull()).groupBy(key).agg(*_measure_aggs(with_mean))
    if round_to is not None:
        out = out.select(*round_numeric(out.columns, dict(out.dtypes), round_to))
    if order == "total_desc":
        return out.orderBy(F.desc("total_sales"), F.asc(key))
    return out.orderBy(F.asc(key))


def chart(frame: DataFrame, name: str, round_to: int | None = 2) -> DataFrame:
    _, key, with_mean, order = CHART_BY_NAME[name]
    return grouped_sales(frame, key, with_mean, order, round_to)


GRAIN_KEYS = [c[1] for c in CHARTS]


def sales_grain(frame: DataFrame) -> DataFrame:
    """One row per combination of the six chart keys, with the additive
    measures that the charts, the roll-up, the headline numbers and the
    histogram bounds need. Its size is bounded by the product of the key
    cardinalities, not by the data, so one scan can serve all those panels."""
    x = F.col("total_sales")
    present = F.when(~is_missing(x), x)
    return frame.groupBy(*GRAIN_KEYS).agg(
        F.sum(x).alias("_sum"),
        F.count(x).alias("_cnt"),
        F.sum("rating").alias("_rating_sum"),
        F.count("rating").alias("_rating_cnt"),
        F.count(F.lit(1)).alias("_rows"),
        F.min(present).alias("_x_min"),
        F.max(present).alias("_x_max"),
        F.count(present).alias("_x_cnt"),
    )


def chart_from_grain(grain: DataFrame, name: str, round_to: int | None = 2) -> DataFrame:
    """One chart re-aggregated from :func:`sales_grain` (same result as
    :func:`chart` on the rows)."""
    _, key, with_mean, order = CHART_BY_NAME[name]
    aggs = [F.coalesce(F.sum("_sum"), F.lit(0.0)).alias("total_sales")]
    if with_mean:
        aggs.append(F.when(F.sum("_cnt") > 0, F.sum("_sum") / F.sum("_cnt")).alias("avg_sales"))
    aggs.append(F.sum("_cnt").alias("count"))
    out = grain.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    if round_to is not None:
        out = out.select(*round_numeric(out.columns, dict(out.dtypes), round_to))
    if order == "total_desc":
        return out.orderBy(F.desc("total_sales"), F.asc(key))
    return out.orderBy(F.asc(key))


def headline_from_grain(grain: DataFrame) -> DataFrame:
    """:func:`headline_metrics` computed from :func:`sales_grain`."""
    rows = F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint")
    return grain.agg(
        rows.alias("total_records"),
        F.when(rows == 0, F.lit(0.0))
        .otherwise(F.when(F.sum("_cnt") > 0, F.sum("_sum") / F.sum("_cnt"))).alias("avg_sales"),
        F.coalesce(F.sum("_sum"), F.lit(0.0)).alias("total_sales"),
        F.when(rows == 0, F.lit(0.0))
        .otherwise(F.when(F.sum("_rating_cnt") > 0, F.sum("_rating_sum") / F.sum("_rating_cnt")))
        .alias("avg_rating"),
    )


def histogram_stats_from_grain(grain: DataFrame) -> DataFrame:
    """(mn, mx, n) of the non-missing measure, for :func:`histogram`."""
    return grain.agg(F.min("_x_min").alias("mn"), F.max("_x_max").alias("mx"),
                     F.coalesce(F.sum("_x_cnt"), F.lit(0)).cast("bigint").alias("n"))


def chart_rollup(frame: DataFrame, round_to: int | None = 2,
                 grain: DataFrame | None = None) -> DataFrame:
    """All six charts from one scan, long form (chart, key, total, mean, count).

    Rows are first reduced to the six-column grain (one partial + final
    aggregation over the data), then GROUPING SETS over that small grain
    produce the six roll-ups, so the raw rows are never expanded 6×.
    A grain already computed by :func:`sales_grain` can be passed in.
    """
    keys = GRAIN_KEYS
    if grain is None:
        grain = frame.groupBy(*keys).agg(
            F.sum("total_sales").alias("_sum"),
            F.count("total_sales").alias("_cnt"),
        )
    rolled = grain.groupingSets([[k] for k in keys], *keys).agg(
        F.sum("_sum").alias("_sum"),
        F.sum("_cnt").alias("_cnt"),
        *[F.grouping(k).alias(f"_g_{k}") for k in keys],
    )
    chart_name: Column = F.lit(None).cast("string")
    key_value: Column = F.lit(None).cast("string")
    for name, key, _, _ in reversed(CHARTS):
        active = F.col(f"_g_{key}") == 0
        chart_name = F.when(active, F.lit(name)).otherwise(chart_name)
        key_value = F.when(active, F.col(key).cast("string")).otherwise(key_value)
    total = F.coalesce(F.col("_sum"), F.lit(0.0))
    mean = F.when(F.col("_cnt") > 0, F.col("_sum") / F.col("_cnt"))
    has_mean = F.col("chart").isin([c[0] for c in CHARTS if c[2]])
    out = (
        rolled.select(chart_name.alias("chart"), key_value.alias("key"), total.alias("total_sales"),
                      mean.alias("_mean"), F.col("_cnt").alias("count"))
        .where(F.col("key").isNotNull())
        .select("chart", "key", "total_sales",
                F.when(has_mean, F.col("_mean")).alias("avg_sales"), "count")
    )
    if round_to is not None:
        out = out.select(*round_numeric(out.columns, dict(out.dtypes), round_to))
    return out


# --------------------------------------------------------------------------
# Histogram (pd.cut(x, bins=20) semantics)
# --------------------------------------------------------------------------

def _round_frac(x: Column, precision: Column | int) -> Column:
    """pandas' label rounding: ``precision`` decimals, or that many
    significant decimals for |x| < 1; numpy rounding (rint of scaled)."""
    p = F.lit(precision) if isinstance(precision, int) else precision
    digits = F.when(
        F.abs(x) < 1, -F.floor(F.log10(F.abs(x))).cast("int") - 1 + p
    ).otherwise(p)
    scale = F.pow(F.lit(10.0), digits)
    rounded = F.rint(x * scale) / scale
    return F.when(x.isNull() | (x == 0) | F.isnan(x), x).otherwise(rounded)


def _hof_round_frac(x: Column, p: Column) -> Column:
    # Same as _round_frac, written for use inside higher-order lambdas.
    digits = F.when(F.abs(x) < 1, -F.floor(F.log10(F.abs(x))).cast("int") - 1 + p).otherwise(p)
    scale = F.pow(F.lit(10.0), digits)
    return F.when(x == 0, x).otherwise(F.rint(x * scale) / scale)


def histogram(frame: DataFrame, column: str = "total_sales", bins: int = HISTOGRAM_BINS,
              precision: int = LABEL_PRECISION, stats: DataFrame | None = None) -> DataFrame:
    """Equal-width right-closed bins over [min, max] of ``column``.

    Output: ``bin`` (1-based), ``bin_start``, ``bin_end`` (labels as
    pandas rounds them) and ``count``; empty bins included; empty input
    gives an empty frame. A row's bin is the number of edges strictly
    below it, computed with a ceil estimate corrected by one edge
    comparison each way (pure arithmetic, stays in generated code).
    ``stats`` — a one-row (mn, mx, n) frame, e.g. from
    :func:`histogram_stats_from_grain` — saves the bounds pass.
    """
    values = frame.select(F.col(column).alias("x")).where(~is_missing(F.col("x")))
    if stats is None:
        stats = values.agg(F.min("x").alias("mn"), F.max("x").alias("mx"), F.count("x").alias("n"))

    def bounds(s: DataFrame) -> DataFrame:
        mn, mx = F.col("mn"), F.col("mx")
        const = mn == mx
        a = RANGE_ADJUST
        lo = F.when(const, mn - F.when(mn != 0, F.abs(mn) * a).otherwise(a)).otherwise(mn)
        hi = F.when(const, mx + F.when(mx != 0, F.abs(mx) * a).otherwise(a)).otherwise(mx)
        return (
            s.withColumn("lo", lo)
            .withColumn("hi", hi)
            .withColumn("step", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
            .withColumn("adj", F.when(const, F.lit(0.0)).otherwise((F.col("hi") - F.col("lo")) * a))
        )

    b = bounds(stats)
    # One scalar subquery (a struct), evaluated once and reused by every
    # reference below.
    st = b.select(F.struct("lo", "hi", "step", "adj", "n").alias("st")).scalar()
    # The scalar is projected onto the rows once; the bin expression reads
    # the projected fields, so the plan holds one subquery reference.
    with_st = values.select("x", st.alias("st"))
    lo_v, hi_v = F.col("st.lo"), F.col("st.hi")
    step_v, adj_v = F.col("st.step"), F.col("st.adj")

    def edge(i: Column) -> Column:
        return (
            F.when(i <= 0, lo_v - adj_v)
            .when(i >= bins, hi_v)
            .otherwise(i.cast("double") * step_v + lo_v)
        )

    x = F.col("x")
    k0 = F.least(F.greatest(F.ceil((x - lo_v) / step_v).cast("int"), F.lit(1)), F.lit(bins))
    k = (
        F.when((k0 > 1) & (x <= edge(k0 - 1)), k0 - 1)
        .when((k0 < bins) & (x > edge(k0)), k0 + 1)
        .otherwise(k0)
    )
    counts = with_st.groupBy(k.alias("bin")).agg(F.count(F.lit(1)).alias("count"))

    # One-row frame → 21 edges → label precision → 20-row spine.
    def hof_edge(i: Column) -> Column:
        return (
            F.when(i == 0, F.col("lo") - F.col("adj"))
            .when(i == bins, F.col("hi"))
            .otherwise(i.cast("double") * F.col("step") + F.col("lo"))
        )

    # The spine reads the same scalar, so the data is scanned only for the
    # stats subquery and for the bin counts.
    spine = (
        frame.sparkSession.range(1)
        .select(st.alias("st"))
        .select("st.*")
        .where(F.col("n") > 0)
        .withColumn("edges", F.transform(F.sequence(F.lit(0), F.lit(bins)), hof_edge))
        .withColumn(
            "prec",
            F.coalesce(
                F.array_min(
                    F.filter(
                        F.sequence(F.lit(precision), F.lit(19)),
                        lambda p: F.size(F.array_distinct(
                            F.transform("edges", lambda e: _hof_round_frac(e, p))
                        )) == bins + 1,
                    )
                ),
                F.lit(precision),
            ),
        )
        .select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "edges", "prec")
        .select(
            "bin",
            _round_frac(F.element_at("edges", F.col("bin")), F.col("prec")).alias("bin_start"),
            _round_frac(F.element_at("edges", F.col("bin") + 1), F.col("prec")).alias("bin_end"),
        )
    )
    # Both sides hold at most ``bins`` rows.
    return (
        spine.join(F.broadcast(counts), "bin", "left")
        .select("bin", "bin_start", "bin_end", F.coalesce("count", F.lit(0)).alias("count"))
        .orderBy("bin")
    )


# --------------------------------------------------------------------------
# Tables and headline numbers
# --------------------------------------------------------------------------

def top_products(frame: DataFrame, k: int = TOP_K, round_to: int | None = 2) -> DataFrame:
    """Top ``k`` (item id, item type) by total sales, with mean rating.

    Partial aggregation per task collapses a hot item before the shuffle;
    ``orderBy().limit()`` plans a TakeOrderedAndProject (per-task top-k).
    Ties on the sum are broken by the key for a stable answer.
    """
    grouped = (
        frame.where(F.col("item_identifier").isNotNull() & F.col("item_type").isNotNull())
        .groupBy("item_identifier", "item_type")
        .agg(
            F.coalesce(F.sum("total_sales"), F.lit(0.0)).alias("total_sales"),
            F.avg("rating").alias("avg_rating"),
        )
    )
    top = grouped.orderBy(F.desc("total_sales"), "item_identifier", "item_type").limit(k)
    if round_to is not None:
        top = top.select(*round_numeric(top.columns, dict(top.dtypes), round_to))
    return top


def clamp_limit(limit: int) -> int:
    return max(min(int(limit), SAMPLE_MAX), 1)


def sample_rows(frame: DataFrame, limit: int = SAMPLE_DEFAULT, order_by: str = RECORD_ID,
                round_to: int | None = 2) -> DataFrame:
    """First ``clamp(limit, 1, 100)`` rows in ``order_by`` order, numerics rounded."""
    n = clamp_limit(limit)
    rows = frame.orderBy(order_by).limit(n)
    if round_to is not None:
        rows = rows.select(*round_numeric(rows.columns, dict(rows.dtypes), round_to))
    return rows


def headline_metrics(frame: DataFrame) -> DataFrame:
    """count, mean and sum of sales, mean rating; 0.0 on an empty frame."""
    n = F.count(F.lit(1))
    return frame.agg(
        n.alias("total_records"),
        F.when(n == 0, F.lit(0.0)).otherwise(F.avg("total_sales")).alias("avg_sales"),
        F.coalesce(F.sum("total_sales"), F.lit(0.0)).alias("total_sales"),
        F.when(n == 0, F.lit(0.0)).otherwise(F.avg("rating")).alias("avg_rating"),
    )


def dataset_summary(frame: DataFrame) -> DataFrame:
    """rows, column list, mean and sum of total sales (unfiltered)."""
    return frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(",".join(frame.columns)).alias("columns"),
        F.avg("total_sales").alias("total_sales_mean"),
        F.coalesce(F.sum("total_sales"), F.lit(0.0)).alias("total_sales_sum"),
    )


def filter_options(frame: DataFrame) -> DataFrame:
    """Distinct non-null values of the five filter dimensions, long form.

    One scan: the rows are reduced to the distinct combinations of the five
    (partial aggregation first), and only those are unpivoted.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(d).alias("filter_column"), F.col(d).cast("string").alias("value"))
        for d in FILTER_DIMENSIONS
    ])).alias("p")
    return (
        frame.select(*FILTER_DIMENSIONS)
        .distinct()
        .select(pairs)
        .select("p.filter_column", "p.value")
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("filter_column", "value")
    )


def sales_bounds(frame: DataFrame) -> DataFrame:
    return frame.agg(F.min("total_sales").alias("sales_min"), F.max("total_sales").alias("sales_max"))
