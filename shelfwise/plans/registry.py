"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Each one reads the whole bundled tables through ``plans.layers`` and
returns a lazy DataFrame (a few write a layer first and return the
read-back, which is the operator being exercised). Queries whose output
reads ``item_weight`` use the exact-median silver; the others use
``layers.silver_lazy``, whose median Catalyst prunes away unread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import round_half_even
from shelfwise.operators import dashboard as dash
from shelfwise.operators import star
from shelfwise.operators.clean import clean_frame, impute_weight, median_of, with_event_date
from shelfwise.operators.constraints import (
    check_foreign_keys,
    check_not_null,
    check_primary_keys,
    with_serial_id,
)
from shelfwise.operators.model import (
    build_pipeline,
    load_metrics,
    load_model,
    save_metrics,
    save_model,
    score,
    score_if_missing,
    split,
    MAX_DEPTH,
    train,
    training_frame,
    with_step_target,
)
from shelfwise.operators.quantiles import exact_median
from shelfwise.operators.schemas import append_all
from shelfwise.plans import layers
from shelfwise.plans.batch import frozen_weight_median, gold_tables, run_all, run_batch
from shelfwise.plans.dashboard import dashboard, prediction_sample, prediction_summary
from shelfwise.plans.star_queries import sales_by_dim_attributes
from shelfwise.plans.stream import (
    StreamJob,
    bronze_path,
    publish_rows,
    run_bronze,
    run_landing,
    run_silver_gold,
)
from shelfwise.schemas import DATE_NATURAL_KEY, ITEM_NATURAL_KEY, OUTLET_NATURAL_KEY, RAW_SCHEMA
from shelfwise.session import dropping_shuffles, ensure_checkpoint_dir, scratch_path
from shelfwise.sinks.versions import drop_folder
from shelfwise.sinks.warehouse import LOAD_ORDER, TableWarehouse, load_warehouse
from shelfwise.sources import messages
from shelfwise.sources.files import lookup, page, page_after, read_csv, stamp_ingest
from shelfwise.sources.pages import page_at, write_pages
from shelfwise.streaming.bronze import read_landed
from shelfwise.streaming.micro_batches import (
    BatchProcessor,
    StreamLayout,
    read_table,
    start_silver_gold,
)

Query = Callable[[SparkSession, str], DataFrame]

# ---- the dashboard's preset filter used by the filtered queries ----
PRESET_FILTER = {
    "item_type": ["ECONOMY", "STANDARD", "PROMO"],
    "outlet_size": ["Small", "High"],
    "item_fat_content": ["Low Fat"],
}
PRESET_RANGE = {"sales_min": 20000.0, "sales_max": 60000.0}

SILVER_OUT = (
    "item_fat_content", "item_identifier", "item_type", "outlet_establishment_year",
    "outlet_identifier", "outlet_location_type", "outlet_size", "outlet_type",
    "item_visibility", "item_weight", "total_sales", "rating", "ingest_ts", "record_id",
)


def _chart(name: str) -> Query:
    return lambda spark, sf: dash.chart(layers.silver_lazy(spark, sf), name)


def q_silver_clean(spark, sf):
    return layers.clean(spark, sf).select(*SILVER_OUT)


def q_normalize_labels(spark, sf):
    return layers.clean(spark, sf).groupBy("item_fat_content").agg(F.count(F.lit(1)).alias("count"))


def q_impute_weight(spark, sf):
    return layers.silver(spark, sf).select(*SILVER_OUT)


def q_impute_all_null(spark, sf):
    only_missing = layers.clean(spark, sf).where(F.col("item_weight").isNull())
    return impute_weight(only_missing, mode="exact").select("record_id", "item_weight")


def q_approx_median_error(spark, sf):
    """Rank error of the approximate median is within the 1 % target."""
    frame = layers.clean(spark, sf).where(F.col("item_weight").isNotNull())
    m = median_of(frame, "item_weight", mode="approx", relative_error=0.01)
    ranks = frame.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("item_weight") < m, 1).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("item_weight") <= m, 1).otherwise(0)).alias("at_or_below"),
    )
    lo = F.col("below") / F.col("n")
    hi = F.col("at_or_below") / F.col("n")
    return ranks.select(((lo <= 0.5 + 0.01) & (hi >= 0.5 - 0.01)).alias("within_error"))


def q_typed_casts(spark, sf):
    """Raw values as text, cast back with try_cast (ANSI-safe)."""
    raw = layers.bronze(spark, sf)
    return raw.select(
        "record_id",
        F.col("`Outlet Establishment Year`").cast("string").try_cast("int").alias("outlet_establishment_year"),
        F.col("`Item Weight`").cast("string").try_cast("double").alias("item_weight"),
        F.col("`Total Sales`").cast("string").try_cast("double").alias("total_sales"),
    )


def q_event_dates(spark, sf):
    return layers.gold_silver(spark, sf, lazy=True).groupBy("event_date").agg(F.count(F.lit(1)).alias("count"))


def q_training_frame(spark, sf):
    return training_frame(layers.silver(spark, sf))


def q_dim_item(spark, sf):
    return star.dim_item(layers.gold_silver(spark, sf, lazy=True))


def q_dim_outlet(spark, sf):
    return star.dim_outlet(layers.gold_silver(spark, sf, lazy=True))


def q_dim_date(spark, sf):
    return star.dim_date(layers.gold_silver(spark, sf, lazy=True))


def q_fact_sales(spark, sf):
    return star.fact_sales(layers.gold_silver(spark, sf))


def q_fact_via_join(spark, sf):
    return star.fact_of_written_dims(layers.silver_written(spark, sf), scratch_path(spark, "dims"))


def q_star_sales_by_item_type(spark, sf):
    g = star.build_gold_layers(layers.silver_lazy(spark, sf))
    return sales_by_dim_attributes(g["fact_sales"], g["dim_item"], "item_key", ["item_type"])


def q_star_sales_by_outlet(spark, sf):
    g = star.build_gold_layers(layers.silver_lazy(spark, sf))
    return sales_by_dim_attributes(g["fact_sales"], g["dim_outlet"], "outlet_key",
                                   ["outlet_type", "outlet_size"])


def q_top_products(spark, sf):
    return dash.top_products(layers.silver_lazy(spark, sf))


def q_sales_distribution(spark, sf):
    return dash.histogram(layers.silver_lazy(spark, sf))


def _rounded_metrics(frame: DataFrame) -> DataFrame:
    m = dash.headline_metrics(frame)
    return m.select("total_records", *[round_half_even(F.col(c)).alias(c)
                                       for c in ("avg_sales", "total_sales", "avg_rating")])


def q_headline_metrics(spark, sf):
    return _rounded_metrics(dash.apply_filters(layers.silver_lazy(spark, sf), **PRESET_FILTER))


def q_headline_metrics_empty(spark, sf):
    s = layers.silver_lazy(spark, sf)
    top = s.agg(F.max("total_sales")).scalar()
    return _rounded_metrics(s.where(F.col("total_sales") > top))


def q_summary(spark, sf):
    s = dash.dataset_summary(layers.silver_lazy(spark, sf).select(*SILVER_OUT))
    return s.select("rows", "columns", round_half_even(F.col("total_sales_mean")).alias("total_sales_mean"),
                    round_half_even(F.col("total_sales_sum")).alias("total_sales_sum"))


def q_filter_options(spark, sf):
    return dash.filter_options(layers.silver_lazy(spark, sf))


def q_sales_bounds(spark, sf):
    return dash.sales_bounds(layers.silver_lazy(spark, sf))


def q_chart_rollup(spark, sf):
    return dash.chart_rollup(layers.silver_lazy(spark, sf))


def q_dashboard_filtered(spark, sf):
    filtered = dash.apply_filters(layers.silver_lazy(spark, sf), **PRESET_FILTER, **PRESET_RANGE)
    return dash.chart_rollup(filtered)


def q_filter_multiselect(spark, sf):
    return dash.apply_filters(layers.silver_lazy(spark, sf), **PRESET_FILTER).select(
        "record_id", "item_type", "outlet_size", "item_fat_content", "total_sales")


def q_filter_sales_range(spark, sf):
    return dash.apply_filters(layers.silver_lazy(spark, sf), **PRESET_RANGE).select("record_id", "total_sales")


def q_filter_all_options(spark, sf):
    return dash.all_options_filter(layers.silver_lazy(spark, sf)).agg(F.count(F.lit(1)).alias("rows"))


def q_sample_rows(spark, sf):
    return dash.sample_rows(layers.silver(spark, sf).select(*SILVER_OUT), limit=50)


# --------------------------------------------------------------------------
# Sources and sinks
# --------------------------------------------------------------------------

RAW_OUT = ("Item Fat Content", "Item Identifier", "Item Type", "Outlet Establishment Year",
           "Outlet Identifier", "Outlet Location Type", "Outlet Size", "Outlet Type",
           "Item Visibility", "Item Weight", "Total Sales", "Rating")


def _raw_cols():
    return [F.col(f"`{c}`") for c in RAW_OUT]


def q_csv_bronze_roundtrip(spark, sf):
    """Raw rows → CSV (header) → read back with the declared schema."""


    path = scratch_path(spark, "csv-roundtrip")
    raw = layers.bronze(spark, sf).select(*_raw_cols(), "record_id")
    (raw.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField("record_id", T.StringType())])
    return read_csv(spark, path, schema=schema, stamp=False)


def q_json_decode(spark, sf):
    """Encode each raw row as a keyed JSON message and decode it back."""
    raw = layers.bronze(spark, sf)
    decoded = messages.decode(messages.encode(raw, extra=("record_id",)))
    return decoded.select(*_raw_cols(), "record_id")


def q_publish_messages(spark, sf):
    """Publish messages to the file transport, read back, decode."""
    path = scratch_path(spark, "messages")
    messages.publish(messages.encode(layers.bronze(spark, sf), extra=("record_id",)), path)
    back = messages.read_message_files(spark, path)
    decoded = back.select("key", F.from_json("value", messages.MESSAGE_SCHEMA).alias("d"))
    return decoded.select("key", *[F.col(f"d.`{c}`").alias(c) for c in RAW_OUT], "d.record_id")


def q_ingest_stamp(spark, sf):
    """Processing-time stamp: one value for the whole batch, never null."""
    stamped = stamp_ingest(layers.bronze(spark, sf).drop("ingest_ts"))
    return stamped.agg(F.count_distinct("ingest_ts").alias("distinct_stamps"),
                       F.count(F.when(F.col("ingest_ts").isNull(), 1)).alias("null_stamps"))


def q_scan_silver(spark, sf):
    """Silver written as Parquet and scanned back."""
    path = scratch_path(spark, "silver")
    layers.silver(spark, sf).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select(*SILVER_OUT)


def q_page_rows(spark, sf):
    return page(layers.bronze(spark, sf).select(*_raw_cols(), "record_id"), offset=1000, limit=1000)


def q_page_deep(spark, sf):
    """A page from four fifths into the feed, found by the rank index."""
    rows = layers.bronze(spark, sf).select(*_raw_cols(), "record_id")
    path = scratch_path(spark, "pages")
    write_pages(rows, path, range_rows=10_000)
    n = spark.read.parquet(f"{path}/index").agg(F.sum("rows")).first()[0] or 0
    return page_at(spark, path, offset=n * 4 // 5, limit=1000)


def q_schema_versions(spark, sf):
    """Three versions of the feed as one table: one without a rating and with whole prices, one with a channel, one with the year as text."""
    s = layers.silver_lazy(spark, sf).select("record_id", "outlet_size", "outlet_establishment_year", "total_sales", "rating")
    version = lambda size: s.where(F.col("outlet_size") == size)
    one = version("Small").withColumn("total_sales", F.floor("total_sales").cast("int")).drop("rating")
    two = version("Medium").withColumn("channel", F.lit("web"))
    three = version("High").withColumn("outlet_establishment_year", F.concat(F.lit("y"), F.col("outlet_establishment_year")))
    return append_all([one, two, three])


def q_page_keyset(spark, sf):
    return page_after(layers.bronze(spark, sf).select(*_raw_cols(), "record_id"),
                      last_key="5000", limit=1000)


def q_item_lookup(spark, sf):
    return lookup(layers.bronze(spark, sf).select(*_raw_cols(), "record_id"), "P42")


def q_gold_table_counts(spark, sf):
    """Whole batch job to Parquet (exact median), then rows per gold table."""


    res = run_batch(spark, layers.bronze(spark, sf), scratch_path(spark, "batch"), median_mode="exact")
    tables = gold_tables(spark, res)
    parts = [t.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
             for name, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _gold(spark, sf, lazy: bool = False):
    silver = layers.silver_lazy(spark, sf) if lazy else layers.silver_written(spark, sf)
    return star.build_gold_layers(silver)


def q_warehouse_load(spark, sf):
    """Load the star schema twice (truncate + load); counts must not double."""


    wh = TableWarehouse(scratch_path(spark, "warehouse"))
    gold = _gold(spark, sf)
    load_warehouse(gold, wh)
    load_warehouse(gold, wh)
    parts = [wh.read(spark, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows"))
             for t in LOAD_ORDER]
    return reduce(DataFrame.unionByName, parts)


def q_check_pk(spark, sf):
    return check_primary_keys(_gold(spark, sf, lazy=True))


def q_check_not_null(spark, sf):
    return check_not_null(_gold(spark, sf, lazy=True))


def q_check_fk(spark, sf):
    """The feed is read once; the checks read the natural keys as written."""
    path = scratch_path(spark, "check-fk")
    keys = (*ITEM_NATURAL_KEY, *OUTLET_NATURAL_KEY, *DATE_NATURAL_KEY)
    layers.gold_silver(spark, sf, lazy=True).select(*keys).write.parquet(path)
    rows = spark.read.parquet(path)
    return check_foreign_keys({
        "dim_item": star.dim_item(rows), "dim_outlet": star.dim_outlet(rows), "dim_date": star.dim_date(rows),
        "fact_sales": rows.select(star.item_key().alias("item_key"), star.outlet_key().alias("outlet_key"),
                                  star.date_key().alias("date_key")),
    })


def q_fact_serial_unique(spark, sf):
    fact = with_serial_id(_gold(spark, sf, lazy=True)["fact_sales"])
    return fact.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("sales_id").alias("distinct_ids"))


# Rows of one establishment year lose their outlet size (null natural key).
NULL_SIZE_YEAR = 1990


def q_fact_null_keys(spark, sf):
    """Null natural key: join mode leaves a null fact key, inline resolves."""
    s = layers.silver_lazy(spark, sf)
    s = s.withColumn("outlet_size", F.when(F.col("outlet_establishment_year") == NULL_SIZE_YEAR,
                                           F.lit(None).cast("string")).otherwise(F.col("outlet_size")))
    g = with_event_date(s)
    dim = star.dim_outlet(g)
    joined = star.fact_sales(g, mode="join")
    inline = star.fact_sales(g, mode="inline")
    unresolved = inline.select("outlet_key").join(dim.select("outlet_key"), "outlet_key", "left_anti")
    inline_nulls = inline.agg(F.count(F.when(F.col("outlet_key").isNull(), 1))).scalar()
    unresolved_rows = unresolved.agg(F.count(F.lit(1))).scalar()
    return joined.agg(
        F.count(F.when(F.col("outlet_key").isNull(), 1)).alias("join_null_keys"),
        inline_nulls.alias("inline_null_keys"),
        unresolved_rows.alias("inline_unresolved"),
    )


def q_sales_distribution_constant(spark, sf):
    """Degenerate histogram: a constant measure (rating of the 1.5 rows)."""
    rows = layers.silver_lazy(spark, sf).where(F.col("rating") == 1.5)
    return dash.histogram(rows, column="rating")


def q_sales_distribution_empty(spark, sf):
    s = layers.silver_lazy(spark, sf)
    return dash.histogram(s.where(F.col("total_sales") > s.agg(F.max("total_sales")).scalar()))


def q_feed_without_id_dashboard(spark, sf):
    """The 12-column feed through CSV, batch build and a dashboard request: grouped sales of its item types."""
    raw = layers.bronze(spark, sf).select(*[F.col(f"`{c.name}`") for c in RAW_SCHEMA.fields])
    folder = scratch_path(spark, "feed-without-id")
    (raw.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip")
     .option("maxRecordsPerFile", messages.FILE_RECORDS).csv(f"{folder}/csv"))
    built = run_batch(spark, read_csv(spark, f"{folder}/csv"), folder)
    panels = dashboard(spark.read.parquet(built.silver), share_grain=False)
    sampled = panels["sample_rows"].agg(F.count("record_id")).scalar()
    return panels["sales_by_item_type"].select("*", (sampled == 50).alias("sampled"))


def q_stream_dedup_without_id(spark, sf):
    """Twelve-column messages published twice: each distinct record once."""
    raw = layers.bronze(spark, sf).select(*[F.col(f"`{c.name}`") for c in RAW_SCHEMA.fields])
    folder = scratch_path(spark, "dedup-without-id")
    for _ in range(2):
        publish_rows(raw, f"{folder}/messages", extra=())
    path = run_bronze(spark, f"{folder}/messages", folder, dedup=True)
    drop_folder(spark, f"{folder}/messages")
    return spark.read.parquet(path).select(*_raw_cols())


def q_nan_measures(spark, sf):
    """NaN among the sales is no value: sums, bounds and the range filter skip it."""
    raw = layers.bronze(spark, sf).withColumn(
        "Total Sales", F.when(F.col("`Outlet Size`") == "Small", F.lit(float("nan"))).otherwise(F.col("`Total Sales`")))
    s = clean_frame(raw)
    kept = dash.apply_filters(s, sales_min=0.0).agg(F.count(F.lit(1))).scalar()
    bounds = dash.sales_bounds(s)
    return dash.headline_metrics(s).select("total_records", round_half_even(F.col("total_sales")).alias("total_sales"),
                                           kept.alias("in_range"), bounds.select("sales_max").scalar().alias("sales_max"))


def q_csv_reordered_header(spark, sf):
    """A CSV whose columns come in another order, with one more: read by header name."""
    raw = layers.bronze(spark, sf)
    path = scratch_path(spark, "csv-reordered")
    names = [c.name for c in reversed(RAW_SCHEMA.fields)]
    raw.select(F.lit("x").alias("Extra"), *[F.col(f"`{c}`") for c in names], "record_id").write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return read_csv(spark, path, stamp=False).select(*_raw_cols(), "record_id", F.col("Extra").alias("extra"))


def q_score_null_rows(spark, sf):
    """Stored predictions stay, missing ones are scored: every row has one, and the stored ones are unchanged."""
    model, _ = _trained(spark, sf)
    stored = F.when(F.col("outlet_size") == "Small", F.lit(-1.0))
    rows = score_if_missing(model, layers.silver(spark, sf).withColumn("predicted_total_sales", stored))
    return rows.select("record_id", (F.col("predicted_total_sales") == -1.0).alias("stored"))


def q_append_missing_columns(spark, sf):
    """Union by name where one side lacks a column (filled with null)."""
    s = layers.silver_lazy(spark, sf).select("record_id", "outlet_size", "total_sales", "ingest_ts")
    with_date = with_event_date(s.where(F.col("outlet_size") == "Small")).drop("ingest_ts")
    without = s.where(F.col("outlet_size") != "Small").drop("ingest_ts")
    return with_date.unionByName(without, allowMissingColumns=True)


# --------------------------------------------------------------------------
# Streaming (file transport, availableNow triggers, read-back of the sinks)
# --------------------------------------------------------------------------

STREAM_OUT = tuple(c for c in SILVER_OUT if c != "item_weight")
FROZEN_WEIGHT = 25.0


def _bronze_rows(spark, sf):
    return layers.bronze(spark, sf)


def _parts(rows: DataFrame, n: int):
    bucket = F.pmod(F.xxhash64("record_id"), F.lit(n))
    return [rows.where(bucket == i) for i in range(n)]


def _publish_parts(rows: DataFrame, path: str, files: int) -> None:
    """Publish ``rows`` as about ``files`` message files, or more where their size calls for it, without a shuffle."""
    with dropping_shuffles(rows.sparkSession):
        n = rows.count()
    publish_rows(rows, path, file_records=min(messages.FILE_RECORDS, max(1, -(-n // files))))


def _published(spark, sf, files: int = 6):
    """Publish the whole feed once, as ``files`` message files or more;
    ``_files_of`` then turns them into several micro-batches."""
    base = scratch_path(spark, "stream")
    path = f"{base}/messages"
    _publish_parts(_bronze_rows(spark, sf), path, files)
    return base, path


def _files_of(spark, path: str, batches: int) -> int:
    """Files of a micro-batch so that the folder gives ``batches`` of them, however many files its size makes."""
    return max(1, -(-len(spark.read.text(path).inputFiles()) // batches))


def _streamed(spark, messages_path: str, base: str, batches: int, **silver) -> StreamLayout:
    """Both stages, each in ``batches`` micro-batches; the messages go once they have landed."""
    landed = run_bronze(spark, messages_path, base, max_files_per_trigger=_files_of(spark, messages_path, batches))
    drop_folder(spark, messages_path)
    return run_silver_gold(spark, base, max_files_per_trigger=_files_of(spark, landed, batches), **silver)


def q_stream_bronze(spark, sf):
    base, messages = _published(spark, sf)
    path = run_bronze(spark, messages, base, max_files_per_trigger=_files_of(spark, messages, 2))
    return spark.read.parquet(path).select(*_raw_cols(), "record_id")


def q_stream_silver(spark, sf):
    base, messages = _published(spark, sf)
    layout = _streamed(spark, messages, base, 2)
    return spark.read.parquet(layout.silver).select(*STREAM_OUT)


def q_stream_gold_equals_batch(spark, sf):
    """All columns of the five gold tables that several micro-batches built, compacted on the way, with the exact median as frozen value."""
    base, messages = _published(spark, sf)
    median = exact_median(layers.clean(spark, sf), "item_weight")
    layout = _streamed(spark, messages, base, 3, median_scope="frozen", frozen_median=median, compact_every=2)
    tables = ("gold_silver", "dim_item", "dim_outlet", "dim_date", "fact_sales")
    parts = [read_table(spark, layout, t).withColumn("table_name", F.lit(t)) for t in tables]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def q_stream_dedup_late(spark, sf):
    """The feed published three times, with a restart from the checkpoint before each: every record once, however late its copies."""
    base = scratch_path(spark, "dedup-late")
    messages = f"{base}/messages"
    rows = _bronze_rows(spark, sf)
    for _ in range(3):
        publish_rows(rows, messages)
        path = run_bronze(spark, messages, base, dedup=True)
        drop_folder(spark, messages)
    return spark.read.parquet(path).select(*_raw_cols(), "record_id")


BROKEN_RATING = 1.5


def q_stream_rejects(spark, sf):
    """Messages of one rating are cut to no JSON: the stream lands them as rejects, by key, and the others as bronze."""
    base = scratch_path(spark, "rejects")
    rows = _bronze_rows(spark, sf)
    sent = messages.encode(rows.where(F.col("Rating") != BROKEN_RATING), extra=("record_id", "ingest_ts"))
    broken = messages.encode(rows.where(F.col("Rating") == BROKEN_RATING), extra=("record_id",))
    broken = broken.withColumn("value", F.concat(F.lit("no json "), F.substring("value", 2, 10_000)))
    rows = sent.unionByName(broken)
    messages.publish(rows, f"{base}/messages", file_records=min(messages.FILE_RECORDS, max(1, -(-rows.count() // 6))))
    good, rejected = run_landing(spark, f"{base}/messages", base, dedup=True,
                                 max_files_per_trigger=_files_of(spark, f"{base}/messages", 3))
    drop_folder(spark, f"{base}/messages")
    count = F.count(F.lit(1)).alias("rows")
    landed = read_landed(spark, good).groupBy(F.lit("bronze").alias("kind"), F.col("`Item Identifier`").alias("key")).agg(count)
    return landed.unionByName(read_landed(spark, rejected).groupBy(F.lit("reject").alias("kind"), "key").agg(count))


def q_stream_concurrent(spark, sf):
    """Both stages at once, with the second half of the feed published while they run: silver as of the last finished batch."""
    base = scratch_path(spark, "concurrent")
    first, second = _parts(_bronze_rows(spark, sf), 2)
    _publish_parts(first, f"{base}/messages", 2)
    job = StreamJob(spark, f"{base}/messages", base, trigger="500 milliseconds", dedup=True,
                    max_files_per_trigger=_files_of(spark, f"{base}/messages", 1))
    _publish_parts(second, f"{base}/messages", 2)
    return read_table(spark, job.finish(), "silver").select(*STREAM_OUT)


def q_frozen_median_from_batch(spark, sf):
    """The batch build's stored sketch gives the stream its median: filled everywhere, within 1 % of the middle rank."""
    build = run_batch(spark, layers.bronze(spark, sf), scratch_path(spark, "lake"))
    base, messages = _published(spark, sf)
    run_bronze(spark, messages, base)
    drop_folder(spark, messages)
    layout = run_silver_gold(spark, base, frozen_from=build.base)
    median = frozen_weight_median(spark, build.base)
    clean = layers.clean(spark, sf)
    gaps = clean.where(F.col("item_weight").isNull()).select("record_id")
    filled = read_table(spark, layout, "silver").join(gaps, "record_id", "left_semi")
    weight = F.col("item_weight")
    below, upto, n = F.count_if(weight < median), F.count_if(weight <= median), F.count(weight)
    return clean.agg(
        n.alias("weights"),
        ((below / n <= 0.51) & (upto / n >= 0.49)).alias("within_error"),
        filled.agg(F.count_if(weight == median)).scalar().alias("filled"),
    )


def q_stream_restart(spark, sf):
    """Run, add more messages, run again from the checkpoint: each row once."""
    base = scratch_path(spark, "restart")
    messages = f"{base}/messages"
    first, second, third = _parts(_bronze_rows(spark, sf), 3)
    publish_rows(first, messages)
    publish_rows(second, messages)
    run_bronze(spark, messages, base)
    publish_rows(third, messages)
    path = run_bronze(spark, messages, base)
    return spark.read.parquet(path).select(*_raw_cols(), "record_id")


def q_stream_dedup(spark, sf):
    """The whole feed published twice; de-duplication keeps each record once."""
    base = scratch_path(spark, "dedup")
    messages = f"{base}/messages"
    rows = _bronze_rows(spark, sf)
    publish_rows(rows, messages)
    run_bronze(spark, messages, base, dedup=True)
    publish_rows(rows, messages)
    path = run_bronze(spark, messages, base, dedup=True)
    return spark.read.parquet(path).select(*_raw_cols(), "record_id")


def q_stream_impute_scopes(spark, sf):
    """Frozen scope fills every gap with the frozen value; batch scope fills
    each micro-batch's gaps with one value of its own."""

    base, messages = _published(spark, sf)

    landed = run_bronze(spark, messages, base, max_files_per_trigger=_files_of(spark, messages, 2))
    drop_folder(spark, messages)
    gaps = layers.clean(spark, sf).where(F.col("item_weight").isNull()).select("record_id")
    frozen_base = scratch_path(spark, "frozen")
    batch_base = scratch_path(spark, "batchscope")
    results = {}
    for scope, out in (("frozen", frozen_base), ("batch", batch_base)):
        # Both runs consume the same bronze folder with their own checkpoints.
        layout = StreamLayout(out)
        proc = BatchProcessor(layout, median_scope=scope, frozen_median=FROZEN_WEIGHT)
        start_silver_gold(spark, bronze_path(base), layout, proc, max_files_per_trigger=_files_of(spark, landed, 2)).awaitTermination()
        drop_folder(spark, f"{out}/gold")  # only silver is compared
        results[scope] = spark.read.parquet(layout.silver).join(gaps, "record_id", "left_semi")
    frozen_ok = results["frozen"].agg(
        F.coalesce(F.min(F.col("item_weight") == FROZEN_WEIGHT), F.lit(False))).scalar()
    per_batch = results["batch"].groupBy("batch_id").agg(
        F.count_distinct("item_weight").alias("values"), F.count("item_weight").alias("filled"),
        F.count(F.lit(1)).alias("rows"))
    return per_batch.agg(
        frozen_ok.alias("frozen_ok"),
        F.coalesce(F.max("values") == 1, F.lit(False)).alias("one_value_per_batch"),
        (F.sum("filled") == F.sum("rows")).alias("all_filled"),
    )


# --------------------------------------------------------------------------
# Machine learning (full forest on a learnable target that two categories fix)
# --------------------------------------------------------------------------

STEP = "step_sales"


def _trained(spark, sf):
    """The full forest on the step target; returns (model, metrics).

    Its groups of trees are saved under the checkpoint folder, and a later query takes up the saved ones.
    """
    data = hashlib.sha256(f"{spark.sparkContext.applicationId}:{sf}".encode()).hexdigest()[:16]
    store = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shelfwise/forest-{data}"
    return train(with_step_target(layers.silver(spark, sf), STEP), target=STEP, store=store)


def q_onehot_unknown(spark, sf):
    """Unknown and null categories encode to the all-zero one-hot vector."""


    silver = layers.silver(spark, sf)
    stages = build_pipeline().getStages()[:2]

    enc = Pipeline(stages=stages).fit(silver)
    probe = silver.withColumn(
        "item_type",
        F.when(F.col("outlet_size") == "Small", F.lit("never seen"))
        .when(F.col("outlet_size") == "Medium", F.lit(None).cast("string"))
        .otherwise(F.col("item_type")))
    out = enc.transform(probe).withColumn("v", vector_to_array("item_type__ohe"))
    nz = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + F.abs(x))
    return out.agg(
        F.min(F.when(F.col("outlet_size") == "Small", nz == 0)).alias("unknown_all_zero"),
        F.min(F.when(F.col("outlet_size") == "Medium", nz == 0)).alias("null_all_zero"),
        F.min(F.when(F.col("outlet_size") == "High", nz == 1)).alias("known_one_hot"),
    )


def q_train_split(spark, sf):
    """80/20 hash split: disjoint, complete, close to 80 %."""
    silver = layers.silver_lazy(spark, sf)
    train_df, test_df = split(silver)
    n_train = train_df.agg(F.count(F.lit(1))).scalar()
    n_test = test_df.agg(F.count(F.lit(1))).scalar()
    overlap = train_df.select("record_id").join(test_df.select("record_id"), "record_id").agg(
        F.count(F.lit(1))).scalar()
    return silver.agg(F.count(F.lit(1)).alias("n")).select(
        ((n_train + n_test) == F.col("n")).alias("complete"),
        (overlap == 0).alias("disjoint"),
        (F.abs(n_train / F.col("n") - 0.8) < 0.02).alias("near_80_pct"),
    )


def q_train_forest(spark, sf):
    """Trees and one-hot features of the fitted forest, and its distinct predictions over all rows."""
    model, _ = _trained(spark, sf)
    scored = score(model, layers.silver(spark, sf))
    return scored.groupBy(F.col("predicted_total_sales").alias("prediction")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(model.num_trees).cast("long").alias("trees"),
        F.lit(model.num_features).cast("long").alias("features"),
        F.lit(model.depth <= MAX_DEPTH).alias("depth_ok"),
    )


def q_model_metrics(spark, sf):
    """Metrics document written and read back; the forest explains the step target."""
    path = scratch_path(spark, "metrics")
    save_metrics(_trained(spark, sf)[1], path)
    return load_metrics(spark, path).select(*[F.round(m, 9).alias(m) for m in ("mae", "rmse", "r2")])


def q_model_roundtrip(spark, sf):
    """Saved + loaded model predicts exactly what the fitted one does."""
    model, _ = _trained(spark, sf)
    path = scratch_path(spark, "model")
    save_model(model, path)
    loaded = load_model(spark, path)
    silver = layers.silver(spark, sf)
    a = score(model, silver).select("record_id", F.col("predicted_total_sales").alias("a"))
    b = score(loaded, silver).select("record_id", F.col("predicted_total_sales").alias("b"))
    return a.join(b, "record_id").agg(
        F.count(F.when(F.col("a") != F.col("b"), 1)).alias("mismatches"),
        (F.count(F.lit(1)) == silver.agg(F.count(F.lit(1))).scalar()).alias("all_rows"))


def q_score_batch(spark, sf):
    model, _ = _trained(spark, sf)
    return score(model, layers.silver(spark, sf)).select("record_id", "predicted_total_sales")


def q_score_if_missing(spark, sf):
    """An existing prediction column is kept, not re-scored."""
    model, _ = _trained(spark, sf)
    silver = layers.silver(spark, sf).withColumn("predicted_total_sales", F.col("total_sales"))
    again = score_if_missing(model, silver)
    return again.agg(F.count(F.when(F.col("predicted_total_sales") != F.col("total_sales"), 1))
                     .alias("rescored_rows"))


def q_prediction_summary(spark, sf):
    model, _ = _trained(spark, sf)
    filtered = dash.apply_filters(layers.silver(spark, sf), **PRESET_FILTER)
    return prediction_summary(model, filtered)


def q_prediction_sample(spark, sf):
    model, _ = _trained(spark, sf)
    filtered = dash.apply_filters(layers.silver(spark, sf), **PRESET_FILTER)
    return prediction_sample(model, filtered.select(*SILVER_OUT), limit=50)


def q_stream_scoring(spark, sf):
    """Micro-batches scored in foreachBatch with the trained model."""
    model, _ = _trained(spark, sf)
    base, messages = _published(spark, sf)
    layout = _streamed(spark, messages, base, 2, model=model)
    return spark.read.parquet(layout.silver).select("record_id", "predicted_total_sales")


def q_model_absent(spark, sf):
    """No trained model yet: no predictions, summary 0.0, R² 0.0 ({} metrics)."""
    from shelfwise.plans.dashboard import headline_with_model

    missing = scratch_path(spark, "no-model")
    model = load_model(spark, f"{missing}/model")
    metrics = load_metrics(spark, f"{missing}/metrics")
    filtered = dash.apply_filters(layers.silver_lazy(spark, sf), **PRESET_FILTER)
    summary = prediction_summary(model, filtered)
    r2 = headline_with_model(filtered, metrics).select("model_r2").scalar()
    sampled = prediction_sample(model, filtered, limit=50)
    return summary.select(
        F.lit(model is None).alias("no_model"),
        (F.col("avg_predicted_total_sales") == 0.0).alias("avg_zero"),
        (F.col("sum_predicted_total_sales") == 0.0).alias("sum_zero"),
        (r2 == 0.0).alias("r2_zero"),
        F.lit("predicted_total_sales" not in sampled.columns).alias("sample_unscored"),
    )


# Star-schema SQL as a warehouse user writes it (views over the loaded tables).
WAREHOUSE_SQL = """
SELECT i.item_type, o.outlet_type, YEAR(d.event_date) AS sales_year,
       rint(SUM(f.total_sales) * 100) / 100 AS total_sales, COUNT(*) AS sales_rows
FROM {p}fact_sales f
JOIN {p}dim_item i ON f.item_key = i.item_key
JOIN {p}dim_outlet o ON f.outlet_key = o.outlet_key
JOIN {p}dim_date d ON f.date_key = d.date_key
GROUP BY i.item_type, o.outlet_type, YEAR(d.event_date)
"""


def q_warehouse_sql(spark, sf):
    """Load the star schema, then answer a business question in Spark SQL."""
    import uuid

    wh = TableWarehouse(scratch_path(spark, "warehouse-sql"))
    load_warehouse(_gold(spark, sf), wh)
    prefix = f"wh_{uuid.uuid4().hex[:8]}_"
    wh.register_views(spark, prefix)
    return spark.sql(WAREHOUSE_SQL.format(p=prefix))


def q_score_bounds(spark, sf):
    """Every row is scored, and a forest's predictions (means of leaf means)
    stay within the training target's range."""
    model, _ = _trained(spark, sf)
    silver = with_step_target(layers.silver(spark, sf), STEP)
    lo = silver.agg(F.min(STEP)).scalar()
    hi = silver.agg(F.max(STEP)).scalar()
    scored = score(model, silver)
    p = F.col("predicted_total_sales")
    return scored.agg(
        (F.count(p) == F.count(F.lit(1))).alias("all_scored"),
        F.coalesce(F.min((p >= lo - 1e-9) & (p <= hi + 1e-9)), F.lit(False)).alias("within_target_range"),
    )


def q_job_batch_all(spark, sf):
    """Feed to warehouse in one call: rows of every loaded table, and the metrics that the job wrote."""
    base = scratch_path(spark, "job")
    wh = TableWarehouse(f"{base}/warehouse")
    feed = with_step_target_feed(layers.bronze(spark, sf))
    job = run_all(spark, feed, f"{base}/lake", wh, median_mode="exact")
    r2 = F.round(load_metrics(spark, job.metrics).select("r2").scalar(), 9)
    rows = [wh.read(spark, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows")) for t in LOAD_ORDER]
    return reduce(DataFrame.unionByName, rows).withColumn("r2", r2)


def with_step_target_feed(raw: DataFrame) -> DataFrame:
    """The feed with sales that its categories fix (see ``with_step_target``)."""
    named = raw.withColumns({"outlet_size": F.col("`Outlet Size`"), "outlet_type": F.col("`Outlet Type`")})
    return with_step_target(named, "Total Sales").drop("outlet_size", "outlet_type")


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name, *_ in dash.CHARTS:
        q[name] = _chart(name)
    q.update({
        "silver_clean": q_silver_clean,
        "normalize_labels": q_normalize_labels,
        "impute_weight": q_impute_weight,
        "impute_all_null": q_impute_all_null,
        "approx_median_error": q_approx_median_error,
        "typed_casts": q_typed_casts,
        "event_dates": q_event_dates,
        "training_frame": q_training_frame,
        "dim_item": q_dim_item,
        "dim_outlet": q_dim_outlet,
        "dim_date": q_dim_date,
        "fact_sales": q_fact_sales,
        "fact_via_join": q_fact_via_join,
        "star_sales_by_item_type": q_star_sales_by_item_type,
        "star_sales_by_outlet": q_star_sales_by_outlet,
        "top_products": q_top_products,
        "sales_distribution": q_sales_distribution,
        "headline_metrics": q_headline_metrics,
        "headline_metrics_empty": q_headline_metrics_empty,
        "summary": q_summary,
        "filter_options": q_filter_options,
        "sales_bounds": q_sales_bounds,
        "chart_rollup": q_chart_rollup,
        "dashboard_filtered": q_dashboard_filtered,
        "filter_multiselect": q_filter_multiselect,
        "filter_sales_range": q_filter_sales_range,
        "filter_all_options": q_filter_all_options,
        "sample_rows": q_sample_rows,
        "csv_bronze_roundtrip": q_csv_bronze_roundtrip,
        "json_decode": q_json_decode,
        "publish_messages": q_publish_messages,
        "ingest_stamp": q_ingest_stamp,
        "scan_silver": q_scan_silver,
        "page_rows": q_page_rows,
        "page_keyset": q_page_keyset,
        "page_deep": q_page_deep,
        "schema_versions": q_schema_versions,
        "item_lookup": q_item_lookup,
        "gold_table_counts": q_gold_table_counts,
        "warehouse_load": q_warehouse_load,
        "check_pk": q_check_pk,
        "check_not_null": q_check_not_null,
        "check_fk": q_check_fk,
        "fact_serial_unique": q_fact_serial_unique,
        "fact_null_keys": q_fact_null_keys,
        "sales_distribution_constant": q_sales_distribution_constant,
        "sales_distribution_empty": q_sales_distribution_empty,
        "append_missing_columns": q_append_missing_columns,
        "feed_without_id_dashboard": q_feed_without_id_dashboard,
        "stream_dedup_without_id": q_stream_dedup_without_id,
        "nan_measures": q_nan_measures,
        "csv_reordered_header": q_csv_reordered_header,
        "score_null_rows": q_score_null_rows,
        "stream_bronze": q_stream_bronze,
        "stream_silver": q_stream_silver,
        "stream_gold_equals_batch": q_stream_gold_equals_batch,
        "stream_restart": q_stream_restart,
        "stream_dedup_late": q_stream_dedup_late,
        "stream_rejects": q_stream_rejects,
        "stream_concurrent": q_stream_concurrent,
        "frozen_median_from_batch": q_frozen_median_from_batch,
        "job_batch_all": q_job_batch_all,
        "stream_dedup": q_stream_dedup,
        "stream_impute_scopes": q_stream_impute_scopes,
        "onehot_unknown": q_onehot_unknown,
        "train_split": q_train_split,
        "train_forest": q_train_forest,
        "model_metrics": q_model_metrics,
        "model_roundtrip": q_model_roundtrip,
        "score_batch": q_score_batch,
        "score_if_missing": q_score_if_missing,
        "prediction_summary": q_prediction_summary,
        "prediction_sample": q_prediction_sample,
        "stream_scoring": q_stream_scoring,
        "model_absent": q_model_absent,
        "warehouse_sql": q_warehouse_sql,
        "score_bounds": q_score_bounds,
    })
    return q
