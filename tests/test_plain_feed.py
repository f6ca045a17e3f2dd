"""The plain 12-column feed, value faults and narrow errors."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.functions.columns import round_half_even
from shelfwise.operators import dashboard as dash
from shelfwise.operators.clean import clean_frame
from shelfwise.operators.model import evaluate, load_metrics, load_model, score_if_missing, train, with_planted_target
from shelfwise.plans.batch import run_batch
from shelfwise.plans.dashboard import dashboard
from shelfwise.schemas import RAW_SCHEMA
from shelfwise.session import scratch_path
from shelfwise.sources.files import read_csv, with_record_id
from shelfwise.sources.messages import encode, publish
from shelfwise.sources.testdata import sales_source
from shelfwise.streaming.bronze import to_bronze

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def feed(spark):
    return sales_source(spark, SF_SMALL).select(*[F.col(f"`{c.name}`") for c in RAW_SCHEMA.fields]).limit(800).cache()


def test_csv_feed_through_dashboard_and_training(spark, feed):
    folder = scratch_path(spark, "plain-feed")
    feed.write.option("header", True).csv(f"{folder}/csv")
    built = run_batch(spark, read_csv(spark, f"{folder}/csv"), folder)
    silver = spark.read.parquet(built.silver)
    panels = dashboard(silver.drop("record_id"), limit=20, share_grain=False)
    assert panels["sample_rows"].count() == panels["prediction_sample"].count() == 20
    model, metrics = train(with_planted_target(silver.drop("record_id"), "planted"), num_trees=3, max_depth=4, target="planted")
    assert metrics.first()["r2"] > 0
    half = silver.withColumn("predicted_total_sales", F.when(F.col("outlet_size") == "Small", F.lit(-1.0)))
    scored = score_if_missing(model, half)
    assert scored.where("predicted_total_sales is null").isEmpty()
    assert scored.where("predicted_total_sales = -1").count() == silver.where("outlet_size = 'Small'").count()


def test_ids_follow_the_content(spark, feed):
    one = with_record_id(feed).select("record_id")
    again = with_record_id(feed.repartition(5)).select("record_id")
    assert one.exceptAll(again).isEmpty()
    assert one.distinct().count() == feed.distinct().count()
    gaps = with_record_id(spark.createDataFrame([("a", None), (None, "a")], "`Outlet Size` string, `Outlet Type` string"))
    assert gaps.select("record_id").distinct().count() == 2


@pytest.mark.parametrize("keys", [("record_id",), ("Item Identifier", "Outlet Size")])
def test_stream_dedup_without_ids_keeps_every_record(spark, feed, keys):
    folder = scratch_path(spark, "plain-dedup")
    rows = feed.withColumn("Outlet Size", F.when(F.col("`Outlet Size`") != "High", F.col("`Outlet Size`")))
    for _ in range(2):
        publish(encode(rows), f"{folder}/messages")
    stream = spark.readStream.schema("key string, value string").json(f"{folder}/messages")
    out = to_bronze(stream, keys)
    query = out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    if keys == ("record_id",):
        want = rows.distinct().count()
    else:
        named = rows.where("`Outlet Size` is not null").select(*[F.col(f"`{k}`") for k in keys]).distinct().count()
        want = named + rows.where("`Outlet Size` is null").distinct().count()
    assert got.count() == want


def test_nan_is_no_value(spark):
    rows = clean_frame(spark.createDataFrame([(1.0,), (float("nan"),), (300.0,)], "`Total Sales` double"))
    assert rows.where("total_sales is null").count() == 1
    assert dash.sales_bounds(rows).first()["sales_max"] == 300.0
    assert rows.where("total_sales >= 100").count() == 1


def test_rounding_equals_pandas(spark):
    values = [10.075, 0.125, 0.135, 2.675, -1.005, 1e9 + 0.005, None, *np.random.default_rng(1).normal(0, 1e4, 500).tolist()]
    frame = spark.createDataFrame([(v,) for v in values], "x double").select("x", round_half_even(F.col("x")).alias("r")).toPandas()
    assert np.array_equal(frame["r"].to_numpy(), pd.Series(frame["x"]).round(2).to_numpy(), equal_nan=True)


def test_csv_goes_by_header_name(spark, feed):
    path = scratch_path(spark, "reordered")
    names = [c.name for c in reversed(RAW_SCHEMA.fields)]
    feed.select(F.lit("x").alias("Extra"), *[F.col(f"`{n}`") for n in names if n != "Rating"]).write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    got = read_csv(spark, path, stamp=False)
    assert got.columns == [*RAW_SCHEMA.names, "Extra"] and got.where("Rating is not null").isEmpty()
    same = [F.col(f"`{c.name}`") for c in RAW_SCHEMA.fields if c.name != "Rating"]
    assert got.select(*same).exceptAll(feed.select(*same)).isEmpty()


@pytest.mark.parametrize(("predicted", "want"), [(5.0, 1.0), (6.0, 0.0)])
def test_r2_of_a_constant_target(spark, predicted, want):
    rows = spark.createDataFrame([(5.0, predicted)] * 3, "total_sales double, predicted_total_sales double")
    assert evaluate(rows).first()["r2"] == want


def test_only_absence_means_absent(spark):
    path = scratch_path(spark, "broken-model")
    assert load_model(spark, path) is None and load_metrics(spark, path).isEmpty()
    spark.createDataFrame([("not a model",)], "value string").write.text(f"{path}/metadata")
    with pytest.raises(Exception):
        load_model(spark, path)
