"""Plan assertions: pushdown, pruning, no joins/UDFs where none belong."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from shelfwise.operators import dashboard as dash
from shelfwise.plans import layers
from shelfwise.plans.registry import registry
from shelfwise.session import scratch_path

PKG = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "shelfwise")


def plan_text(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    text = buf.getvalue()
    return text[text.index("== Physical Plan =="):]


@pytest.fixture(scope="module")
def silver_parquet(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    path = scratch_path(spark, "plan-silver")
    layers.silver(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_reach_parquet_scan(silver_parquet):
    df = dash.apply_filters(silver_parquet, item_type=["PROMO"], sales_min=100.0)
    text = plan_text(df)
    assert "PushedFilters: [" in text
    assert "In(item_type" in text or "EqualTo(item_type" in text
    assert "GreaterThanOrEqual(total_sales" in text


def test_chart_reads_only_needed_columns(silver_parquet):
    text = plan_text(dash.chart(silver_parquet, "sales_by_item_type"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == {"item_type", "total_sales"}


def test_inline_fact_has_no_join(silver_parquet):
    from shelfwise.operators.star import fact_sales

    text = plan_text(fact_sales(silver_parquet))
    assert "Join" not in text and "Exchange" not in text


def test_top_products_uses_take_ordered(silver_parquet):
    assert "TakeOrderedAndProject" in plan_text(dash.top_products(silver_parquet))


def test_rollup_aggregates_before_expanding(silver_parquet):
    text = plan_text(dash.chart_rollup(silver_parquet))
    # Expand runs on the grain aggregate, not on the scan.
    assert text.index("Expand") < text.rindex("HashAggregate")


PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow")
# Queries whose work is done before they return a plan, and those that come with another package.
SKIP_PLAN = {n for n in entry.queries() if n not in registry() or n.startswith("stream_") or n in {
    "frozen_median_from_batch", "job_batch_all", "page_deep",
    "csv_bronze_roundtrip", "publish_messages", "scan_silver", "gold_table_counts", "warehouse_load",
    "train_forest", "model_metrics", "model_roundtrip", "score_batch", "score_if_missing",
    "prediction_summary", "prediction_sample", "onehot_unknown"}}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SKIP_PLAN))
def test_no_python_in_plans(spark, name):
    text = plan_text(entry.queries()[name](spark, SF_SMALL))
    assert not any(node in text for node in PY_NODES), name
    assert "CartesianProduct" not in text, name


def test_library_never_collects():
    banned = re.compile(r"\.collect\(\)|\.toPandas\(\)|\.rdd\b|localCheckpoint|crossJoin|@udf|F\.udf\(")
    offenders = []
    for dirpath, folders, files in os.walk(PKG):
        folders[:] = [d for d in folders if d != "llm"]  # its driver reads are listed, with their bounds, in its own tests
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(dirpath, f)).read()
                if banned.search(text):
                    offenders.append(f)
    assert offenders == []


def test_unread_median_is_pruned(spark):
    lazy = layers.silver_lazy(spark, SF_SMALL)
    assert "percentile" not in plan_text(dash.chart(lazy, "sales_by_item_type"))
    assert "percentile" in plan_text(lazy.select("item_weight"))
