"""Queries that read the feed several times read it as written once, and small written dimensions are broadcast."""

from __future__ import annotations

import datetime

import pytest

from shelfwise.operators import star
from shelfwise.operators.clean import with_event_date
from shelfwise.plans import registry
from shelfwise.session import scratch_path
from shelfwise.sinks.warehouse import TableWarehouse, load_warehouse

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Tables of 40 sales: 7 parts, 3 suppliers, one nation."""
    folder = str(tmp_path_factory.mktemp("feed"))
    day = datetime.datetime(2020, 1, 1)
    spark.createDataFrame(
        [(i, i % 7, i % 3, i % 4, float(i % 50 + 1), 10.0 * i, 0.01 * (i % 9), day + datetime.timedelta(days=i % 5)) for i in range(40)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i, f"TYPE {i % 2}") for i in range(7)], "p_partkey long, p_type string").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(i, f"S{i}", 1) for i in range(3)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(1, 2)], "n_nationkey int, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    return folder


@pytest.fixture
def no_automatic_broadcast(spark):
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    yield
    spark.conf.set(THRESHOLD, before)


def _plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def _physical(frame) -> str:
    return frame._jdf.queryExecution().sparkPlan().toString()


def _rows(frame):
    return sorted(map(str, frame.collect()))


def test_join_mode_fact_shuffles_nothing_for_small_dimensions(spark, feed, no_automatic_broadcast):
    fact = registry.q_fact_via_join(spark, feed)
    assert "l_partkey" not in _plan(fact)  # the feed's joins are behind the written rows
    assert _physical(fact).count("BroadcastHashJoin") == 3
    assert _rows(fact) == _rows(registry.q_fact_sales(spark, feed))
    assert fact.columns == registry.q_fact_sales(spark, feed).columns


def test_a_null_natural_key_joins_no_dimension_row(spark, feed):
    silver = registry.layers.silver_lazy(spark, feed)
    silver = silver.withColumn("item_type", registry.F.when(silver.item_type == "TYPE 1", silver.item_type))
    written = star.fact_of_written_dims(silver, scratch_path(spark, "null-keys"))
    assert _rows(written) == _rows(star.fact_sales(with_event_date(silver), mode="join"))
    assert written.where("item_key is null").count() > 0


def test_warehouse_joins_broadcast_small_dimensions(spark, feed, no_automatic_broadcast):
    gold = registry._gold(spark, feed)
    assert all("l_partkey" not in _plan(gold[t]) for t in gold)
    warehouse = TableWarehouse(scratch_path(spark, "views"))
    load_warehouse(gold, warehouse)
    names = warehouse.register_views(spark, "small_")
    assert len(names) == 4 and spark.table("small_fact_sales").count() == 40
    asked = spark.sql(registry.WAREHOUSE_SQL.format(p="small_"))
    assert _physical(asked).count("BroadcastHashJoin") == 3
    assert sum(r["sales_rows"] for r in asked.collect()) == 40
