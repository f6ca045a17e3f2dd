"""Equivalent plans must give equal results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import dashboard as dash
from shelfwise.operators import star
from shelfwise.plans import layers
from shelfwise.session import scratch_path
from shelfwise.sources.files import page, page_after, read_csv


def _same(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rollup_equals_six_charts(spark):
    silver = layers.silver(spark, SF_SMALL)
    parts = []
    for name, key, with_mean, _ in dash.CHARTS:
        c = dash.chart(silver, name)
        parts.append(c.select(
            F.lit(name).alias("chart"), F.col(key).cast("string").alias("key"), "total_sales",
            (F.col("avg_sales") if with_mean else F.lit(None).cast("double")).alias("avg_sales"),
            "count"))
    six = reduce(DataFrame.unionByName, parts)
    assert _same(dash.chart_rollup(silver), six)


def test_inline_fact_equals_join_fact(spark):
    g = layers.gold_silver(spark, SF_SMALL)
    assert _same(star.fact_sales(g, mode="inline"), star.fact_sales(g, mode="join"))


def test_keyset_pages_concatenate_to_full_order(spark):
    rows = layers.bronze(spark, SF_SMALL).select("record_id")
    full = [r.record_id for r in rows.orderBy("record_id").collect()]
    got, last = [], None
    while True:
        chunk = [r.record_id for r in page_after(rows, last, limit=1000).collect()]
        if not chunk:
            break
        got.extend(chunk)
        last = chunk[-1]
    assert got == full
    offset_pages = []
    for off in range(0, len(full), 1000):
        offset_pages.extend(r.record_id for r in page(rows, off, 1000).collect())
    assert offset_pages == full


def test_csv_malformed_numbers_become_null(spark):
    path = scratch_path(spark, "bad-csv")
    header = ",".join(f'"{c}"' for c in (
        "Item Fat Content", "Item Identifier", "Item Type", "Outlet Establishment Year",
        "Outlet Identifier", "Outlet Location Type", "Outlet Size", "Outlet Type",
        "Item Visibility", "Item Weight", "Total Sales", "Rating"))
    lines = [header, "LF,A,Dairy,1999,O1,Tier 1,Small,Grocery Store,0.1,,12.5,3.0",
             "reg,B,Dairy,nineteen,O1,Tier 1,Small,Grocery Store,abc,9.3,7.0,1.0"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    got = {r["Item Identifier"]: r for r in read_csv(spark, path).collect()}
    assert got["A"]["Item Weight"] is None and got["A"]["Total Sales"] == 12.5
    assert got["B"]["Outlet Establishment Year"] is None and got["B"]["Item Visibility"] is None


def test_shared_grain_dashboard_equals_per_panel(spark):
    import pytest

    from shelfwise.plans.dashboard import dashboard

    silver = layers.silver_lazy(spark, SF_SMALL)
    filters = {"outlet_size": ["Small", "High"], "sales_min": 1000.0}
    shared = dashboard(silver, **filters)
    single = dashboard(silver, share_grain=False, **filters)
    assert set(shared) - {"grain"} == set(single)
    for name in single:
        if name == "metrics":
            a, b = shared[name].first(), single[name].first()
            assert a.total_records == b.total_records
            for c in ("avg_sales", "total_sales", "avg_rating"):
                assert a[c] == pytest.approx(b[c], rel=1e-12)
            continue
        assert _same(shared[name], single[name]), name
    shared["grain"].unpersist()
