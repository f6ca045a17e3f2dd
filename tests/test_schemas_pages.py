"""Schema versions as one table, and pages by rank index."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators.schemas import append_all, reconciled
from shelfwise.plans import layers
from shelfwise.session import scratch_path
from shelfwise.sources.pages import page_at, write_pages


def test_missing_extra_and_widened_columns(spark):
    one = spark.createDataFrame([(1, 2, dt.date(2024, 1, 2), "a")], "id int, n short, day date, `odd name` string")
    two = spark.createDataFrame([(2**40, 0.5, dt.datetime(2024, 1, 2, 3), 7)], "id long, n float, day timestamp, extra int")
    three = spark.createDataFrame([("x", None)], "id string, extra void")
    both = append_all([one, two])
    assert both.dtypes == [("id", "bigint"), ("n", "double"), ("day", "timestamp"), ("odd name", "string"), ("extra", "int")]
    rows = sorted(map(tuple, both.collect()))
    assert rows == [(1, 2.0, dt.datetime(2024, 1, 2), "a", None), (2**40, 0.5, dt.datetime(2024, 1, 2, 3), None, 7)]
    every = append_all([one, two, three])
    assert dict(every.dtypes)["id"] == "string" and dict(every.dtypes)["extra"] == "int"
    assert sorted(r.id for r in every.collect()) == ["1", str(2**40), "x"]
    assert reconciled([one.schema]) == append_all([one]).schema


def test_pages_open_only_their_ranges(spark):
    rows = layers.bronze(spark, SF_SMALL).select("record_id", "Rating")
    path = scratch_path(spark, "pages-test")
    write_pages(rows, path, range_rows=500)
    ordered = [r.record_id for r in rows.orderBy("record_id").select("record_id").collect()]
    assert spark.read.parquet(f"{path}/index").count() > 5
    for offset, limit in ((0, 10), (3333, 1000), (len(ordered) - 3, 100), (len(ordered) + 5, 10)):
        got = page_at(spark, path, offset, limit)
        assert [r.record_id for r in got.collect()] == ordered[offset: offset + limit]
    deep = page_at(spark, path, 5200, 10)
    opened = deep.select(F.input_file_name().alias("f")).distinct().count()
    assert opened <= 2
    with pytest.raises(ValueError):
        page_at(spark, path, -1)


def test_pages_of_nothing(spark):
    path = scratch_path(spark, "pages-none")
    write_pages(layers.bronze(spark, SF_SMALL).select("record_id", "Rating").limit(1), path)
    assert page_at(spark, path, 1, 5).collect() == []
