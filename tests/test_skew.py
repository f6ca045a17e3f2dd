"""A hot key holding a third of all rows: results stay whole and exact.

The skewed frame is derived from the bundled tables (every third row is
re-labelled as one item and one outlet) and compared with DuckDB on the
same rows.
"""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from shelfwise.operators import dashboard as dash
from shelfwise.operators import star
from shelfwise.operators.clean import with_event_date
from shelfwise.operators.quantiles import exact_median
from shelfwise.plans import layers
from shelfwise.session import scratch_path


@pytest.fixture(scope="module")
def skewed(spark):
    s = layers.silver(spark, SF_ORACLE)
    hot = F.pmod(F.xxhash64("record_id"), F.lit(3)) == 0
    s = (s.withColumn("item_identifier", F.when(hot, F.lit("P-HOT")).otherwise(F.col("item_identifier")))
         .withColumn("item_type", F.when(hot, F.lit("HOT")).otherwise(F.col("item_type")))
         .withColumn("item_fat_content", F.when(hot, F.lit("Low Fat")).otherwise(F.col("item_fat_content")))
         .withColumn("outlet_identifier", F.when(hot, F.lit("HOT-OUTLET")).otherwise(F.col("outlet_identifier")))
         .withColumn("total_sales", F.when(hot, F.lit(123.45)).otherwise(F.col("total_sales"))))
    path = scratch_path(spark, "skewed")
    s.write.parquet(path)
    return spark.read.parquet(path), path.replace("file:", "")


def duck(path: str, sql: str):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW s AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return con.sql(sql).fetchall()


def test_hot_key_is_a_third(skewed):
    frame, _ = skewed
    n = frame.count()
    hot = frame.where(F.col("item_identifier") == "P-HOT").count()
    assert abs(hot / n - 1 / 3) < 0.02


def test_top_products_under_skew(skewed):
    frame, path = skewed
    got = [(r.item_identifier, r.total_sales) for r in dash.top_products(frame).collect()]
    want = duck(path, "SELECT item_identifier, round_even(sum(total_sales), 2) FROM s "
                      "GROUP BY item_identifier, item_type ORDER BY sum(total_sales) DESC, 1 LIMIT 10")
    assert got == [(a, b) for a, b in want]


def test_dims_and_join_fact_under_skew(skewed):
    frame, path = skewed
    g = with_event_date(frame)
    dim = star.dim_item(g)
    assert dim.count() == duck(path, "SELECT count(*) FROM (SELECT DISTINCT item_identifier, "
                                     "item_type, item_fat_content FROM s)")[0][0]
    joined = star.fact_sales(g, mode="join")
    inline = star.fact_sales(g, mode="inline")
    assert joined.exceptAll(inline).count() == 0 and inline.exceptAll(joined).count() == 0


def test_rollup_and_median_under_skew(skewed):
    frame, path = skewed
    got = {r.key: r["count"] for r in dash.chart_rollup(frame).where(F.col("chart") == "sales_by_item_type").collect()}
    want = dict(duck(path, "SELECT item_type, count(total_sales) FROM s GROUP BY 1"))
    assert got == want
    want_median = duck(path, "SELECT median(total_sales)::DOUBLE FROM s")[0][0]
    assert exact_median(frame, "total_sales") == pytest.approx(
        want_median, rel=0, abs=1e-9)
