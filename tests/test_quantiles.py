"""Exact median by radix selection vs DuckDB's median, and the mergeable sketch."""

from __future__ import annotations

import random
import struct

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from shelfwise.operators import quantiles
from shelfwise.operators.quantiles import exact_median, from_ordered_bits, median_sketch, merged_median, with_ordered_bits


@pytest.mark.parametrize("table,column", [
    ("events", "value"), ("lineitem", "l_extendedprice"), ("lineitem", "l_quantity"),
    ("orders", "o_totalprice"),
])
def test_exact_median_matches_duckdb(spark, table, column):
    path = f"{SF_ORACLE}/{table}.parquet"
    want = duckdb.sql(f"SELECT median({column})::DOUBLE FROM read_parquet('{path}')").fetchall()[0][0]
    assert exact_median(spark.read.parquet(path), column) == want


def values_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double").repartition(3)


EDGES = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, 0.1, 3.0,
         float("inf"), float("-inf"), 2.0**52 - 0.5, 2.0**53 + 2, 1e-300, 1e300, 0.9999999999999999, 1.0000000000000002, 1023.9999999999999]


def test_bits_order_as_the_values_do(spark):
    r = random.Random(3)
    values = EDGES + [struct.unpack("<d", r.randbytes(8))[0] for _ in range(3000)]
    values = [v for v in values if v == v]
    rows = values_of(spark, values).transform(with_ordered_bits, "v", "b").collect()
    for row in rows:
        own = struct.unpack("<q", struct.pack("<d", abs(row.v)))[0]
        assert row.b == (-own if row.v < 0 else own), row
        assert from_ordered_bits(row.b) == row.v


@pytest.mark.parametrize("values", [
    EDGES[:11], [7.0], [1.0, 2.0], [3.0] * 50, [1.0] * 40 + [2.0] * 40, [-5.0, -5.0, 8.0, 8.0], [1e-310, 2e-310, -1e-310],
    [1.0] * 30 + [1.0000000000000002] * 30, [5.0] * 99 + [6.0],
])
def test_ties_at_both_ends_and_odd_values(spark, values):
    ordered = sorted(values)
    n = len(values)
    lo, hi = ordered[(n - 1) // 2], ordered[n // 2]
    frame = values_of(spark, [*values, None, float("nan")])
    assert exact_median(frame, "v") == lo + (hi - lo) * 0.5


def test_the_number_of_passes_is_fixed(spark, monkeypatch):
    passes = []
    run = quantiles._pass
    monkeypatch.setattr(quantiles, "_pass", lambda *a: passes.append(a[1]) or run(*a))
    r = random.Random(1)
    for values in ([2.0] * 500, [r.random() for _ in range(5000)], [r.gauss(0, 1e9) for _ in range(500)]):
        passes.clear()
        exact_median(values_of(spark, values), "v")
        assert passes == [48, 32, 16, 0] and len(passes) == quantiles.PASSES


def test_exact_median_hot_value(spark):
    frame = spark.range(0, 30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("v"))
    values = sorted(r.v for r in frame.collect())
    n = len(values)
    want = values[(n - 1) // 2] + (values[n // 2] - values[(n - 1) // 2]) * 0.5
    assert exact_median(frame, "v") == want


def test_exact_median_empty_and_all_null(spark):
    empty = spark.range(0).select(F.col("id").cast("double").alias("v"))
    assert exact_median(empty, "v") is None
    nulls = spark.range(3).select(F.lit(None).cast("double").alias("v"))
    assert exact_median(nulls, "v") is None


def test_merged_sketches_come_near_the_median(spark):
    frame = spark.range(0, 90_000).select(((F.col("id") * 7919) % 90_000).cast("double").alias("v"))
    part = F.pmod(F.xxhash64("v"), F.lit(3))
    sketches = [median_sketch(frame.where(part == k), "v") for k in range(3)]
    sketches.append(median_sketch(frame.limit(0), "v"))
    whole = sketches[0].unionByName(sketches[1]).unionByName(sketches[2]).unionByName(sketches[3])
    found = merged_median(whole).first()
    assert found.n == 90_000 and abs(found.median / 90_000 - 0.5) < 0.01


def test_no_sketch_no_median(spark):
    none = median_sketch(spark.range(3).select(F.lit(None).cast("double").alias("v")), "v")
    assert merged_median(none).first().median is None
