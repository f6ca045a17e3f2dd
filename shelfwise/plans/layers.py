"""Lazily built layers of the test-data feed: bronze → clean → silver → gold.

Every registered query starts here, so its work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.operators.clean import clean_frame, impute_weight, with_event_date
from shelfwise.schemas import FACT_COLUMNS, ITEM_NATURAL_KEY, OUTLET_NATURAL_KEY
from shelfwise.session import dropping_shuffles, scratch_path
from shelfwise.sinks.layers import write_parquet
from shelfwise.sources.testdata import sales_source

# Registered queries compare with an exact-median oracle, so they use the
# distributed exact median; the library default stays ``approx``.
QUERY_MEDIAN_MODE = "exact"


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_source(spark, sf_dir)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_frame(bronze(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str, mode: str = QUERY_MEDIAN_MODE) -> DataFrame:
    return impute_weight(clean(spark, sf_dir), mode=mode)


def silver_lazy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver whose weight median is the lazy approximate scalar subquery.

    For queries that never read ``item_weight``: Catalyst prunes the median
    subquery together with the column, so no pass is spent on it, and
    the result is the one the exact median gives (the weight never
    reaches the output). The exact median, by contrast, is computed
    before planning and cannot be pruned.
    """
    return silver(spark, sf_dir, mode="approx")


def silver_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver columns that the star schema is made of, over rows written once.

    The median, the dimensions and the fact each read the whole feed. At size a read shuffles ``lineitem``
    to ``part`` and ``supplier``, so what is built of several reads makes them from the written rows.
    """
    path = scratch_path(spark, "clean")
    columns = dict.fromkeys((*ITEM_NATURAL_KEY, *OUTLET_NATURAL_KEY, *FACT_COLUMNS[3:], "ingest_ts"))
    with dropping_shuffles(spark):
        write_parquet(clean(spark, sf_dir).select(*columns), path)
    return impute_weight(spark.read.parquet(path), mode=QUERY_MEDIAN_MODE)


def gold_silver(spark: SparkSession, sf_dir: str, lazy: bool = False) -> DataFrame:
    return with_event_date(silver_lazy(spark, sf_dir) if lazy else silver(spark, sf_dir))
