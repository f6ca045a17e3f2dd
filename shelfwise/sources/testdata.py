"""The sales feed derived from the bundled TPC-H-like tables.

The retail feed itself is not shipped, so the raw rows are derived from
``lineitem ⋈ part ⋈ supplier ⋈ nation`` (see FIXTURES.md §2). The
result has the twelve raw columns plus ``ingest_ts`` (the ship date
standing in for the arrival clock) and a ``record_id``.

Scale: ``lineitem`` is the big side. It is joined to ``part``, then
``supplier``, then ``nation``, each a plain scan, so Spark's broadcast
decision for every side rests on that table's own file-size statistics
(``spark.sql.autoBroadcastJoinThreshold``): small tables are broadcast;
``part`` and ``supplier`` at large scale factors become shuffle joins
(AQE may still switch at runtime, and splits skewed partitions).
Pre-joining ``supplier ⋈ nation`` is avoided on purpose: the estimate
of a join's size is the product of its inputs, which would push a
few-thousand-row side over the threshold and shuffle ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.schemas import RECORD_ID



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fat_content(partkey: Column, linenumber: Column) -> Column:
    # Dirty label variants, chosen deterministically from the row.
    even = (
        F.when(linenumber % 4 == 0, F.lit("LF"))
        .when(linenumber % 4 == 1, F.lit("low fat"))
        .when(linenumber % 4 == 2, F.lit(" Low Fat "))
        .otherwise(F.lit("Low Fat"))
    )
    odd = (
        F.when(linenumber % 3 == 0, F.lit("reg"))
        .when(linenumber % 3 == 1, F.lit("Regular"))
        .otherwise(F.lit(" regular"))
    )
    return (
        F.when(partkey % 10 == 9, F.lit("Non Edible"))
        .when(partkey % 2 == 0, even)
        .otherwise(odd)
    )


def _outlet_size(suppkey: Column) -> Column:
    return (
        F.when(suppkey % 3 == 0, F.lit("Small"))
        .when(suppkey % 3 == 1, F.lit("Medium"))
        .otherwise(F.lit("High"))
    )


def _outlet_type(nationkey: Column) -> Column:
    return (
        F.when(nationkey % 4 == 0, F.lit("Grocery Store"))
        .when(nationkey % 4 == 1, F.lit("Supermarket Type1"))
        .when(nationkey % 4 == 2, F.lit("Supermarket Type2"))
        .otherwise(F.lit("Supermarket Type3"))
    )


def sales_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales rows (bronze shape: raw columns + ingest_ts + record_id)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_discount", "l_shipdate",
    )
    # (order, line, part, supplier) repeats in the bundled lineitem; adding
    # the ship date makes the record id unique at every bundled scale.
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    joined = (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(supplier, li.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
    )
    pk, sk, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    return joined.select(
        _fat_content(pk, ln).alias("Item Fat Content"),
        F.concat(F.lit("P"), pk.cast("string")).alias("Item Identifier"),
        F.col("p_type").alias("Item Type"),
        (F.lit(1985) + sk % 25).cast("int").alias("Outlet Establishment Year"),
        F.col("s_name").alias("Outlet Identifier"),
        F.concat(F.lit("Tier "), (F.col("n_regionkey") % 3 + 1).cast("string")).alias(
            "Outlet Location Type"
        ),
        _outlet_size(sk).alias("Outlet Size"),
        _outlet_type(F.col("n_nationkey")).alias("Outlet Type"),
        F.col("l_discount").cast("double").alias("Item Visibility"),
        F.when(F.col("l_orderkey") % 6 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity").cast("double"))
        .alias("Item Weight"),
        F.col("l_extendedprice").cast("double").alias("Total Sales"),
        (F.lit(1.0) + F.lit(0.5) * (ln % 9)).cast("double").alias("Rating"),
        F.col("l_shipdate").cast("timestamp").alias("ingest_ts"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.date_format("l_shipdate", "yyyyMMdd")).alias(RECORD_ID),
    )

