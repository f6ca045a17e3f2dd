"""Deep pages: a layer in key order with a rank index.

The layer is written in key ranges, one folder each, with an index of the rows
in every range (as many rows as ranges). A page at any offset is found in the
index, and only the ranges that hold it are opened; no rows before it are sorted or read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.schemas import RECORD_ID
from shelfwise.sources.files import clamp_page

RANGE_ROWS = 50_000


def write_pages(frame: DataFrame, path: str, order_by: str = RECORD_ID, range_rows: int = RANGE_ROWS) -> None:
    """Write ``frame`` under ``path`` in ranges of about ``range_rows`` rows, and the index of their sizes."""
    spark = frame.sparkSession
    ranges = max(1, -(-frame.count() // range_rows))
    placed = frame.repartitionByRange(ranges, order_by).withColumn("range_", F.spark_partition_id())
    placed.write.partitionBy("range_").parquet(f"{path}/rows")
    written = spark.read.parquet(f"{path}/rows")
    written.groupBy("range_").agg(F.count(F.lit(1)).alias("rows")).coalesce(1).write.parquet(f"{path}/index")


def page_at(spark: SparkSession, path: str, offset: int, limit: int = 100, order_by: str = RECORD_ID) -> DataFrame:
    """Rows ``[offset, offset + limit)`` by ``order_by`` of a layer that ``write_pages`` wrote."""
    if offset < 0:
        raise ValueError("offset must be ≥ 0")
    limit = clamp_page(limit)
    earlier = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    index = spark.read.parquet(f"{path}/index").withColumn("start", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    held = index.where((F.col("start") < offset + limit) & (F.col("start") + F.col("rows") > offset))
    # A page is in few ranges: their numbers and the first one's start.
    found = held.agg(F.collect_list("range_").alias("ranges"), F.min("start").alias("start")).first()
    rows = spark.read.parquet(f"{path}/rows").where(F.col("range_").isin(found["ranges"]) if found["ranges"] else F.lit(False))
    return rows.drop("range_").orderBy(order_by).offset(int(offset - (found["start"] or 0)) if found["ranges"] else 0).limit(limit)
