"""Batch sources: CSV feed, Parquet layers, paging and point lookup."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import col, row_identity
from shelfwise.schemas import RAW_SCHEMA, RECORD_ID

PAGE_MIN, PAGE_MAX = 1, 1000


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA,
             stamp: bool = True) -> DataFrame:
    """CSV with a header; columns go by their header names, in any order.

    Only the header is read ahead. Columns of ``schema`` take its types and
    malformed values become null; absent ones are null; others pass through
    as text. All files of a folder share one header, as Spark's reader has
    it. ``stamp`` adds ``ingest_ts`` = the query's processing time.
    """
    text = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    given = {c.strip(): c for c in text.columns}
    typed = [
        (col(given[f.name]) if f.name in given else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    others = [col(raw).alias(name) for name, raw in given.items() if name not in schema.names]
    frame = text.select(*typed, *others)
    return stamp_ingest(frame) if stamp else frame


def with_record_id(frame: DataFrame, column: str = RECORD_ID, fill: bool = False) -> DataFrame:
    """``frame`` with a record id; where the column is absent, rows take their content's hash.

    The hash covers the raw columns, so a record that is sent again gets the same
    id, and records that are equal in every field share one. With ``fill``, null
    ids of an existing column are filled too (which reads all raw columns).
    """
    if column in frame.columns and not fill:
        return frame
    names = [f.name for f in RAW_SCHEMA.fields if f.name in frame.columns]
    names = names or [c for c in frame.columns if c not in (column, "ingest_ts")]
    own = row_identity(names)
    return frame.withColumn(column, F.coalesce(F.col(column), own) if column in frame.columns else own)


def stamp_ingest(frame: DataFrame, column: str = "ingest_ts") -> DataFrame:
    """Processing-time stamp, unless the rows already carry one."""
    if column in frame.columns:
        return frame.withColumn(column, F.coalesce(F.col(column), F.current_timestamp()))
    return frame.withColumn(column, F.current_timestamp())


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds files at ``path``; failures other than "no such path" are raised."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def clamp_page(limit: int) -> int:
    return max(min(int(limit), PAGE_MAX), PAGE_MIN)


def page(frame: DataFrame, offset: int = 0, limit: int = 100,
         order_by: str | list[str] = RECORD_ID) -> DataFrame:
    """Rows ``[offset, offset + limit)`` in a stable order.

    A global sort with offset; fine for the first pages. For deep paging
    over large tables use :func:`page_after` (keyset), which reads only
    rows after the last key seen and needs no global offset.
    """
    if offset < 0:
        raise ValueError("offset must be ≥ 0")
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return frame.orderBy(*keys).offset(int(offset)).limit(clamp_page(limit))


def page_after(frame: DataFrame, last_key: str | None, limit: int = 100,
               order_by: str = RECORD_ID) -> DataFrame:
    """Keyset page: the next ``limit`` rows with ``order_by > last_key``.

    The predicate reaches the Parquet scan; ``orderBy().limit()`` plans a
    per-task top-k, so no task sorts the whole table.
    """
    rows = frame if last_key is None else frame.where(F.col(order_by) > F.lit(last_key))
    return rows.orderBy(order_by).limit(clamp_page(limit))


def fill_empty(frame: DataFrame) -> DataFrame:
    """Null → "" for every column, as the source API serves rows (all text)."""
    return frame.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c)
                          for c in frame.columns])


def lookup(frame: DataFrame, item_identifier: str, column: str = "Item Identifier") -> DataFrame:
    """Rows of one item plus ``match_count`` (a scalar subquery, computed once)."""
    key: Column = F.col(f"`{column}`").cast("string") == F.lit(item_identifier)
    matches = frame.where(key)
    return matches.withColumn("match_count", matches.select(F.count(F.lit(1))).scalar())
