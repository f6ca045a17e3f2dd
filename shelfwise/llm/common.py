"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import shelfwise
from shelfwise.session import dropping_shuffles, scratch_path

#: A membership bitmap has 2**BITMAP_WORDS_LOG2 words of 64 bits (8 MB), whatever the input.
BITMAP_WORDS_LOG2 = 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(shelfwise.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="shelfwise-"), "shelfwise.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_arrow(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    """``mapInArrow`` with this package importable on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(work, schema)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage, so a lost executor re-reads files that every executor sees. The shuffle files of the write go at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with dropping_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(doc_id: Column, text: Column) -> Column:
    """64-bit key of a row. Rows equal in both columns share it and count as one document."""
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


def membership_bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Fixed-size bitmap of a long column: a bit is set if some key maps to it.

    At most 2**BITMAP_WORDS_LOG2 rows reach the driver for any input. A test has
    no false negatives; false positives are for an exact join to remove.
    """
    key = F.col(column)
    word = F.shiftright(key, 6).bitwiseAND(F.lit((1 << BITMAP_WORDS_LOG2) - 1))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.select(word.alias("w"), mask.alias("m")).groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    bitmap = np.zeros(1 << BITMAP_WORDS_LOG2, dtype=np.int64)
    bitmap[words["w"].to_numpy()] = words["m"].to_numpy()
    return bitmap


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Boolean mask of the int64 ``keys`` whose bit is set."""
    words = bitmap[(keys >> np.int64(6)) & np.int64((1 << BITMAP_WORDS_LOG2) - 1)]
    return ((words.view(np.uint64) >> (keys & np.int64(63)).astype(np.uint64)) & np.uint64(1)).astype(bool)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list: (node, component).

    Every node takes the smallest node of its component. Each round hooks every
    node to its smallest neighbour, halves the paths twice and contracts the
    edges, so the rounds grow with the logarithm of a component's diameter.
    Labels are written tables and joins meet plain scans, so Spark can split a
    hub that many edges share. Nodes without an edge are not returned.
    """
    pairs = (
        edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .where("a <> b")
        .distinct()
    )
    current = materialise(pairs, "cc-edges")
    labels: DataFrame | None = None
    while not current.isEmpty():
        parent = materialise(
            current.select(F.col("b").alias("node"), F.col("a").alias("up"))
            .unionAll(current.select(F.col("a").alias("node"), F.col("a").alias("up")))
            .groupBy("node")
            .agg(F.min("up").alias("up")),
            "cc-parent",
        )
        for _ in range(2):
            up = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            parent = materialise(
                parent.join(up, "up").select("node", F.col("top").alias("up")), "cc-parent"
            )
        if labels is None:
            labels = parent.select("node", F.col("up").alias("component"))
        else:
            moved = parent.select(F.col("node").alias("component"), "up")
            labels = materialise(
                labels.join(moved, "component", "left").select(
                    "node", F.coalesce("up", "component").alias("component")
                ),
                "cc-labels",
            )
        ends_a = parent.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        ends_b = parent.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        current = materialise(
            current.join(ends_a, "a")
            .join(ends_b, "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            "cc-edges",
        )
    if labels is None:
        return pairs.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return labels
