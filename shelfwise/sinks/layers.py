"""Parquet sinks for the medallion layers.

Each batch run writes a new version folder and readers open it; a run
never overwrites the folder it is reading from. Gold tables are written
from one persisted silver read-back so silver is not recomputed per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Writer options of all tables. Parquet decides by a column's first page whether a dictionary pays, and gives one up that
#: outgrows its size: with the usual 20,000 rows and 1 MB, surrogate keys (64 characters) are stored in full in every row.
TABLE_OPTIONS = {"compression": "zstd", "parquet.page.size": str(8 << 20), "parquet.page.row.count.limit": "200000",
                 "parquet.dictionary.page.size": str(16 << 20)}


def write_parquet(frame: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: tuple[str, ...] = ()) -> None:
    writer = frame.write.mode(mode).options(**TABLE_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    frame.write.mode(mode).option("header", True).csv(path)


def write_gold(gold: dict[str, DataFrame], base: str, mode: str = "overwrite",
               concurrent: bool = True) -> dict[str, str]:
    """Write every gold table under ``base/<name>``; returns the paths.

    The tables are independent, so their write jobs are submitted
    together (one driver thread each; Spark runs the jobs side by side),
    which keeps the cluster busy while the small dimension writes run.
    """
    from concurrent.futures import ThreadPoolExecutor

    paths = {name: f"{base.rstrip('/')}/{name}" for name in gold}
    if not concurrent:
        for name, frame in gold.items():
            write_parquet(frame, paths[name], mode)
        return paths
    with ThreadPoolExecutor(max_workers=len(gold) or 1) as pool:
        futures = [pool.submit(write_parquet, frame, paths[name], mode) for name, frame in gold.items()]
        for f in futures:
            f.result()
    return paths


def read_gold(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(p) for name, p in paths.items()}


def compact(spark: SparkSession, path: str, out_path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Rewrite a table of many small files (e.g. one set per micro-batch)
    into a new version folder of right-sized files.

    The ``rebalance`` hint lets AQE cut the data into partitions of
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``; with
    ``partition_by`` rows are clustered by those columns first, so each
    output partition folder gets few, full files. The source is not
    touched; readers switch to ``out_path`` when it is complete.
    """
    frame = spark.read.parquet(path)
    frame = frame.hint("rebalance", *partition_by) if partition_by else frame.hint("rebalance")
    write_parquet(frame, out_path, "overwrite", partition_by)
    return out_path
