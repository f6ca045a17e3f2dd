"""Session construction and shared scratch space.

On a cluster the scratch space is the shared folder named by
``spark.checkpoint.dir``; only a local (test) session without that
setting gets a fresh folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app_name: str = "shelfwise",
                  shuffle_partitions: int | None = None,
                  max_partition_bytes: str | None = None) -> SparkSession:
    """Session with the settings this library is written for.

    Local runs (tests, bench) get ``shuffle_partitions`` (default 8) and
    a bounded driver heap. On a cluster the partition sizing is left to
    the cluster config unless given: AQE coalesces post-shuffle
    partitions to ``advisoryPartitionSizeInBytes`` and splits skewed
    ones, so a generous initial partition count is safe. ANSI mode stays
    on (Spark 4 default); raw input is cast with ``try_cast``.
    """
    master = master or os.environ.get("SHELFWISE_MASTER") or \
        f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    local = master.startswith("local")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if local or shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    if max_partition_bytes:
        builder = builder.config("spark.sql.files.maxPartitionBytes", max_partition_bytes)
    if local:
        builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating one only for local runs."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor shares"
        )
    local = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings that hold inside; a stream keeps those that it was started with."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def dropping_shuffles(spark: SparkSession):
    """Writes inside drop their shuffle files at their end.

    These would else stay until the driver collects garbage; at size, every read of the feed leaves the whole feed in them.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/shelfwise/{name}-{uuid.uuid4().hex[:12]}"
