"""De-duplication of a stream by key, without a horizon or with a time to live.

Without one, a key is remembered for as long as the checkpoint lives: Spark's
``dropDuplicates`` on a stream without watermark. With ``ttl`` a key is
forgotten once it has not been seen for that long: its state is the time of its last
copy, and a timer drops it. Both keep their state in RocksDB, on
the executors' disks and in the checkpoint, so keys need not fit memory.
A checkpoint belongs to one of the two forms.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfwise.session import dropping_shuffles, settings

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
_UNITS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000}


@contextmanager
def state_settings(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, run no batches without data and drop a batch's shuffle files at its end.

    (Keys with a time to live would call for such batches for ever, so that no stream could drain.)
    """
    with settings(spark, {_PROVIDER: ROCKSDB, _NO_DATA: "false"}), dropping_shuffles(spark):
        yield


def milliseconds(span: str) -> int:
    """'10 minutes' as 600000."""
    found = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", span.lower())
    if not found or found[2] not in _UNITS or int(found[1]) == 0:
        raise ValueError(f"not a time span: {span!r}")
    return int(found[1]) * _UNITS[found[2]]


def _unless_seen(ttl_ms: int):
    """Passes a key's first row if its last copy came ``ttl_ms`` ago or more, or never; any row renews that time."""

    def work(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now, first = state.getCurrentProcessingTimeMs(), None
        known = state.exists and now - state.get[0] < ttl_ms
        for frame in rows:  # all must be read
            if first is None and len(frame):
                first = frame.iloc[:1]
        state.update((now,))
        state.setTimeoutDuration(ttl_ms)
        if not known and first is not None:
            yield first

    return work


def first_copies(stream: DataFrame, key: str, ttl: str | None = None) -> DataFrame:
    """The first row of every ``key`` that the checkpoint has ever seen or, with ``ttl``, that it has not seen for that long."""
    if ttl is None:
        return stream.dropDuplicates([key])
    return stream.groupBy(key).applyInPandasWithState(
        _unless_seen(milliseconds(ttl)), stream.schema, "seen_ms long", "append", GroupStateTimeout.ProcessingTimeTimeout
    )
