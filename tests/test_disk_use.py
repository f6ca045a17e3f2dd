"""What the layers and streams keep on disk: dictionaries for surrogate keys, no shuffle files, no consumed messages."""

from __future__ import annotations

import glob
import time

import pyarrow as pa
import pyarrow.parquet as pq

from conftest import SF_SMALL
from shelfwise.plans import registry
from shelfwise.plans.stream import publish_rows
from shelfwise.session import dropping_shuffles, scratch_path
from shelfwise.sinks.layers import write_parquet
from shelfwise.sinks.versions import drop_folder, exists
from shelfwise.sources.messages import encode
from shelfwise.streaming import bronze as bronze_module
from shelfwise.streaming.bronze import to_bronze
from test_stream_copies import _shuffle_files

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _local(path: str) -> str:
    return path.removeprefix("file:")


def test_surrogate_keys_keep_their_dictionary(spark):
    path = scratch_path(spark, "keys")
    # 20,000 keys of 64 characters come five times each, far apart: 1.3 MB of them.
    write_parquet(spark.range(0, 100_000, 1, 1).selectExpr("sha2(string(id % 20000), 256) as item_key"), path)
    (file,) = glob.glob(f"{_local(path)}/*.parquet")
    column = pq.ParquetFile(file).metadata.row_group(0).column(0)
    assert "PLAIN" not in column.encodings
    assert column.total_compressed_size < 100_000 * 64 / 4


def test_publishing_leaves_no_shuffle_files(spark):
    rows = spark.range(3000).selectExpr("concat('r', id) as record_id", "concat('P', id) as `Item Identifier`").repartition(3, "record_id")
    before, held = _shuffle_files(spark), spark.conf.get(SETTING, None)
    publish_rows(rows, scratch_path(spark, "messages"))
    for _ in range(100):  # they go in the background
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before
    assert spark.conf.get(SETTING, None) == held


def test_settings_are_restored_after_an_error(spark):
    held = spark.conf.get(SETTING, None)
    try:
        with dropping_shuffles(spark):
            assert spark.conf.get(SETTING) == "true"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(SETTING, None) == held


def test_landed_messages_go(spark):
    base, messages = registry._published(spark, SF_SMALL)
    layout = registry._streamed(spark, messages, base, 2)
    assert not exists(spark, messages)
    assert spark.read.parquet(layout.silver).count() == registry._bronze_rows(spark, SF_SMALL).count()


def test_only_rejected_messages_are_carried_along(spark):
    rows = registry._bronze_rows(spark, SF_SMALL).limit(20)
    sent = encode(rows, extra=("record_id",)).unionByName(spark.createDataFrame([("k", "no json")], "key string, value string"))
    landed = to_bronze(sent, dedup_keys=("record_id",), keep_message=True).collect()
    assert len(landed) == 21
    assert [(r["_message_key"], r["_message"]) for r in landed if r["_rejected"]] == [("k", "no json")]
    assert {(r["_message_key"], r["_message"]) for r in landed if not r["_rejected"]} == {(None, None)}


def test_queries_that_publish_copies_leave_no_messages(spark, monkeypatch):
    dropped = []
    monkeypatch.setattr(registry, "drop_folder", lambda s, path: dropped.append(path) or drop_folder(s, path))
    assert registry.q_stream_dedup_without_id(spark, SF_SMALL).count() == registry._bronze_rows(spark, SF_SMALL).drop("record_id", "ingest_ts").distinct().count()
    assert len(dropped) == 1 and not exists(spark, dropped[0])


def test_the_combining_pass_forgets_keys_and_loses_none(monkeypatch):
    monkeypatch.setattr(bronze_module, "REMEMBERED", 10)
    keys = [b"%02d" % (k % 30) for k in range(300)]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[k : k + 7])], names=["_dedup_key"]) for k in range(0, 300, 7)]
    passed = [key for b in bronze_module._first_copy_per_partition(iter(batches)) for key in b.column(0).to_pylist()]
    assert set(passed) == set(keys) and len(passed) > 30
