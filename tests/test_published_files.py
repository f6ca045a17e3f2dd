"""Files of the message transport, of landed batches and of compacted tables: bounded, compressed, few."""

from pyspark.sql import functions as F

from shelfwise.plans.layers import bronze as feed
from shelfwise.plans.registry import _files_of, _published
from shelfwise.plans.stream import bronze_path, publish_rows, run_landing, run_silver_gold
from shelfwise.sources.messages import read_message_files
from shelfwise.streaming.bronze import to_bronze
from shelfwise.streaming.micro_batches import read_table

SF = "/root/testdata/sf0.001"


def _rows(spark, n=300):
    return feed(spark, SF).limit(n).localCheckpoint()


def test_published_files_are_compressed_and_bounded(spark, tmp_path):
    path = str(tmp_path / "messages")
    publish_rows(_rows(spark).coalesce(1), path, file_records=50)
    files = list((tmp_path / "messages").glob("part-*"))
    assert len(files) == 6 and all(f.name.endswith(".json.gz") for f in files)
    assert read_message_files(spark, path).count() == 300


def test_micro_batches_do_not_follow_the_number_of_files(spark):
    _, path = _published(spark, SF)
    files = len(spark.read.text(path).inputFiles())
    assert files >= 6
    assert [-(-files // _files_of(spark, path, n)) for n in (1, 2, 3)] == [1, 2, 3]


def test_publishing_the_feed_does_not_shuffle_it(spark, monkeypatch):
    from shelfwise.plans import registry

    seen = []
    monkeypatch.setattr(registry, "publish_rows", lambda rows, path, **_: seen.append(rows._jdf.queryExecution().toString()))
    registry._published(spark, SF)
    assert "REPARTITION_BY_NUM" not in seen[0]


def test_deduplicated_batch_lands_as_one_file(spark, tmp_path):
    """A piece for every shuffle partition would each be a file that the next stage's trigger counts."""
    base = str(tmp_path)
    publish_rows(_rows(spark).repartition(3), f"{base}/messages")
    good, _ = run_landing(spark, f"{base}/messages", base, dedup=True)
    assert len(list((tmp_path / "bronze_stream").glob("batch-*/part-*"))) == 1
    assert spark.read.option("recursiveFileLookup", True).parquet(good).count() == 300
    layout = run_silver_gold(spark, base, compact_every=1)
    compacted = layout.versions(spark).current().tables["silver"]
    assert len(spark.read.parquet(compacted).inputFiles()) == 1
    assert read_table(spark, layout, "silver").count() == 300
    assert bronze_path(base) == good


def test_stream_key_is_sixteen_bytes(spark, tmp_path):
    publish_rows(_rows(spark), str(tmp_path / "m"))
    kept = to_bronze(spark.readStream.schema("key string, value string").json(str(tmp_path / "m")), dedup_keys=("record_id",), combine_copies=False)
    assert "hex" in kept._jdf.queryExecution().logical().toString()
    from shelfwise.streaming.bronze import _digest

    sizes = _rows(spark).select(F.length(_digest("key", F.col("record_id"))).alias("n")).distinct().collect()
    assert [r["n"] for r in sizes] == [16]


def test_csv_feed_is_compressed(spark):
    from shelfwise.plans.registry import q_feed_without_id_dashboard
    from shelfwise.session import ensure_checkpoint_dir

    q_feed_without_id_dashboard(spark, SF)
    written = spark.read.text(f"{ensure_checkpoint_dir(spark)}/shelfwise/feed-without-id-*/csv").inputFiles()
    assert written and all(f.endswith(".csv.gz") for f in written)
