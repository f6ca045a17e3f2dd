"""Versioned layers: one step to publish, readers undisturbed, failed builds invisible."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.plans import layers
from shelfwise.plans.batch import run_all, run_batch
from shelfwise.operators.model import load_metrics, load_model
from shelfwise.session import scratch_path
from shelfwise.sinks import versions as V
from shelfwise.sinks.versions import VersionConflict, VersionedLayers
from shelfwise.sinks.warehouse import TableWarehouse


def test_a_reader_opened_before_a_rebuild_finishes_on_its_version(spark):
    base = scratch_path(spark, "lake")
    feed = layers.bronze(spark, SF_SMALL)
    one = run_batch(spark, feed, base)
    old = VersionedLayers(spark, base).open()
    n = feed.count()
    two = run_batch(spark, feed.where(F.col("`Outlet Size`") == "Small"), base)
    new = VersionedLayers(spark, base).open()
    assert (one.version, two.version) == (1, 2)
    assert old["fact_sales"].count() == old["silver"].count() == n
    assert new["fact_sales"].count() == new["silver"].count() < n
    assert set(new) == {"bronze", "silver", "gold_silver", "dim_item", "dim_outlet", "dim_date", "fact_sales", "weight_sketch"}


def test_a_failed_build_changes_nothing(spark):
    base = scratch_path(spark, "lake-failed")
    feed = layers.bronze(spark, SF_SMALL)
    run_batch(spark, feed, base)
    boom = F.when(F.col("Rating") > 4.0, F.raise_error(F.lit("broken source"))).otherwise(F.col("`Item Type`"))
    with pytest.raises(Exception, match="broken source"):
        run_batch(spark, feed.withColumn("Item Type", boom), base)
    store = VersionedLayers(spark, base)
    assert store.current().version == 1
    assert store.open()["silver"].count() == feed.count()
    gone = store.expire(keep=1)
    assert len(gone) == 1  # the failed build's folder
    assert store.open()["dim_item"].count() > 0


def test_a_half_written_manifest_is_passed_over_and_conflicts_are_told(spark):
    store = VersionedLayers(spark, scratch_path(spark, "manifests"))
    assert store.current() is None and store.open() == {}
    assert store.publish({"a": "/x"}).version == 1
    V._create(spark, f"{store._manifests}/{2:012d}.json", '{"version": 2, "tab')
    assert store.current().version == 1
    assert store.publish({"a": "/y"}).version == 3
    with pytest.raises(VersionConflict):
        store.publish({"a": "/z"}, after=1)
    assert store.publish({"a": "/z"}, after=3).tables == {"a": "/z"}


def test_old_manifests_go(spark):
    store = VersionedLayers(spark, scratch_path(spark, "many"))
    for k in range(V.KEPT_MANIFESTS + 5):
        store.publish({"a": f"/{k}"})
    assert len(store._numbers()) == V.KEPT_MANIFESTS + 1
    assert store.current().tables == {"a": f"/{V.KEPT_MANIFESTS + 4}"}


def test_feed_to_warehouse_in_one_call(spark):
    base = scratch_path(spark, "job-all")
    wh = TableWarehouse(f"{base}/wh")
    job = run_all(spark, layers.bronze(spark, SF_SMALL), f"{base}/lake", wh, num_trees=4, max_depth=3, groups=2)
    assert wh.read(spark, "fact_sales").count() == spark.read.parquet(job.build.silver).count()
    assert load_model(spark, job.model).num_trees == 4
    assert load_metrics(spark, job.metrics).count() == 1
