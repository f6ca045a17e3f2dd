"""A fit takes up the groups of trees that an earlier one saved, and reads a bounded number of rows."""

from __future__ import annotations

import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import model as M
from shelfwise.plans import layers
from shelfwise.session import scratch_path


@pytest.fixture(scope="module")
def silver(spark):
    path = scratch_path(spark, "forest-silver")
    M.with_step_target(layers.silver_lazy(spark, SF_SMALL)).write.parquet(path)
    return spark.read.parquet(path)


def test_a_fit_goes_on_where_another_ended(spark, silver, monkeypatch):
    store, fits, fit = scratch_path(spark, "forest-store"), [], RandomForestRegressor.fit

    def failing(self, data, *args):
        if len(fits) == 1:
            raise RuntimeError("driver lost")
        fits.append(self.getNumTrees())
        return fit(self, data, *args)

    args = {"num_trees": 5, "max_depth": 6, "target": "step_sales", "groups": 2, "store": store}
    with monkeypatch.context() as m:
        m.setattr(RandomForestRegressor, "fit", failing)
        with pytest.raises(RuntimeError):
            M.train(silver, **args)
    assert fits == [3]
    again = []
    with monkeypatch.context() as m:
        m.setattr(RandomForestRegressor, "fit", lambda self, data, *a: again.append(self.getNumTrees()) or fit(self, data, *a))
        model, metrics = M.train(silver, **args)
        M.train(silver, **args)
    assert again == [2] and model.num_trees == 5
    assert metrics.first()["r2"] == 1.0


def test_fit_rows_are_bounded_and_repeatable(silver):
    n = silver.count()
    some = M.bounded_rows(silver, 1000)
    assert 800 < some.count() < 1200
    assert some.exceptAll(M.bounded_rows(silver.repartition(7), 1000)).count() == 0
    assert M.bounded_rows(silver, n).count() == n
    assert some.where(F.col("record_id").isNull()).count() == 0


def test_fits_read_every_training_row(spark, silver, monkeypatch):
    """Also beyond 200,000 rows: the rows of a fit are those of the split."""
    rows = silver.crossJoin(spark.range(50)).withColumn("record_id", F.concat_ws("-", "record_id", "id")).drop("id")
    seen, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, data, *a: seen.append(data.count()) or fit(self, data, *a))
    M.train(rows, num_trees=2, max_depth=2, target="step_sales", groups=2)
    n = M.split(rows)[0].count()
    assert n > 220_000 and seen == [n, n]


def _both_ways(model, rows, monkeypatch):
    """Predictions by cells and by all trees, of the same rows."""
    assert model.cells is not None
    by_cells = {r["record_id"]: r[M.PREDICTION_COLUMN] for r in M.score(model, rows).collect()}
    with monkeypatch.context() as m:
        m.setitem(model.__dict__, "cells", None)
        by_trees = {r["record_id"]: r[M.PREDICTION_COLUMN] for r in M.score(model, rows).collect()}
    return by_cells, by_trees


@pytest.mark.parametrize(("target", "depth"), [("step_sales", 6), ("total_sales", 2)])
def test_cells_give_the_prediction_of_all_trees(silver, monkeypatch, target, depth):
    """Also for missing and unknown values and on the thresholds themselves."""
    model, _ = M.train(silver, num_trees=4, max_depth=depth, target=target, groups=2)
    numeric = {c: F.when(F.crc32("record_id") % 5 == k, F.lit(None) if k else F.lit(float("nan"))).otherwise(F.col(c).cast("double")) for k, c in enumerate(M.NUMERIC_FEATURES)}
    odd = silver.withColumns(numeric).withColumn("outlet_type", F.when(F.crc32("record_id") % 7 == 0, "never seen").otherwise(F.col("outlet_type")))
    by_cells, by_trees = _both_ways(model, silver.unionByName(odd.withColumn("record_id", F.concat(F.lit("odd"), "record_id"))), monkeypatch)
    assert by_cells == by_trees and len(by_cells) == 2 * silver.count()
    plan = M.score(model, silver)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "UDF" in plan
    assert M.score(model, silver).columns == [*silver.columns, M.PREDICTION_COLUMN]


def test_forests_of_many_cells_walk_through_their_trees(silver, monkeypatch):
    monkeypatch.setattr(M, "MAX_CELLS", 1)
    model, _ = M.train(silver, num_trees=2, max_depth=3, target="step_sales", groups=1)
    assert model.cells is None
    assert M.score(model, silver).where(F.col(M.PREDICTION_COLUMN).isNull()).count() == 0
