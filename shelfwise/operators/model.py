"""Sales model with Spark ML: one-hot categoricals ⊕ numerics → random forest.

Training and scoring are distributed (``fit`` / ``transform``); nothing is
collected. The split is a hash of the record id, so it is repeatable across
partitionings and cluster sizes.

A forest is fitted in groups of trees, each saved as soon as it is fitted. A
fit that is started again with the same ``store`` takes the saved groups and
fits the others, so a lost driver costs one group. Fits, scoring and metrics
read all rows.

A forest only asks on which side of its thresholds a row lies. Where they cut the features into few cells
(``MAX_CELLS``), each cell is scored once and a row takes its cell's prediction, which is the same number; else
every row walks through all trees.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import product
from math import prod

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import is_missing
from shelfwise.schemas import (
    CATEGORICAL_FEATURES,
    FEATURE_COLUMNS,
    NUMERIC_FEATURES,
    PREDICTION_COLUMN,
    RECORD_ID,
    TARGET_COLUMN,
)
from shelfwise.sinks.versions import exists
from shelfwise.sources.files import path_exists, with_record_id

# ---- fixed values: forest size, seed, split and metric names ----
NUM_TREES = 200
MAX_DEPTH = 30            # "unbounded" in the source; 30 is Spark's maximum
SEED = 42
TRAIN_PCT = 80
METRIC_NAMES = ("mae", "rmse", "r2")
# Groups that a forest is fitted in.
TREE_GROUPS = 4
# Cells up to which a forest becomes a table (speed only).
MAX_CELLS = 1 << 14
METRICS_SCHEMA = T.StructType([T.StructField(m, T.DoubleType()) for m in METRIC_NAMES])


def training_frame(silver: DataFrame, target: str = TARGET_COLUMN) -> DataFrame:
    """Feature and target columns; rows with a null target dropped."""
    return silver.select(*FEATURE_COLUMNS, target).where(~is_missing(F.col(target).cast("double")))


def split(frame: DataFrame, train_pct: int = TRAIN_PCT, seed: int = SEED,
          id_column: str = RECORD_ID) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/test split by hashing the record id."""
    bucket = F.pmod(F.xxhash64(F.col(id_column), F.lit(seed)), F.lit(100))
    return frame.where(bucket < train_pct), frame.where(bucket >= train_pct)


def build_pipeline(num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, seed: int = SEED,
                   max_bins: int = 32, target: str = TARGET_COLUMN) -> Pipeline:
    """One-hot (unknown/null → all zeros) + numeric passthrough + forest."""
    indexed = [f"{c}__idx" for c in CATEGORICAL_FEATURES]
    encoded = [f"{c}__ohe" for c in CATEGORICAL_FEATURES]
    indexer = StringIndexer(inputCols=list(CATEGORICAL_FEATURES), outputCols=indexed,
                            handleInvalid="keep")
    # The indexer's "keep" adds one trailing unknown slot (also used for
    # null); dropLast removes exactly that slot → unknown = all zeros,
    # every known category keeps its own position.
    encoder = OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True)
    assembler = VectorAssembler(inputCols=encoded + list(NUMERIC_FEATURES),
                                outputCol="features", handleInvalid="keep")
    # cacheNodeIds keeps each row's current node instead of re-walking every
    # tree from the root on each level (deep trees); its lineage is cut every
    # checkpointInterval iterations with reliable checkpoints in
    # spark.checkpoint.dir.
    forest = RandomForestRegressor(featuresCol="features", labelCol=target,
                                   predictionCol=PREDICTION_COLUMN, numTrees=num_trees,
                                   maxDepth=max_depth, maxBins=max_bins,
                                   featureSubsetStrategy="all", seed=seed,
                                   cacheNodeIds=True, checkpointInterval=10)
    return Pipeline(stages=[indexer, encoder, assembler, forest])


def evaluate(scored: DataFrame, target: str = TARGET_COLUMN) -> DataFrame:
    """MAE, RMSE and R² as one row, computed in one aggregation pass."""
    err = F.col(PREDICTION_COLUMN) - F.col(target)
    stats = scored.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.sum(err * err).alias("_sse"),
        F.var_pop(target).alias("_var"),
        F.count(F.lit(1)).alias("_n"),
    )
    total = F.col("_var") * F.col("_n")
    # Against a constant target: 1.0 without any error, else 0.0.
    flat = F.when(F.col("_sse") == 0, F.lit(1.0)).when(F.col("_sse") > 0, F.lit(0.0))
    r2 = F.when(total > 0, F.lit(1.0) - F.col("_sse") / F.nullif(total, F.lit(0.0))).otherwise(flat)
    return stats.select("mae", "rmse", r2.alias("r2"))


@dataclass(frozen=True)
class ForestModel:
    """Feature stages and the groups of trees; the prediction is the mean over all trees."""

    features: PipelineModel
    groups: tuple[RandomForestRegressionModel, ...]

    @property
    def num_trees(self) -> int:
        return sum(g.getNumTrees for g in self.groups)

    @property
    def depth(self) -> int:
        return max(t.depth for g in self.groups for t in g.trees)

    @property
    def num_features(self) -> int:
        return self.groups[0].numFeatures

    def transform(self, frame: DataFrame) -> DataFrame:
        out = self.features.transform(frame)
        if self.cells is None:
            return self._walked(out)
        cell, size = F.lit(0), 1
        for k, (cuts, _) in self.cells.items():
            # A missing measure is NaN: beyond every threshold in the trees and in SQL.
            side = reduce(lambda x, y: x + y, [(F.col("_values")[k] > F.lit(t)).cast("int") for t in cuts])
            cell, size = cell + side * F.lit(size), size * (len(cuts) + 1)
        table = F.split(F.lit(",".join(map(repr, self._predictions))), ",").cast("array<double>")  # becomes one literal
        out = out.withColumn("_values", vector_to_array("features"))
        return out.withColumn(PREDICTION_COLUMN, F.get(table, cell)).drop("_values")

    @cached_property
    def cells(self) -> dict[int, tuple[list[float], list[float]]] | None:
        """The thresholds against each feature that the trees use, and a value of each side; None if they make too many cells."""
        cuts: dict[int, set[float]] = {}
        flags: set[int] = set()
        for tree in (t for group in self.groups for t in group.trees):
            text = tree.toDebugString
            for feature, threshold in re.findall(r"If \(feature (\d+) <= (\S+)\)", text):
                cuts.setdefault(int(feature), set()).add(float(threshold))
            for feature, values in re.findall(r"If \(feature (\d+) (?:not )?in \{(.*?)\}\)", text):
                if not {float(v) for v in values.split(",")} <= {0.0, 1.0}:
                    return None
                flags.add(int(feature))
                cuts[int(feature)] = {0.0}
            if prod(len(c) + 1 for c in cuts.values()) > MAX_CELLS:
                return None
        return {k: (sorted(c), [*sorted(c), 1.0 if k in flags else float("inf")]) for k, c in sorted(cuts.items())}

    @cached_property
    def _predictions(self) -> list[float]:
        """The forest's prediction in each cell (at most ``MAX_CELLS`` numbers), the first feature's side running fastest."""
        rows = []
        for n, sides in enumerate(product(*[values for _, values in reversed(self.cells.values())])):
            row = [0.0] * self.num_features
            for k, value in zip(reversed(self.cells), sides, strict=True):
                row[k] = value
            rows.append((n, Vectors.dense(row)))
        scored = self._walked(SparkSession.getActiveSession().createDataFrame(rows, ["_cell", "features"]))
        ordered = F.sort_array(F.collect_list(F.struct("_cell", PREDICTION_COLUMN)))
        return scored.agg(ordered[PREDICTION_COLUMN].alias("p")).first()["p"]

    def _walked(self, out: DataFrame) -> DataFrame:
        """Predictions of rows with ``features``, by all trees."""
        names = [f"_group_{k}" for k in range(len(self.groups))]
        for group, name in zip(self.groups, names, strict=True):
            out = group.copy().setPredictionCol(name).transform(out)
        total = reduce(lambda x, y: x + y, [F.col(n) * g.getNumTrees for n, g in zip(names, self.groups, strict=True)])
        return out.withColumn(PREDICTION_COLUMN, total / self.num_trees).drop(*names)


def bounded_rows(frame: DataFrame, max_rows: int, seed: int = SEED, id_column: str = RECORD_ID) -> DataFrame:
    """About ``max_rows`` rows at most, picked by a hash of the id; all rows if there are no more. No fit of this library takes them."""
    rows = frame.count()
    if rows <= max_rows:
        return frame
    parts = 1_000_000
    return frame.where(F.pmod(F.xxhash64(F.col(id_column), F.lit(seed + 1)), F.lit(parts)) < max_rows * parts // rows)


def _saved(spark: SparkSession, path: str, last: str) -> bool:
    """Whether a model was saved to its end: ``last`` is the part that is written last."""
    return exists(spark, f"{path}/{last}/_SUCCESS" if last else f"{path}/_SUCCESS")


def fit_forest(rows, spark: SparkSession, num_trees: int, max_depth: int, seed: int, target: str, groups: int,
               store: str | None = None) -> ForestModel:
    """Fit feature stages and ``groups`` groups of trees on the frame that ``rows()`` gives.

    ``rows`` is only called if something is left to fit.
    """
    *stages, forest = build_pipeline(num_trees, max_depth, seed, target=target).getStages()
    sizes = [num_trees // groups + (k < num_trees % groups) for k in range(groups)]
    sizes = [n for n in sizes if n]
    kept = lambda name, last: store is not None and _saved(spark, f"{store}/{name}", last)
    features = PipelineModel.load(f"{store}/features") if kept("features-done", "") else None
    fitted = [RandomForestRegressionModel.load(f"{store}/group-{k}") if features and kept(f"group-{k}", "data") else None
              for k in range(len(sizes))]
    if features is None or None in fitted:
        # Each pass of a fit reads the persisted rows (only these are kept: their vectors take several times the space and are
        # cheap to make again); a lost executor's blocks are recomputed from lineage.
        data = rows().persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if features is None:
                features = Pipeline(stages=stages).fit(data)
                if store is not None:
                    features.write().overwrite().save(f"{store}/features")
                    spark.range(1).coalesce(1).write.mode("overwrite").json(f"{store}/features-done")
            vectors = features.transform(data).select("features", target)
            for k, n in enumerate(sizes):
                if fitted[k] is None:
                    fitted[k] = forest.copy().setNumTrees(n).setSeed(seed + k).fit(vectors)
                    if store is not None:
                        fitted[k].write().overwrite().save(f"{store}/group-{k}")
        finally:
            data.unpersist()
    return ForestModel(features, tuple(fitted))


def train(silver: DataFrame, num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, seed: int = SEED,
          target: str = TARGET_COLUMN, groups: int = TREE_GROUPS,
          store: str | None = None) -> tuple[ForestModel, DataFrame]:
    """Fit on all rows of the 80 % and return (model, one-row metrics frame on the 20 %).

    ``store`` keeps the fitted groups of trees, for a fit that goes on where another ended.
    """
    data = with_record_id(silver).select(*FEATURE_COLUMNS, target, RECORD_ID).where(~is_missing(F.col(target).cast("double")))
    train_df, test_df = split(data, seed=seed)

    def rows() -> DataFrame:
        # Each pass works on the persisted rows: deal them out evenly, whatever the files' layout.
        return train_df.repartition(RECORD_ID)

    model = fit_forest(rows, silver.sparkSession, num_trees, max_depth, seed, target, groups, store)
    return model, evaluate(model.transform(test_df), target)


def with_planted_target(silver: DataFrame, column: str = "planted_sales") -> DataFrame:
    """A learnable target for test data whose real sales carry no signal:
    50 + 40·(outlet type index) + 3·weight + 100·visibility."""
    type_index = (F.when(F.col("outlet_type") == "Grocery Store", 0)
                  .when(F.col("outlet_type") == "Supermarket Type1", 1)
                  .when(F.col("outlet_type") == "Supermarket Type2", 2)
                  .when(F.col("outlet_type") == "Supermarket Type3", 3))
    return silver.withColumn(
        column, F.lit(50.0) + F.lit(40.0) * type_index + F.lit(3.0) * F.col("item_weight")
        + F.lit(100.0) * F.col("item_visibility"))


def with_step_target(silver: DataFrame, column: str = "step_sales") -> DataFrame:
    """A target of whole numbers that two categories fix: 50 + 40·(outlet type index) + 7·(outlet size index).

    Trees that are grown to pure leaves predict it exactly, so every prediction can be checked.
    """
    size_index = F.when(F.col("outlet_size") == "Small", 0).when(F.col("outlet_size") == "Medium", 1).when(F.col("outlet_size") == "High", 2)
    type_index = (F.when(F.col("outlet_type") == "Grocery Store", 0)
                  .when(F.col("outlet_type") == "Supermarket Type1", 1)
                  .when(F.col("outlet_type") == "Supermarket Type2", 2)
                  .when(F.col("outlet_type") == "Supermarket Type3", 3))
    return silver.withColumn(column, F.lit(50.0) + F.lit(40.0) * type_index + F.lit(7.0) * size_index)


def save_model(model: ForestModel, path: str) -> None:
    """Save all parts; ``parts`` comes last and marks the model as whole."""
    path = path.rstrip("/")
    spark = SparkSession.getActiveSession()
    model.features.write().overwrite().save(f"{path}/features")
    for k, group in enumerate(model.groups):
        group.write().overwrite().save(f"{path}/group-{k}")
    spark.range(len(model.groups)).coalesce(1).write.mode("overwrite").json(f"{path}/parts")


def load_model(spark: SparkSession, path: str) -> ForestModel | None:
    """The saved model, or None when there is nothing at ``path``; a model that is not whole is an error."""
    path = path.rstrip("/")
    if not exists(spark, path):
        return None
    if not _saved(spark, path, "parts"):
        raise ValueError(f"{path} holds no whole model")
    groups = spark.read.schema("id long").json(f"{path}/parts").count()
    return ForestModel(PipelineModel.load(f"{path}/features"),
                       tuple(RandomForestRegressionModel.load(f"{path}/group-{k}") for k in range(groups)))


def save_metrics(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").json(path)


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics as one row; an empty frame (the ``{}`` document) if absent."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], METRICS_SCHEMA)
    return spark.read.schema(METRICS_SCHEMA).json(path)


def score(model: ForestModel | None, frame: DataFrame) -> DataFrame:
    """Add ``predicted_total_sales``; a null column when there is no model."""
    if model is None:
        return frame.withColumn(PREDICTION_COLUMN, F.lit(None).cast("double"))
    keep = frame.columns
    return model.transform(frame).select(*keep, PREDICTION_COLUMN)


def score_if_missing(model: ForestModel | None, frame: DataFrame) -> DataFrame:
    """Score the rows that have no prediction yet; stored predictions stay."""
    if PREDICTION_COLUMN not in frame.columns:
        return score(model, frame)
    if model is None:
        return frame
    stored = "_stored_prediction"
    scored = score(model, frame.withColumnRenamed(PREDICTION_COLUMN, stored))
    return scored.withColumn(PREDICTION_COLUMN, F.coalesce(stored, PREDICTION_COLUMN)).select(*frame.columns)

