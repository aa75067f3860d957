"""Model fitting, scoring and tuning on DataFrames (M1, M3, M4, M6, M7,
M13-M16).

MLlib does the heavy part: every fit is a series of distributed aggregates
(``treeAggregate`` over the partitions for the linear and logistic solvers,
per-node histogram aggregates for the trees), so only weights, trees and
metric rows reach the driver.  Features go in as one vector column built by
``vectorize`` (JVM side, no Python per row).

Parameter names follow MLlib; where the reference's learner has a knob MLlib
lacks, the nearest one is used and named in the docstring (SURVEY Q24).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (LogisticRegression,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import (GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.missing import qcol
from tabprep.operators.metrics import regression_errors
from tabprep.session import ensure_checkpoint_dir

FEATURES = "features"
PREDICTION = "prediction"

#: Tree learners keep every row with its bin of each feature and its share of
#: every tree; this many rows make one task, however few files they come from.
ROWS_PER_TASK = 250_000


def vectorize(df: DataFrame, features: Sequence[str] | str, out: str = FEATURES,
              keep: Sequence[str] = ()) -> DataFrame:
    """Feature columns (or one array column) -> one ML vector column."""
    from pyspark.ml.functions import array_to_vector
    if isinstance(features, str):
        arr = qcol(features).cast("array<double>")
    else:
        arr = F.array(*[qcol(c).cast("double") for c in features])
    return df.select(*[qcol(k) for k in keep], array_to_vector(arr).alias(out))


# ------------------------------------------------------------ estimators

def linear_regression(label: str = "label", features: str = FEATURES) -> LinearRegression:
    """M1: ordinary least squares by the normal equations (one aggregate of
    X'X and X'y over all partitions, then a Cholesky solve on the driver of
    a d x d system)."""
    return LinearRegression(featuresCol=features, labelCol=label, solver="normal",
                            regParam=0.0, elasticNetParam=0.0, standardization=False,
                            fitIntercept=True)


def softmax_regression(label: str = "label", features: str = FEATURES,
                       max_iter: int = 100, reg: float = 0.0) -> LogisticRegression:
    """M3: multinomial logistic regression (softmax + cross entropy)."""
    return LogisticRegression(featuresCol=features, labelCol=label, family="multinomial",
                              regParam=reg, elasticNetParam=0.0, maxIter=max_iter)


def perceptron(layers: Sequence[int], label: str = "label", features: str = FEATURES,
               max_iter: int = 100, seed: int = 0, step_size: float = 0.03,
               solver: str = "l-bfgs") -> MultilayerPerceptronClassifier:
    """M4: one-hidden-layer (or deeper) perceptron classifier with a softmax
    head.  MLlib's hidden units are sigmoid; for ReLU hidden units use the
    dense SGD job (``tabprep.plans.sgd``) with a softmax loss."""
    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label,
                                          layers=list(layers), maxIter=max_iter,
                                          seed=seed, stepSize=step_size, solver=solver)


def random_forest(label: str = "label", features: str = FEATURES, num_trees: int = 600,
                  max_depth: int = 15, feature_subset: str = "0.3",
                  min_instances: int = 1, seed: int = 0,
                  subsampling: float = 1.0, cache_node_ids: bool = False) -> RandomForestRegressor:
    """M6: the reference's forest is 600 trees, depth 15, 0.3 of the features
    per split, leaf 1; ``min_samples_split=5`` has no MLlib twin (nearest:
    ``minInstancesPerNode`` on leaves), and trees deeper than 30 are beyond
    MLlib (an error here, not another depth).  Bootstrap sampling is MLlib's
    default for forests.  ``cache_node_ids`` keeps each row's node between
    levels instead of shipping the trees to the tasks at every level
    (measured: about 25% faster at depth 15, slower for shallow trees); the
    trees are the same."""
    if max_depth > 30:
        raise ValueError("trees deeper than 30 levels are not supported")
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=num_trees,
                                 maxDepth=max_depth,
                                 featureSubsetStrategy=feature_subset,
                                 minInstancesPerNode=min_instances, seed=seed,
                                 subsamplingRate=subsampling,
                                 cacheNodeIds=cache_node_ids)


def boosted_trees(label: str = "label", features: str = FEATURES, max_iter: int = 500,
                  step_size: float = 0.05, max_depth: int = 5, subsample: float = 0.7,
                  feature_subset: str = "0.9", min_info_gain: float = 0.0,
                  seed: int = 0) -> GBTRegressor:
    """M7: squared-error boosting: 500 rounds, learning rate 0.05, depth 5,
    row subsample 0.7.  The reference's per-tree column sample 0.9 is
    per-node here, and its ``gamma`` maps to ``minInfoGain`` (other scale)."""
    return GBTRegressor(featuresCol=features, labelCol=label, lossType="squared",
                        maxIter=max_iter, stepSize=step_size, maxDepth=max_depth,
                        subsamplingRate=subsample, featureSubsetStrategy=feature_subset,
                        minInstancesPerNode=1, minInfoGain=min_info_gain, seed=seed)


class MeanRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """The mean predictor: one ``avg`` over the label.  The baseline every
    learner must beat, and an estimator whose fold scores SQL can repeat."""

    def __init__(self, labelCol: str = "label", featuresCol: str = FEATURES,
                 predictionCol: str = PREDICTION):
        super().__init__()
        self._set(labelCol=labelCol, featuresCol=featuresCol, predictionCol=predictionCol)

    def _fit(self, dataset: DataFrame) -> "MeanModel":
        mean = dataset.agg(F.avg(qcol(self.getLabelCol()).cast("double"))).first()[0]
        m = MeanModel(mean)
        m._set(predictionCol=self.getPredictionCol())
        return m


class MeanModel(Model, HasPredictionCol):
    def __init__(self, mean: float | None = None):
        super().__init__()
        self.mean = mean

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getPredictionCol(),
                                  F.lit(self.mean).cast("double"))


# --------------------------------------------------------------- scoring

def spread(estimator: Estimator, df: DataFrame) -> DataFrame:
    """``df`` dealt to tasks of about ``ROWS_PER_TASK`` rows for a tree
    learner, which reads what its partition holds at every level; tables of
    fewer rows, and other learners' tables, stay as they are.  Boosting adds
    to the rows' lineage in every round; where that is long, the session's
    checkpoint folder must be set, so that it is cut every few rounds."""
    if not isinstance(estimator, (GBTRegressor, RandomForestRegressor)):
        return df
    if isinstance(estimator, GBTRegressor) and estimator.getMaxIter() > estimator.getCheckpointInterval() > 0:
        ensure_checkpoint_dir(df.sparkSession)
    tasks = -(-df.count() // ROWS_PER_TASK)
    return df.repartition(tasks) if tasks > 1 else df


def fits_at_once(df: DataFrame, fits: int) -> int:
    """How many of ``fits`` on ``df`` run side by side: as many as together
    have about ``ROWS_PER_TASK`` rows for each of the session's cores (every
    fit keeps its own copy of the rows), so one at a time on a large table,
    whose fits have tasks for all cores by themselves."""
    tasks = max(1, -(-df.count() // ROWS_PER_TASK))
    return max(1, min(fits, df.sparkSession.sparkContext.defaultParallelism // tasks))


def fit_score(estimator: Estimator, train: DataFrame, test: DataFrame,
              keep: Sequence[str] = (), dealt: bool = False) -> DataFrame:
    """Fit on all of ``train``, score ``test``; returns keep + prediction.
    ``dealt``: ``train`` is ``spread`` already."""
    model = estimator.fit(train if dealt else spread(estimator, train))
    pred_col = model.getOrDefault("predictionCol") if model.hasParam("predictionCol") \
        else PREDICTION
    return model.transform(test).select(*[qcol(k) for k in keep],
                                        F.col(pred_col).cast("double").alias(PREDICTION))


# ---------------------------------------------------------- fold scores

@contextmanager
def _persisted(df: DataFrame):
    """Scanned once per fold or candidate: kept in memory, spilling to disk,
    until the fits are done; lost blocks are recomputed from the (short)
    lineage."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def cv_predictions(estimator: Estimator, df: DataFrame, k: int, fold_col: str = "fold",
                   keep: Sequence[str] = (), parallelism: int = 1) -> DataFrame:
    """Out-of-fold predictions.  Fold f's model is fit on the other
    folds and scores fold f; the k scored parts are unioned (no shuffle).
    The fits share one cache of ``df``, released when they are done; scoring
    reads ``df`` again when the result is used."""
    with _persisted(spread(estimator, df)) as data:
        fitted = _fold_models(estimator, data, k, fold_col, parallelism)
    return _out_of_fold(fitted, df, fold_col, keep)


def _fold_models(estimator: Estimator, data: DataFrame, k: int, fold_col: str, parallelism: int) -> list[Model]:
    """The model of each fold, fit on the others, each by its own estimator."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(lambda own, f: own.fit(data.where(F.col(fold_col) != f)),
                             [estimator.copy() for _ in range(k)], range(k)))


def _out_of_fold(fitted: Sequence[Model], df: DataFrame, fold_col: str, keep: Sequence[str]) -> DataFrame:
    """Each fold scored by its model, unioned."""
    parts = [model.transform(df.where(F.col(fold_col) == f)).select(
        *[qcol(c) for c in keep], F.col(fold_col),
        F.col(PREDICTION).cast("double").alias(PREDICTION)) for f, model in enumerate(fitted)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cv_scores(estimator: Estimator, df: DataFrame, label: str, k: int,
              fold_col: str = "fold", parallelism: int = 1) -> DataFrame:
    """M13 + A13: one row per fold with n, neg_rmse and neg_mae (larger is
    better, as in the reference's scorers).  The folds are fit and scored from
    one cache of ``df``."""
    with _persisted(spread(estimator, df)) as data:
        return dealt_scores(estimator, data, label, k, fold_col, parallelism)


def dealt_scores(estimator: Estimator, data: DataFrame, label: str, k: int,
                 fold_col: str = "fold", parallelism: int = 1) -> DataFrame:
    """``cv_scores`` of a table that is ``spread`` and kept; its one row per
    fold is computed before this returns, while the table is kept."""
    fitted = _fold_models(estimator, data, k, fold_col, parallelism)
    err = regression_errors(_out_of_fold(fitted, data, fold_col, [label]), PREDICTION, label, by=[fold_col])
    err = err.select(fold_col, "n", "neg_rmse", "neg_mae")
    return data.sparkSession.createDataFrame(err.collect(), err.schema)


# ---------------------------------------------------------- grid search

def param_grid(estimator: Estimator, grid: dict[str, Sequence]) -> list[dict]:
    """Cartesian grid in the order given (last parameter varies fastest)."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return b.build()


def grid_search(spark: SparkSession, estimator: Estimator, df: DataFrame,
                grid: dict[str, Sequence], label: str, k: int, fold_col: str = "fold",
                parallelism: int = 1, metric: str = "rmse") -> tuple[Model, DataFrame]:
    """K-fold grid search on the fold column (D2) by ``metric``
    (``rmse`` or ``mae``).  Returns the best model refit on all of ``df``
    (smallest mean error, the first on a tie) and a table of one row per
    candidate: its parameters, mean and population std of the per-fold
    negative error (``neg_<metric>_mean``, ``..._std``), and its rank."""
    if metric not in ("rmse", "mae"):
        raise ValueError("metric must be 'rmse' or 'mae'")
    maps = param_grid(estimator, grid)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps,
                        evaluator=RegressionEvaluator(labelCol=label, metricName=metric),
                        numFolds=k, foldCol=fold_col, parallelism=parallelism,
                        collectSubModels=False)
    with _persisted(spread(estimator, df)) as data:
        model = cv.fit(data)
    names = list(grid)
    rows = []
    for i, (pm, avg, std) in enumerate(zip(maps, model.avgMetrics, model.stdMetrics)):
        vals = {p.name: pm[p] for p in pm}
        rows.append((i, *[float(vals[n]) for n in names], -float(avg), float(std)))
    schema = ", ".join(["candidate int"] + [f"`{n}` double" for n in names]
                       + [f"neg_{metric}_mean double", f"neg_{metric}_std double"])
    table = spark.createDataFrame(rows, schema)
    from pyspark.sql.window import Window
    # a few hundred candidate rows at most: the single-partition window is tiny
    table = table.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col(f"neg_{metric}_mean").desc(), F.col("candidate"))))
    return model.bestModel, table

