"""Distributed training with ``pyspark.ml`` and evaluation on a fixed split.

Scores always leave a model as a long table ``(model, key, label, score)``
keyed by the entity id, so every comparison (blend, stack, leaderboard) is a
key join, never a positional alignment.

Learner mapping:

* logistic regression, ``C`` and balanced class weights ->
  ``LogisticRegression(weightCol, regParam = 1 / (C * sum(w)), standardization=False)``
  (same objective: C * sum(w * loss) + |b|^2 / 2, rescaled);
* random forest -> :mod:`riskframe.operators.forest` (no depth limit, balanced weights computed once on the training
  part or per bootstrap sample); ``RandomForestClassifier`` (no depth limit -> depth 30, Spark's maximum) stays for
  vectors that are not binned;
* boosted trees -> :mod:`riskframe.operators.boosting` (leaf counts, features drawn per tree);
  ``GBTClassifier`` stays for vectors that are not binned;
* neural network -> :mod:`riskframe.operators.network` (weighted loss, dropout, mini-batches);
  ``MultilayerPerceptronClassifier`` stays, with positives replicated ``round(neg/pos)`` times.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import metrics as met
from riskframe.operators.profile import class_weights
from riskframe.session import cut_lineage, ensure_checkpoint_dir
from riskframe.sources.catalog import path_exists, read_json, write_json

FEATURES = "features"
WEIGHT = "weight"


def assemble(df: DataFrame, feature_cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    va = VectorAssembler(inputCols=list(feature_cols), outputCol=FEATURES, handleInvalid="keep")
    return va.transform(df).select(*keep, FEATURES)


def with_weights(df: DataFrame, label: str, scheme: str) -> DataFrame:
    """``balanced``: n / (2 n_class); ``pos_ratio``: positives weigh neg/pos, negatives 1."""
    w = class_weights(df, label)
    if scheme == "balanced":
        col = F.col("balanced_weight")
    elif scheme == "pos_ratio":
        col = F.when(F.col(label) == 1, F.col("scale_pos_weight")).otherwise(F.lit(1.0))
    else:
        return df.withColumn(WEIGHT, F.lit(1.0))
    return df.join(F.broadcast(w.select(label, "balanced_weight", "scale_pos_weight")), label).withColumn(  # one row per class
        WEIGHT, col.cast("double")).drop("balanced_weight", "scale_pos_weight")


def oversample_positives(df: DataFrame, label: str) -> DataFrame:
    """Replicate each positive row round(neg/pos) times (for learners without weights)."""
    w = class_weights(df, label).select(label, "scale_pos_weight").where(F.col(label) == 1)
    k = F.greatest(F.lit(1), F.round(F.coalesce(F.col("scale_pos_weight"), F.lit(1.0))).cast("int"))
    reps = F.when(F.col(label) == 1, k).otherwise(F.lit(1))
    return (df.join(F.broadcast(w), label, "left")  # at most one row
            .withColumn("__rep", F.explode(F.array_repeat(F.lit(1), reps))).drop("__rep", "scale_pos_weight"))


def positive_probability(pred: DataFrame) -> DataFrame:
    return pred.withColumn("score", vector_to_array("probability")[1])


def score_table(model: Model, df: DataFrame, key: str, label: str, name: str) -> DataFrame:
    """(model, key, label, score) for every row of ``df``."""
    return positive_probability(model.transform(df)).select(
        F.lit(name).alias("model"), key, F.col(label).alias("label"), "score")


# ------------------------------------------------------------------ estimators (M1-M4)

def logistic(C: float = 1.0, total_weight: float = 1.0, max_iter: int = 1000, tol: float = 1e-4,
             label: str = "label") -> LogisticRegression:
    """``tol`` and ``max_iter`` follow the usual lbfgs defaults of the original learner."""
    return LogisticRegression(featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, maxIter=max_iter, tol=tol,
                              regParam=1.0 / (C * total_weight), elasticNetParam=0.0, standardization=False)


def random_forest(n_trees: int = 100, max_depth: int | None = None, min_leaf: int = 1, seed: int = 42,
                  label: str = "label") -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, numTrees=n_trees,
                                  maxDepth=30 if max_depth is None else int(max_depth),
                                  minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed)


def boosted_trees(n_iter: int = 100, step: float = 0.05, max_depth: int = 5, min_leaf: int = 20,
                  subsample: float = 0.8, feature_fraction: float = 0.8, seed: int = 42,
                  label: str = "label") -> GBTClassifier:
    return GBTClassifier(featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, maxIter=n_iter, stepSize=step,
                         maxDepth=max_depth, minInstancesPerNode=min_leaf, subsamplingRate=subsample,
                         featureSubsetStrategy=str(feature_fraction), seed=seed)


def neural_net(n_features: int, hidden: Sequence[int] = (64, 16), max_iter: int = 50, step: float = 0.03,
               seed: int = 42, label: str = "label") -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(featuresCol=FEATURES, labelCol=label, layers=[n_features, *hidden, 2],
                                          maxIter=max_iter, stepSize=step, seed=seed)


def fit_and_score(estimator, train: DataFrame, valid: DataFrame, key: str, label: str, name: str,
                  weighting: str | None = None):
    """Fit on ``train`` (with the weight scheme) and return (model, validation scores)."""
    tr = train
    if isinstance(estimator, MultilayerPerceptronClassifier):
        tr = oversample_positives(train, label)
    else:
        tr = with_weights(train, label, weighting or "none")
    model = estimator.fit(tr)
    return model, score_table(model, valid, key, label, name)


def total_weight(train: DataFrame, label: str, scheme: str) -> float:
    return with_weights(train, label, scheme).agg(F.sum(WEIGHT)).first()[0]


# ------------------------------------------------------------------ grid search (M5)

def expand_grid(grid: dict) -> list[dict]:
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in product(*[grid[k] for k in keys])]


def grid_folder(spark, name: str, points: Sequence[dict], results: str | None = None) -> str:
    """The folder for the results of a grid, a fresh one by default; one that holds another grid raises."""
    folder = results or f"{ensure_checkpoint_dir(spark)}/grid-{uuid.uuid4().hex}"
    described = {"name": name, "points": [str(p) for p in points]}
    if path_exists(spark, f"{folder}/grid.json"):
        if read_json(spark, f"{folder}/grid.json") != described:
            raise ValueError(f"{folder} holds the results of another grid")
    else:
        write_json(spark, described, f"{folder}/grid.json")
    return folder


def grid_search(build, grid: dict, train: DataFrame, valid: DataFrame, key: str, label: str,
                weighting: str | None, name: str = "model", results: str | None = None, workers: int = 4):
    """Fit every grid point on the same split, ``workers`` of them at a time; best by average_precision,
    then roc_auc, then the earliest grid point. Returns (results table, best params, best model).

    Every point's validation metrics and model are written to the folder ``results`` when the point
    is ready (a fresh one in the shared checkpoint folder by default), so the driver holds the models
    being fitted only, and a run started again with the same folder skips finished points. A folder of
    another grid raises.
    """
    spark, points = train.sparkSession, expand_grid(grid)
    folder = grid_folder(spark, name, points, results)
    weighted = cut_lineage(oversample_positives(train, label) if isinstance(build(**points[0]), MultilayerPerceptronClassifier) else with_weights(train, label, weighting or "none"))

    def run(i: int) -> None:
        at = f"{folder}/point-{i}"
        if path_exists(spark, f"{at}/_SUCCESS"):
            return
        model = build(**points[i]).fit(weighted)
        model.write().overwrite().save(f"{folder}/model-{i}")
        scores = score_table(model, valid, key, label, name).withColumn("grid_index", F.lit(i))
        met.binary_metrics(scores, 0.5, ["grid_index"]).coalesce(1).write.mode("overwrite").parquet(at)  # one row

    with ThreadPoolExecutor(workers) as pool:  # Spark runs the points' jobs side by side
        list(pool.map(inheritable_thread_target(spark)(run), range(len(points))))
    found = spark.read.parquet(*[f"{folder}/point-{i}" for i in range(len(points))])
    table = best_first(found, points)
    best = table.first().grid_index
    return table, points[best], _load(spark, f"{folder}/model-{best}")


def _load(spark, path: str):
    """A stored model of whatever class its metadata names."""
    return DefaultParamsReader.loadParamsInstance(path, spark)


def grid_table(scores: DataFrame, points: Sequence[dict]) -> DataFrame:
    """Metrics of all grid points (column ``grid_index`` of the validation scores), best first."""
    return best_first(met.binary_metrics(scores, 0.5, ["grid_index"]), points)


def best_first(metrics: DataFrame, points: Sequence[dict]) -> DataFrame:
    params = metrics.sparkSession.createDataFrame([(i, str(p)) for i, p in enumerate(points)], "grid_index int, params string")
    return metrics.join(F.broadcast(params), "grid_index").orderBy(F.desc("average_precision"), F.desc("roc_auc"), "grid_index")  # one row per grid point
