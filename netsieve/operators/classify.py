"""Supervised models, cross-validation, comparison and importances (Spark ML)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, MinMaxScaler, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.operators import metrics
from netsieve.operators.boosting import HistogramBoosting
from netsieve.operators.forest import SparseForest
from netsieve.operators.kernel import KernelSVM
from netsieve.operators.network import DenseNetwork
from netsieve.operators.encode import stratified_folds, stratified_split

MODEL_SCHEMA = "model string, accuracy double, cv_mean double, cv_std double"


def estimators(trees: int = 100, depth: int = 30, rounds: int = 100, iterations: int = 1000, seed: int = 42) -> dict[str, Estimator]:
    """The five classifiers over ``features`` and the numeric ``target``.

    Boosting and the support vectors (Gaussian kernel, through a Nyström map) train all classes
    and folds in one run. All costs are linear in the rows, none is skipped on big data. Trees of
    the forest grow to the depth that Spark allows.
    """
    cols = {"featuresCol": "features", "labelCol": "target"}
    return {
        "Random Forest": RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **cols),
        "Gradient Boosting": HistogramBoosting(rounds=rounds, depth=3),
        "Logistic Regression": LogisticRegression(maxIter=iterations, family="multinomial", **cols),
        "Support Vector Machine": KernelSVM(seed=seed),
        "Naive Bayes": NaiveBayes(modelType="multinomial", featuresCol="non_negative", labelCol="target"),
    }


def index_target(df: DataFrame, label: str):
    """Alphabetical label codes as ``target`` and the model that made them."""
    model = StringIndexer(inputCol=label, outputCol="target", stringOrderType="alphabetAsc", handleInvalid="skip").fit(df)
    return model.transform(df), model


def with_non_negative(df: DataFrame, train: DataFrame) -> DataFrame:
    """Features moved into [0, 1], the range of the training rows, for the multinomial model.

    Values outside that range are cut to it, since the model takes no negative ones.
    """
    scaled = MinMaxScaler(inputCol="features", outputCol="_scaled").fit(train).transform(df)
    clipped = F.transform(vector_to_array("_scaled"), lambda x: F.greatest(F.least(x, F.lit(1.0)), F.lit(0.0)))
    return scaled.withColumn("non_negative", array_to_vector(clipped)).drop("_scaled")


@dataclass
class Fitted:
    name: str
    model: object
    accuracy: float
    cv_mean: float
    cv_std: float


def _accuracy(model, test: DataFrame) -> float:
    return metrics.accuracy(model.transform(test), "target", "prediction").first()[0]


def cross_validate(est: Estimator, train: DataFrame, folds: int) -> list[float]:
    """Accuracy per fold; ``fold`` is a column, so each fold is a filter of one cached table."""
    return [_fold_accuracy(est, train, f) for f in range(folds)]


def _fold_accuracy(est: Estimator, train: DataFrame, f: int) -> float:
    return _accuracy(est.fit(train.where(F.col("fold") != f)), train.where(F.col("fold") == f))


def _fit_and_score(est, train: DataFrame, test: DataFrame, folds: int, pool: ThreadPoolExecutor):
    """Futures of ``(model, accuracy)`` and of the accuracies per fold."""

    def whole():
        model = est.fit(train)
        return model, _accuracy(model, test)

    def joint():
        model, parts = est.fit_folds(train, folds)
        scores = [_accuracy(part, train.where(F.col("fold") == f)) for f, part in enumerate(parts)]
        return (model, _accuracy(model, test)), scores

    if folds > 1 and hasattr(est, "fit_folds"):
        both = pool.submit(inheritable_thread_target(joint))
        return lambda: both.result()
    fitted = pool.submit(inheritable_thread_target(whole))
    if folds <= 1:
        return lambda: (fitted.result(), [fitted.result()[1]])
    parts = [pool.submit(inheritable_thread_target(lambda f=f: _fold_accuracy(est, train, f))) for f in range(folds)]
    return lambda: (fitted.result(), [p.result() for p in parts])


def train_and_compare(
    df: DataFrame, label: str, key: list[str], models: dict[str, Estimator], folds: int = 3, seed: int = 42, parallel: int = 4
) -> tuple[list[Fitted], DataFrame]:
    """Stratified 80/20 split, stratified k-fold scores on the training part, test accuracy.

    Up to ``parallel`` fits share the cluster at a time. Returns the fitted models, best first, and
    the held-out rows, which stay persisted.
    """
    rows, _ = index_target(df.na.drop(subset=[label]), label)
    split = stratified_split(rows, label, key, 0.2, seed).persist(StorageLevel.MEMORY_AND_DISK)
    rows = with_non_negative(split, split.where(~F.col("is_test")))
    rows = stratified_folds(rows, label, key, folds, seed)
    rows = rows.select("features", "non_negative", "target", label, *key, "is_test", "fold").persist(StorageLevel.MEMORY_AND_DISK)
    train, test = rows.where(~F.col("is_test")), rows.where("is_test")
    with ThreadPoolExecutor(parallel) as pool:
        waiting = {name: _fit_and_score(est, train, test, folds, pool) for name, est in models.items()}
        done = []
        for name, result in waiting.items():
            (model, acc), scores = result()
            done.append(Fitted(name, model, acc, float(np.mean(scores)), float(np.std(scores))))
    split.unpersist()
    done.sort(key=lambda m: (-m.accuracy, m.name))
    return done, test


def comparison(spark, fitted: list[Fitted]) -> DataFrame:
    rows = [(m.name, m.accuracy, m.cv_mean, m.cv_std) for m in fitted]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names from the vector's attribute metadata, by position."""
    attrs = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    found = {a["idx"]: a.get("name", f"feature_{a['idx']}") for group in attrs.values() for a in group}
    return [found[i] for i in sorted(found)]


def importances(spark, model, names: list[str], top: int | None = None) -> DataFrame:
    """Features by falling importance, all of them or the ``top`` ones."""
    values = model.featureImportances.toArray()
    order = sorted(range(len(values)), key=lambda i: (-values[i], names[i]))[:top]
    return spark.createDataFrame([(names[i], float(values[i])) for i in order], "feature string, importance double")


def all_importances(spark, fitted: list[Fitted], names: list[str]) -> DataFrame:
    """``model, feature, importance`` of every tree model."""
    rows = []
    for m in fitted:
        if hasattr(m.model, "featureImportances"):
            values = m.model.featureImportances.toArray()
            rows += [(m.name, n, float(v)) for v, n in sorted(zip(values, names, strict=True), key=lambda x: (-x[0], x[1]))]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


# --- text classifiers -------------------------------------------------------------


def fit_text_classifier(df: DataFrame, label: str, prefix: str, depth: int, trees: int = 100, seed: int = 42) -> PipelineModel:
    """Forest over ``features`` that adds the predicted label and the class probabilities."""
    index = StringIndexer(inputCol=label, outputCol=f"{prefix}_target", stringOrderType="alphabetAsc", handleInvalid="keep").fit(df)
    forest = SparseForest(
        classes=len(index.labels) + 1, trees=trees, depth=depth, seed=seed, features="features", label=f"{prefix}_target",
        prediction=f"{prefix}_code", probability=f"{prefix}_probability", raw=f"{prefix}_raw",
    ).fit(index.transform(df))
    back = IndexToString(inputCol=f"{prefix}_code", outputCol=f"predicted_{prefix}", labels=index.labels + ["unknown"])
    return PipelineModel([forest, back])


def fit_text_classifiers(df: DataFrame, wanted: dict[str, tuple[str, int]], trees: int = 100, seed: int = 42) -> dict[str, PipelineModel]:
    """A text classifier for each name with its label and depth; the fits share the cluster. ``df`` is stored or persisted."""
    with ThreadPoolExecutor(max(len(wanted), 1)) as pool:
        waiting = {
            name: pool.submit(inheritable_thread_target(lambda n=name, c=label, d=depth: fit_text_classifier(df, c, n, d, trees, seed)))
            for name, (label, depth) in wanted.items()
        }
        return {name: found.result() for name, found in waiting.items()}


def score_text(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """``predicted_<name>`` and ``<name>_confidence`` for every model."""
    keep = list(df.columns)
    for name, model in models.items():
        df = model.transform(df).withColumn(f"{name}_confidence", F.array_max(vector_to_array(f"{name}_probability")))
        keep += [f"predicted_{name}", f"{name}_confidence"]
        df = df.select(*keep)
    return df


# --- dense network ----------------------------------------------------------------


def fit_dense(df: DataFrame, label: str, features: str = "features", iterations: int = 100, seed: int = 42):
    """Two-class dense network with hidden layers of 128, 64 and 32 units."""
    return DenseNetwork([128, 64, 32], iterations=iterations, features=features, label=label, seed=seed).fit(df)


def score_dense(df: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """``anomaly_score`` and ``predicted_anomaly``; works on a batch or a stream."""
    scored = model.transform(df).withColumn("anomaly_score", vector_to_array("probability")[1])
    scored = scored.withColumn("predicted_anomaly", (F.col("anomaly_score") > threshold).cast("int"))
    return scored.drop("rawPrediction", "probability", "prediction")


def parameter_count(model) -> int:
    return len(model.weights)


def first_layer_importance(spark, model, names: list[str], top: int = 15) -> DataFrame:
    """Mean absolute weight from each input to the first hidden layer."""
    width, hidden = len(names), model.getLayers()[1]
    first = np.asarray(model.weights.toArray())[: width * hidden]
    # weights are stored column by column: one block of hidden units per input
    strength = np.abs(first.reshape(width, hidden)).mean(axis=1)
    order = sorted(range(width), key=lambda i: (-strength[i], names[i]))[:top]
    return spark.createDataFrame([(names[i], float(strength[i])) for i in order], "feature string, importance double")
