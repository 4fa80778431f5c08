"""Saving and loading fitted detectors; load if stored, else fit and store."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCAModel
from pyspark.sql import SparkSession

from netsieve.operators.anomaly.clusters import Centres
from netsieve.operators.anomaly.iforest import IsolationForest
from netsieve.operators.anomaly.ocsvm import OneClassSVM
from netsieve.operators.vectorise import RecordVectorizerModel
from netsieve.plans.anomaly import Detector


def save_detector(spark: SparkSession, detector: Detector, path: str) -> None:
    detector.scaler.write().overwrite().save(f"{path}/scaler")
    if detector.vectorizer:
        detector.vectorizer.write().overwrite().save(f"{path}/vectorizer")
    for name, model in detector.models.items():
        if name in ("isolation_forest", "one_class_svm", "kmeans"):
            model.save(spark, f"{path}/{name}")
        elif name != "dbscan":
            model.write().overwrite().save(f"{path}/{name}")
    # written last: its presence says that the rest is complete
    meta = {"contamination": detector.contamination, "names": detector.names, "dbscan": detector.models.get("dbscan"), "vectorizer": detector.vectorizer is not None}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_detector(spark: SparkSession, path: str) -> Detector:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    loaders = {
        "isolation_forest": lambda p: IsolationForest.load(spark, p),
        "one_class_svm": lambda p: OneClassSVM.load(spark, p),
        "kmeans": lambda p: Centres.load(spark, p),
        "pca": PCAModel.load,
    }
    models = {n: meta["dbscan"] if n == "dbscan" else loaders[n](f"{path}/{n}") for n in meta["names"]}
    vectorizer = RecordVectorizerModel.load(f"{path}/vectorizer") if meta.get("vectorizer") else None
    return Detector(meta["contamination"], PipelineModel.load(f"{path}/scaler"), models, vectorizer)


def load_or_fit(spark: SparkSession, path: str, fit: Callable[[], Detector]) -> Detector:
    """The stored detector; only a path without one is fitted and written, other errors pass."""
    try:
        spark.read.text(f"{path}/meta")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        detector = fit()
        save_detector(spark, detector, path)
        return detector
    return load_detector(spark, path)
