"""Batch anomaly detection: scaled features, five detectors, vote, evaluation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.operators import encode
from netsieve.operators.anomaly import clusters, components, density, iforest, ocsvm, thresholds
from netsieve.operators.vectorise import RecordVectorizer, RecordVectorizerModel

ALL_MODELS = ("isolation_forest", "one_class_svm", "dbscan", "kmeans", "pca")


def log_vectors(df: DataFrame, keep: list[str], ts: str = "ts", model: RecordVectorizerModel | None = None) -> tuple[DataFrame, list[str]]:
    """Vectors of the 18 log features and up to 50 TF-IDF terms, with their names.

    ``model`` was fitted on other rows, as :func:`fit_vectorizer` does; without one it is
    fitted on ``df`` itself.
    """
    model = model or fit_vectorizer(df, "log", ts)
    return model.transform(df).select(*keep, "features"), model.names


def flow_vectors(df: DataFrame, keep: list[str], ts: str = "ts", model: RecordVectorizerModel | None = None) -> tuple[DataFrame, list[str]]:
    model = model or fit_vectorizer(df, "flow", ts)
    return model.transform(df).select(*keep, "features"), model.names


def fit_vectorizer(df: DataFrame, kind: str, ts: str = "ts") -> RecordVectorizerModel:
    """Codes and terms of ``log`` or ``flow`` records."""
    return RecordVectorizer(kind=kind, tsCol=ts).fit(df)


@dataclass
class Detector:
    """Fitted models of one record type."""

    contamination: float
    scaler: PipelineModel
    models: dict = field(default_factory=dict)
    vectorizer: RecordVectorizerModel | None = None

    @property
    def names(self) -> list[str]:
        return [m for m in ALL_MODELS if m in self.models]

    def scale(self, df: DataFrame) -> DataFrame:
        return self.scaler.transform(df).drop("_scaled")

    def detect(self, df: DataFrame) -> DataFrame:
        """One wide row per input row: a flag (and a score) per model, then the vote.

        With a vectoriser rows are records; without one they hold ``features``.
        """
        rows = self.scale(self.vectorizer.transform(df) if self.vectorizer else df)
        for name in self.names:
            model = self.models[name]
            if name in ("isolation_forest", "one_class_svm"):
                rows = model.predict(rows, "scaled")
            elif name == "dbscan":
                rows = density.density_noise(rows, "scaled", **model)
            elif name == "kmeans":
                rows = clusters.kmeans_flags(rows, model, "scaled", self.contamination)
            else:
                rows = components.pca_flags(rows, model, "scaled", self.contamination)
        return thresholds.vote(rows, [f"{n}_anomaly" for n in self.names])


def fit_record_detector(df: DataFrame, kind: str, ts: str = "ts", **settings) -> Detector:
    """A detector that takes records of one kind: vectoriser, scaler and models are fitted on ``df``."""
    vectorizer = fit_vectorizer(df, kind, ts)
    out = fit_detector(vectorizer.transform(df).select("features"), **settings)
    out.vectorizer = vectorizer
    return out


def fit_detector(df: DataFrame, contamination: float = 0.05, models=ALL_MODELS, seed: int = 42) -> Detector:
    """Fit the named models on a table with a ``features`` vector."""
    # the scaler and the scaled rows read the features several times: find them once, on disk, as vectors would fill the memory
    rows = df if df.is_cached else df.select("features").persist(StorageLevel.DISK_ONLY)
    scaler = encode.fit_population_scaler(rows)
    out = Detector(contamination, scaler)
    scaled = out.scale(rows).select("scaled").persist(StorageLevel.DISK_ONLY)
    try:
        scaled.count()
        if rows is not df:
            rows.unpersist()
        if "isolation_forest" in models:
            out.models["isolation_forest"] = iforest.fit_isolation_forest(scaled, "scaled", contamination, seed=seed)
        if "one_class_svm" in models:
            out.models["one_class_svm"] = ocsvm.fit_one_class_svm(scaled, "scaled", contamination, seed=seed)
        if "dbscan" in models:
            # nothing to fit: the flag is found anew on the rows being scored
            out.models["dbscan"] = {"eps": 0.5, "min_points": 5}
        if "kmeans" in models:
            best, _ = clusters.choose_kmeans(scaled, "scaled", seed)
            if best is not None:
                out.models["kmeans"] = best
        if "pca" in models:
            out.models["pca"] = components.fit_pca(scaled, "scaled")
    finally:
        scaled.unpersist()
    return out
