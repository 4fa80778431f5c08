"""Principal components: reconstruction error, component report, 2-D projection."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.operators.anomaly.thresholds import flag_above


def fit_pca(df: DataFrame, features: str, most: int = 10) -> PCAModel:
    width = len(df.select(features).first()[0])
    return PCA(k=min(most, width), inputCol=features, outputCol="components").fit(df)


def _squared(vector: str):
    return F.aggregate(vector_to_array(vector), F.lit(0.0), lambda s, v: s + v * v)


def reconstruction_error(df: DataFrame, model: PCAModel, features: str, out: str = "pca_score") -> DataFrame:
    """Centred rows and an orthonormal basis: the error is the length lost, squared."""
    projected = model.transform(df)
    return projected.withColumn(out, F.greatest(_squared(features) - _squared("components"), F.lit(0.0))).drop("components")


def pca_flags(df: DataFrame, model: PCAModel, features: str, contamination: float) -> DataFrame:
    return flag_above(reconstruction_error(df, model, features), "pca_score", "pca_anomaly", 1 - contamination)


def component_report(df: DataFrame, features: str, names: list[str], top: int = 5, first: int = 3) -> DataFrame:
    """``(item, component, feature, value)``: components for 95 % of the variance, the share of
    the first five, and the strongest loadings of the first three."""
    model = fit_pca(df, features)
    shares = np.asarray(model.explainedVariance.toArray())
    loadings = model.pc.toArray()
    rows = [
        ("components_95", None, None, float((np.cumsum(shares) <= 0.95).sum() + 1)),
        ("variance_first_5", None, None, float(shares[:5].sum())),
    ]
    for c in range(min(first, loadings.shape[1])):
        rows.append(("variance", c + 1, None, float(shares[c])))
        for i in np.argsort(-np.abs(loadings[:, c]))[:top]:
            rows.append(("loading", c + 1, names[i], float(loadings[i, c])))
    return df.sparkSession.createDataFrame(rows, "item string, component int, feature string, value double")


def project_2d(df: DataFrame, features: str) -> DataFrame:
    model = PCA(k=2, inputCol=features, outputCol="_xy").fit(df)
    xy = vector_to_array("_xy")
    return model.transform(df).withColumns({"x": xy[0], "y": xy[1]}).drop("_xy")
