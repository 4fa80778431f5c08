"""Queries of models: how they read their input, and the dense network."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors

from checks import models
from netsieve.operators import classify, network


def test_lines_are_dealt_out_before_they_are_cleaned(spark, sf, monkeypatch):
    parts = []

    def clean(lines, options, original=models.clean):
        parts.append(lines.rdd.getNumPartitions())
        return original(lines, options)

    monkeypatch.setattr(models, "clean", clean)
    columns = ["line_no", "id", "message", "event_category", "risk_score"]
    rows = models.cleaned_once(spark, sf).select(columns).collect()
    assert parts == [4] and rows
    assert sorted(rows) == sorted(models.cleaned(spark, sf).select(columns).collect())


def labelled(spark, n=1000):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 6))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 1)).astype(float)
    # one part of whole blocks, as Spark's network gives a short block the weight of a whole one
    return spark.createDataFrame([(Vectors.dense(v), float(t)) for v, t in zip(x, y)], ["features", "target"]).coalesce(1)


def test_gradient_of_the_network_is_the_slope_of_its_loss():
    rng, layers = np.random.default_rng(5), [4, 5, 3, 2]
    x, y = rng.normal(size=(20, 4)), rng.integers(0, 2, 20)
    w = rng.normal(size=4 * 5 + 5 + 5 * 3 + 3 + 3 * 2 + 2)
    loss, grad = network.loss_and_gradient(x, y, w, layers)
    for k in range(len(w)):
        moved = [network.loss_and_gradient(x, y, w + s * np.eye(len(w))[k], layers)[0] for s in (1e-5, -1e-5)]
        assert abs((moved[0] - moved[1]) / 2e-5 - grad[k]) < 1e-5


def test_network_ends_where_that_of_spark_ends(spark):
    df = labelled(spark, 1024)
    for steps, error in ((0, 0), (1, 1e-6), (8, 1e-3)):
        want = MultilayerPerceptronClassifier(layers=[6, 8, 4, 2], labelCol="target", maxIter=steps, seed=7).fit(df)
        got = network.DenseNetwork([8, 4], iterations=steps, seed=7).fit(df.repartition(3))
        assert got.getLayers() == want.getLayers()
        assert np.abs(got.weights.toArray() - want.weights.toArray()).max() <= error


def test_network_is_trained_without_stacking_rows_in_the_jvm(spark, monkeypatch):
    # the rows that Spark's own network sees: one, as it only holds the weights
    seen = []
    fit = MultilayerPerceptronClassifier.fit
    monkeypatch.setattr(MultilayerPerceptronClassifier, "fit", lambda self, df, *a: (seen.append(df.count()), fit(self, df, *a))[1])
    model = classify.fit_dense(labelled(spark, 300), "target", iterations=2)
    assert seen and max(seen) == 1
    assert model.getLayers() == [6, 128, 64, 32, 2]


def test_network_refuses_labels_and_values_it_cannot_take(spark):
    for row in ((Vectors.dense([1.0, 2.0]), 2.0), (Vectors.dense([1.0, float("nan")]), 1.0)):
        df = spark.createDataFrame([(Vectors.dense([0.0, 1.0]), 0.0), row], ["features", "target"])
        with pytest.raises(Exception, match="must"):
            classify.fit_dense(df, "target", iterations=1)
