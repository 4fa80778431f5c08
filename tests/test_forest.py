"""The forest on sparse rows against brute force and Spark's forest."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from netsieve.operators import classify, forest
from netsieve.operators.boosting import Bins


def _rows(n, width, seed=3):
    """Sparse and dense vectors; the class follows two features, a tenth of the rows has another."""
    rng = np.random.default_rng(seed)
    x = np.where(rng.random((n, width)) < 0.3, rng.integers(-2, 6, (n, width)), 0).astype(float)
    y = np.where(rng.random(n) < 0.1, rng.integers(0, 3, n), (x[:, 0] > 1) + (x[:, 1] > 0))
    vectors = [Vectors.dense(r) if i % 3 else Vectors.sparse(width, [(int(j), float(r[j])) for j in np.flatnonzero(r)]) for i, r in enumerate(x)]
    return x, y.astype(int), vectors


@pytest.fixture(scope="module")
def data(spark):
    x, y, vectors = _rows(1_500, 9)
    return x, y, spark.createDataFrame([(i, v, "abc"[k], float(k)) for i, (v, k) in enumerate(zip(vectors, y.tolist()))], ["id", "features", "label", "target"]).repartition(3).persist()


def _same(a, b):
    return all(a.getOrDefault(p) == b.getOrDefault(p) for p in ("feature", "limit", "left", "share", "importance"))


def test_best_splits_equal_a_search_over_all_limits():
    rng = np.random.default_rng(1)
    bins = Bins([np.array([0.5, 1.5, 2.5]), np.zeros(0), np.array([-0.5, 0.5])])
    x, y, node = rng.integers(-1, 4, (60, 3)).astype(float), rng.integers(0, 3, 60), rng.integers(0, 2, 60)
    cells, keys = int(bins.start[-1]), []
    for r, k, n in zip(x, y, node):
        own = [bins.start[f] + np.searchsorted(bins.edges[f], v) for f, v in enumerate(r) if np.searchsorted(bins.edges[f], v) != bins.usual[f]]
        keys += [(n * (cells + 1) + c) * 3 + k for c in [*own, cells]]
    nodes, total, feature, limit, left, gain = forest.best_splits(*forest._added([np.array(keys)], [np.ones(len(keys))]), bins, 3)

    def gini(k):
        return 1 - ((np.bincount(k, minlength=3) / len(k)) ** 2).sum()

    assert nodes.tolist() == [0, 1]
    for n in (0, 1):
        own, best = node == n, (0, None)
        for f, edges in enumerate(bins.edges):
            for b, edge in enumerate(edges):
                low = own & (x[:, f] <= edge)
                if 0 < low.sum() < own.sum():
                    drop = gini(y[own]) - (low.sum() * gini(y[low]) + (own & ~low).sum() * gini(y[own & ~low])) / own.sum()
                    best = max(best, (drop, (f, b)), key=lambda z: round(z[0], 12))
        assert gain[n] == pytest.approx(best[0]) and (feature[n], limit[n]) == best[1]
        assert total[n].tolist() == np.bincount(y[own], minlength=3).tolist()
        assert left[n].tolist() == np.bincount(y[own & (x[:, feature[n]] <= bins.edges[feature[n]][limit[n]])], minlength=3).tolist()


def test_a_node_without_a_gain_is_a_leaf():
    bins = Bins([np.array([0.5])])
    # both classes have the same shares on both sides
    keys = [((0 * 3 + 1) * 2 + k) for k in (0, 1)] + [((0 * 3 + 2) * 2 + k) for k in (0, 1)]
    _, total, feature, *_ = forest.best_splits(np.array(keys), np.array([1, 2, 3, 6]), bins, 2)
    assert total.tolist() == [[3, 6]] and feature.tolist() == [-1]


def test_thresholds_lie_between_values():
    assert forest.thresholds(np.array([-1.0, 2.0]), np.array([1, 1]), 3, 32).tolist() == [-0.5, 1.0]
    assert forest.thresholds(np.array([4.0]), np.array([5]), 0, 32).tolist() == []
    assert forest.thresholds(np.arange(1.0, 101.0), np.ones(100, dtype=int), 0, 4).tolist() == [25.5, 50.5, 75.5]


def test_drawn_features_differ_and_are_as_likely():
    drawn = forest.drawn_features(5_000, 10, 4, [1, 2, 3])
    assert all(len(set(d)) == 4 for d in drawn.tolist())
    assert np.abs(np.bincount(drawn.ravel(), minlength=10) / 5_000 - 0.4).max() < 0.04
    assert forest.drawn_features(2, 30, 30, [1]).tolist() == [list(range(30))] * 2


def test_forest_agrees_with_sparks_forest(spark, data):
    _, _, df = data
    theirs = RandomForestClassifier(numTrees=150, maxDepth=6, seed=5, featuresCol="features", labelCol="target").fit(df)
    ours = forest.SparseForest(3, trees=150, depth=6, seed=5).fit(df)
    p, q = (
        {r[0]: (r[1], r[2], r[3]) for r in m.transform(df).select("id", vector_to_array("probability"), "prediction", vector_to_array("rawPrediction")).collect()}
        for m in (theirs, ours)
    )
    gap = np.array([np.abs(np.subtract(p[i][0], q[i][0])).max() for i in p])
    assert len(gap) == 1_500 and gap.mean() < 0.03 and np.mean([p[i][1] == q[i][1] for i in p]) > 0.97
    assert all(sum(q[i][2]) == pytest.approx(150) and sum(q[i][0]) == pytest.approx(1) for i in q)
    assert np.abs(theirs.featureImportances.toArray() - ours.featureImportances.toArray()).max() < 0.05


def test_passes_and_stored_places_do_not_change_the_trees(data, monkeypatch):
    _, _, df = data
    fit = lambda: forest.SparseForest(3, trees=6, depth=5).fit(df)
    whole = fit()
    monkeypatch.setattr(forest, "COUNTS", 1)  # one node of each tree in a pass
    monkeypatch.setattr(forest, "REPLAY", 1)
    assert _same(whole, fit())


def test_text_classifier_is_stored_and_keeps_labels(spark, data, tmp_path):
    _, _, df = data
    df = df.withColumn("label", F.when(F.col("id") % 50 > 0, F.col("label")))
    model = classify.fit_text_classifier(df, "label", "kind", depth=4, trees=8)
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    one, two = (classify.score_text(df.select("id", "features"), {"kind": m}).orderBy("id").collect() for m in (model, again))
    assert one == two and {r["predicted_kind"] for r in one} <= {"a", "b", "c", "unknown"}
    assert len(model.transform(df).first()["kind_probability"]) == 4  # null is a class of its own


def test_wide_rows_take_the_room_of_their_values(spark):
    # Spark's forest keeps a number for each of the 50,000 features of a row: 100 MB here
    width, n = 50_000, 500
    df = spark.range(n).rdd.map(lambda r: (Vectors.sparse(width, sorted({r[0] % 7, 100 + r[0] * 31 % 40_000}), [1.0, 2.0][: len({r[0] % 7, 100 + r[0] * 31 % 40_000})]), r[0] % 7)).toDF(["features", "target"])
    bins = forest.fit_thresholds(df, "features", width, n, 32, 1)
    blocks = forest._blocks(df, bins, n, "features", "target", 7, 10, 1).persist()
    assert blocks.select(F.sum(sum(F.length(c) for c in forest.BLOCK))).first()[0] < 2_000_000
    train = df.persist()
    model = forest.SparseForest(7, trees=5, depth=3).fit(train)
    assert model.transform(train).count() == n
