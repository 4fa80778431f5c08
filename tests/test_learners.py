"""Boosting on histograms and kernel machines, compared with plain numpy."""

import math
import random

import numpy as np
import pytest
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netsieve.operators import boosting, kernel, profile
from netsieve.operators.anomaly import clusters, iforest


def schema(text):
    """Columns by name and type, vectors included."""
    out = StructType()
    for name, kind in (c.split() for c in text.split(", ")):
        out = out.add(name, VectorUDT() if kind == "vector" else {"int": "integer"}.get(kind, kind))
    return out


def table(spark, n=240, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.choice([0.0, 0.0, 1.0, 2.5, 7.0]), rng.uniform(-3, 3), float(rng.random() < 0.3)
        target = 0 if a > 2 else 1 if b + 0.3 * rng.random() > 0.5 else 2
        rows.append((i, Vectors.sparse(4, {0: a, 1: b, 2: c}) if i % 2 else Vectors.dense([a, b, c, 0.0]), float(target), i % 3))
    return spark.createDataFrame(rows, schema("id long, features vector, target double, fold int"))


def brute_boosting(x, y, bins, rounds, depth, rate, classes):
    """Scores after each round, one tree a class, every threshold tried by direct sums."""
    cells = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(bins.edges)], axis=1)
    prior = np.log(np.bincount(y, minlength=classes) / len(y))
    scores = np.tile(prior, (len(y), 1))
    for _ in range(rounds):
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        step = np.zeros_like(scores)
        for k in range(classes):
            g, h = (y == k) - p[:, k], p[:, k] * (1 - p[:, k])
            nodes = [np.arange(len(y))]
            for level in range(depth):
                after = []
                for rows in nodes:
                    whole, best = g[rows].sum() ** 2 / (h[rows].sum() + 1e-6), None
                    for f, edges in enumerate(bins.edges):
                        for b in range(len(edges)):
                            left = cells[rows, f] <= b
                            hl, hr = h[rows[left]].sum(), h[rows[~left]].sum()
                            if hl > 1e-6 and hr > 1e-6:
                                gain = g[rows[left]].sum() ** 2 / (hl + 1e-6) + g[rows[~left]].sum() ** 2 / (hr + 1e-6) - whole
                                if gain > boosting.TIE and (best is None or gain > best[0] + boosting.TIE * (1 + abs(gain))):
                                    best = gain, f, b
                    if best is None:
                        after += [rows, rows[:0]]
                    else:
                        left = cells[rows, best[1]] <= best[2]
                        after += [rows[left], rows[~left]]
                nodes = after
            for rows in nodes:
                if len(rows):
                    step[rows, k] = rate * (classes - 1) / classes * g[rows].sum() / (h[rows].sum() + 1e-6)
        scores = scores + step
    return scores


def test_boosting_equals_plain_numpy(spark, monkeypatch):
    monkeypatch.setattr(boosting, "REPLAY", 2)  # scores are stored and replayed
    monkeypatch.setattr(boosting, "ROWS", 50)  # sums of several tasks
    df = table(spark)
    learner = boosting.HistogramBoosting(rounds=5, bins=6)
    whole, parts = learner.fit_folds(df, 3)
    rows = df.orderBy("id").collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([int(r["target"]) for r in rows])
    fold = np.array([r["fold"] for r in rows])
    for model, inside in [(whole, np.ones(len(y), dtype=bool)), *((m, fold != f) for f, m in enumerate(parts))]:
        got = model.scores(model.bins.matrix(inside.sum(), *model.bins.cells(x[inside].ravel())))
        assert np.allclose(got, brute_boosting(x[inside], y[inside], model.bins, 5, 3, 0.1, 3), atol=1e-9)


def test_boosting_predicts_and_weighs_features(spark):
    df = table(spark, 600, seed=2)
    model = boosting.HistogramBoosting(rounds=30).fit(df)
    out = model.transform(df)
    assert out.columns == [*df.columns, "probability", "prediction"]
    assert out.where("prediction = target").count() >= 560
    weights = model.featureImportances.toArray()
    assert math.isclose(weights.sum(), 1) and weights[0] > weights[2] and weights[3] == 0
    totals = out.select(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)).collect()
    assert all(math.isclose(t[0], 1) for t in totals)


def test_boosting_does_not_depend_on_partitions(spark):
    df = table(spark)
    one, other = (boosting.HistogramBoosting(rounds=4).fit(d) for d in (df.coalesce(1), df.repartition(7)))
    assert (one.split == other.split).all() and (one.limit == other.limit).all() and np.allclose(one.value, other.value)


def test_boosting_of_one_class_and_of_features_that_do_not_vary(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]), 0.0)] * 5, schema("features vector, target double"))
    model = boosting.HistogramBoosting(rounds=2).fit(df)
    assert {r["prediction"] for r in model.transform(df).collect()} == {0.0}
    assert model.featureImportances.toArray().tolist() == [0, 0]


def test_bins_hold_0_on_its_own_and_cover_new_values(spark):
    df = spark.createDataFrame([(Vectors.dense([v, 0.0]),) for v in (-2.0, -1.0, 0.0, 0.0, 3.0, 4.0)], schema("features vector"))
    bins = boosting.fit_bins(df, "features")
    assert bins.edges[0].tolist() == [-2.0, -1.0, 0.0, 3.0] and bins.edges[1].tolist() == []
    row, cell = bins.cells(np.array([0.0, 5.0, 99.0, 0.0, -9.0, 0.0]))
    assert row.tolist() == [1, 2] and cell.tolist() == [4, 0]


def rings(spark, n=600):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        outer, angle = i % 2, rng.uniform(0, 2 * math.pi)
        r = (3 if outer else 1) + rng.gauss(0, 0.2)
        rows.append((i, Vectors.dense([r * math.cos(angle), 1000 * r * math.sin(angle), 7.0]), float(outer), i % 3))
    return spark.createDataFrame(rows, schema("id long, features vector, target double, fold int"))


def test_kernel_machine_separates_rings_and_is_stored(spark, tmp_path):
    df = rings(spark)
    whole, parts = kernel.KernelSVM(landmarks=60).fit_folds(df, 3)
    assert whole.transform(df).where("prediction = target").count() >= 595
    for f, part in enumerate(parts):
        out = part.transform(df.where(F.col("fold") == f))
        assert out.where("prediction = target").count() >= 195
    whole.save(spark, str(tmp_path / "machine"))
    back = kernel.KernelModel.load(spark, str(tmp_path / "machine"))
    assert [r["decision"] for r in back.transform(df).collect()] == [r["decision"] for r in whole.transform(df).collect()]


def test_map_approaches_the_exact_kernel(spark):
    df = rings(spark)
    x = np.array([r["features"].toArray() for r in df.limit(200).collect()])
    errors = [kernel.fit_nystrom(df, "features", m).error(x) for m in (5, 20, 100)]
    assert errors[0] > errors[1] > errors[2] and errors[2] < 1e-3


def test_landmarks_are_distinct_points(spark):
    hot = spark.createDataFrame([(Vectors.dense([1.0, 1.0]),)] * 50 + [(Vectors.dense([float(i), 0.0]),) for i in range(5)] + [(None,)], schema("features vector"))
    mapping = kernel.fit_nystrom(hot, "features", 4)
    assert len(np.unique(mapping.landmarks, axis=0)) == 4


def test_newton_steps_reach_the_minimum(spark):
    df = table(spark, 150).withColumn("target", (F.col("target") == 0).cast("double"))
    learner = kernel.KernelSVM(landmarks=10, tolerance=1e-8)
    model = learner.fit(df)
    rows = df.collect()
    x = kernel._with_one(model.mapping.map(np.array([r["features"].toArray() for r in rows])))
    sign = np.array([1.0 if r["target"] else -1.0 for r in rows])
    keep = np.append(np.ones(x.shape[1] - 1), 1e-8)

    def loss(w):
        return (np.maximum(1 - sign * (x @ w), 0) ** 2).sum() + 0.5 * (keep * w * w).sum()

    best = model.machines[:, 1]
    rng = np.random.default_rng(0)
    assert all(loss(best) <= loss(best + rng.normal(0, s, len(best))) for s in (1e-3, 1e-2, 1e-1) for _ in range(20))


def test_a_null_vector_has_no_decision(spark):
    df = rings(spark, 60)
    model = kernel.KernelSVM(landmarks=10).fit(df)
    out = model.transform(df.select("features").limit(1).union(spark.createDataFrame([(None,)], schema("features vector"))))
    assert sorted(r["prediction"] is None for r in out.collect()) == [False, True]


def planted(spark, k, n=900):
    rng = random.Random(k)
    centres = [(rng.uniform(-40, 40), rng.uniform(-40, 40), 5.0) for _ in range(k)]
    rows = [(i, Vectors.dense([c + rng.gauss(0, 0.5) for c in centres[i % k]])) for i in range(n)]
    return spark.createDataFrame(rows, schema("id long, features vector"))


def test_all_numbers_of_clusters_at_once_choose_like_separate_fits(spark, monkeypatch):
    scans = []
    one = clusters._scan
    monkeypatch.setattr(clusters, "_scan", lambda rows, part: scans.append(1) or one(rows, part))
    for k in (2, 4):
        df = planted(spark, k).persist()
        scans.clear()
        model, scores = clusters.choose_kmeans(df, "features")
        assert len(scans) <= clusters.ITERATIONS + 2 and sorted(scores) == list(range(2, 9))
        evaluator = ClusteringEvaluator(predictionCol="c")
        alone = {j: evaluator.evaluate(KMeans(k=j, seed=1, initSteps=5, predictionCol="c").fit(df).transform(df)) for j in (k, k + 1)}
        assert len(model.clusterCenters()) == k == max(scores, key=scores.get)
        assert math.isclose(scores[k], alone[k], rel_tol=1e-6) and alone[k] > alone[k + 1]


def test_silhouettes_equal_direct_ones(spark):
    df = planted(spark, 3, 60)
    rows = df.select(vector_to_array("features").alias("v"))
    x = np.array([r["v"] for r in rows.collect()])
    fitted = clusters.fit_centres(rows, x[:4], [2, 4])
    sums = clusters._scan(rows, clusters._silhouettes(fitted))
    for k, (centres, _) in fitted.items():
        own = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        away = ((x[:, None] - x[None]) ** 2).sum(axis=2)
        values = []
        for i in range(len(x)):
            inside = away[i, own == own[i]].sum() / max((own == own[i]).sum() - 1, 1)
            near = min(away[i, own == c].mean() for c in set(own.tolist()) - {own[i]})
            values.append(0.0 if (own == own[i]).sum() == 1 else (near - inside) / max(near, inside))
        assert math.isclose(sums[k][0] / sums[k][1], np.mean(values), rel_tol=1e-6)


def test_clusters_of_one_point_and_of_few_rows(spark, tmp_path):
    same = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 400, schema("features vector"))
    assert clusters.choose_kmeans(same, "features")[0] is None
    assert clusters.choose_kmeans(same.limit(50), "features") == (None, {})
    clusters.Centres(np.array([[0.0, 0.0], [10.0, 0.0]])).save(spark, str(tmp_path / "c"))
    back = clusters.Centres.load(spark, str(tmp_path / "c"))
    got = clusters.centroid_distance(same.limit(1).union(spark.createDataFrame([(None,), (Vectors.dense([10.0, 3.0]),)], schema("features vector"))), back, "features").collect()
    assert [r["kmeans_score"] for r in got] == [math.sqrt(5), None, 3.0]


def test_profiles_merge(spark):
    rng = random.Random(6)
    rows = [(f"f{rng.randrange(4)}", rng.choice(["h1", "h2", None]), rng.choice(["1.1.1.1", None]), rng.choice([10, None, 30])) for _ in range(200)]
    table = profile.profile_table(spark.createDataFrame(rows, "source_file string, hostname string, source_ip string, risk_score int"), ("hostname", "source_ip"))
    for by in (None, ["source_file"]):
        for r in profile.profile_totals(table, by).collect():
            own = [x for x in rows if by is None or x[0] == r["source_file"]]
            risks = [x[3] for x in own if x[3] is not None]
            assert r["total_messages"] == len(own) and r["unique_hosts"] == len({x[1] for x in own} - {None})
            assert math.isclose(r["avg_risk_score"], sum(risks) / len(risks), abs_tol=1e-6)
    tops = {(r["source_file"], r["name"]): r["n"] for r in profile.profile_top(table, "hostname", 1, ["source_file"]).collect()}
    assert len(tops) == 4 and all(n == sum(x[0] == f and x[1] == h for x in rows) for (f, h), n in tops.items())


def test_forest_samples_follow_from_the_rows(spark):
    df = planted(spark, 3, 500).select("features")
    hot = df.union(df.limit(1).crossJoin(spark.range(400).select(F.lit(1).alias("one"))).select("features"))
    draws = [sorted((r["tree"], tuple(r["values"])) for r in iforest.draw_samples(d, "features", 20, 64, 7).collect()) for d in (hot.coalesce(1), hot.repartition(9))]
    assert draws[0] == draws[1]
    sizes = np.bincount([t for t, _ in draws[0]], minlength=20)
    assert sizes.tolist() == [64] * 20
    # the hot row makes up 401 of 900
    point = tuple(float(x) for x in df.first()["features"])
    share = sum(v == point for _, v in draws[0]) / len(draws[0])
    assert 0.38 < share < 0.52


def test_poisson_numbers_have_their_mean_and_variance():
    h = np.arange(20_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for mean in (0.01, 1.0, 30.0, 500.0):
        got = iforest._poisson(np.full(len(h), mean), h, 3)
        assert abs(got.mean() - mean) < 5 * (mean / len(h)) ** 0.5 and (mean < 1 or abs(got.var() / mean - 1) < 0.1)
    assert iforest._poisson(np.zeros(3), h[:3], 1).tolist() == [0, 0, 0]


def test_forest_scores_once_for_threshold_and_flags(spark):
    df = planted(spark, 2, 300).select("id", "features")
    model, flagged = iforest.fit_predict(df, "features", 0.05, trees=30)
    again = iforest.fit_isolation_forest(df, "features", 0.05, trees=30)
    assert model.threshold == again.threshold
    assert sorted(flagged.select("id", "isolation_forest_anomaly").collect()) == sorted(again.predict(df, "features").select("id", "isolation_forest_anomaly").collect())


def levels(spark, monkeypatch):
    """Storage levels that tables are persisted with from now on, in order."""
    frame = type(spark.range(0))
    found, persist = [], frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, level=StorageLevel.MEMORY_AND_DISK_DESER: (found.append(level), persist(self, level))[1])
    return found


def test_forest_keeps_vectors_and_blocks_of_bytes_out_of_memory(spark, monkeypatch):
    df = planted(spark, 2, 300).select("id", "features")
    model, flagged = iforest.fit_predict(df, "features", 0.05, trees=30)
    found = levels(spark, monkeypatch)
    again, narrow = iforest.fit_predict(df, "features", 0.05, trees=30, keep=["id"])
    assert found == [StorageLevel.DISK_ONLY, StorageLevel.MEMORY_AND_DISK_DESER]
    assert narrow.columns == ["id", "isolation_forest_score", "isolation_forest_anomaly"] and again.threshold == model.threshold
    assert sorted(narrow.collect()) == sorted(flagged.select(narrow.columns).collect())


def test_cluster_sums_are_products():
    rng = np.random.default_rng(2)
    x, c = rng.normal(size=(20_000, 70)), rng.normal(size=(9, 70))
    own = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
    sums = dict(clusters._cluster_sums({9: c})(x))[9].reshape(9, -1)
    assert np.allclose(sums[:, 0], np.bincount(own, minlength=9))
    assert np.allclose(sums[:, 2:], [x[own == k].sum(axis=0) for k in range(9)])
    assert np.allclose(sums[:, 1], [(x[own == k] ** 2).sum() for k in range(9)])


def test_nodes_without_a_split_send_all_rows_to_the_left():
    rng = np.random.default_rng(4)
    matrix, trees = rng.integers(0, 32, (5000, 80)).astype(np.int32), 40
    split, limit, value = rng.integers(-1, 80, (trees, 7)), rng.integers(0, 31, (trees, 7)), rng.normal(size=(trees, 8))
    got = boosting._leaf_values(matrix, split, limit, value)
    for i in range(0, 5000, 271):
        for t in range(trees):
            node = 0
            for _ in range(3):
                node = 2 * node + 1 + int(split[t, node] >= 0 and matrix[i, split[t, node]] > limit[t, node])
            assert got[i, t] == value[t, node - 7]
