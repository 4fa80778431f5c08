"""K-means with a chosen number of clusters, all numbers trained together, and distance flags."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from netsieve.operators.anomaly.thresholds import flag_above

SAMPLE = 2_000  # distinct points that the first centres are drawn from
ITERATIONS = 20
MOVED = 1e-4  # a centre that moves less has arrived


class Centres:
    """Fitted centres, a row each."""

    def __init__(self, centres: np.ndarray):
        self.centres = centres

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 - the name that Spark's model uses
        return list(self.centres)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(self.centres.tolist()),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Centres:
        return cls(np.array(json.loads(spark.read.text(path).first()[0])))


def cluster_range(n: int) -> range:
    return range(2, min(10, n // 100))


def choose_kmeans(df: DataFrame, features: str, seed: int = 42) -> tuple[Centres | None, dict[int, float]]:
    """Best centres by silhouette over 2..9 clusters; None without a positive one.

    All numbers of clusters are trained together: an iteration is one pass that sums per number and
    cluster, and one last pass takes the silhouettes of all. First centres are drawn far
    apart from ``SAMPLE`` distinct points. The silhouette is the squared-Euclidean one, which
    needs cluster sums only.
    """
    numbers = cluster_range(df.count())
    if not len(numbers):
        return None, {}
    rows = df.where(F.col(features).isNotNull()).select(vector_to_array(features).alias("v"))
    fitted = fit_centres(rows, _first_centres(rows, max(numbers), seed), numbers)
    sums = _scan(rows, _silhouettes(fitted))
    # one cluster that holds all rows has no silhouette
    scores = {k: float(sums[k][0] / sums[k][1]) if (fitted[k][1][:, 0] > 0).sum() > 1 else -1.0 for k in fitted}
    best = max(scores, key=lambda k: (scores[k], -k), default=None)
    if best is None:  # a single point
        return None, scores
    return (Centres(fitted[best][0]) if scores[best] > 0 else None), scores


def fit_centres(rows: DataFrame, first: np.ndarray, numbers) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Centres and cluster sums (size, sum of squares, sums) by number of clusters, from the ``first`` points on."""
    centres = {k: first[:k].copy() for k in numbers if k <= len(first)}
    open_, sums = set(centres), {}
    for step in range(ITERATIONS + 1):
        found = _scan(rows, _cluster_sums({k: centres[k] for k in open_}))
        for k, part in found.items():
            sums[k] = part.reshape(k, -1)
            if step == ITERATIONS:
                continue
            size = sums[k][:, :1]
            moved = np.where(size > 0, sums[k][:, 2:] / np.maximum(size, 1), centres[k])
            if np.linalg.norm(moved - centres[k], axis=1).max() <= MOVED:
                open_.discard(k)
            else:
                centres[k] = moved
        if not open_:
            break
    return {k: (centres[k], sums[k]) for k in centres}


def _first_centres(rows: DataFrame, n: int, seed: int) -> np.ndarray:
    """Up to ``n`` distinct points, each drawn with its squared distance to those before as weight."""
    hashed = rows.withColumn("h", F.xxhash64("v", F.lit(seed)))
    smallest = [r["h"] for r in hashed.groupBy("h").count().orderBy("h").limit(SAMPLE).collect()]
    chosen = rows.sparkSession.createDataFrame([(h,) for h in smallest], "h long")
    found = hashed.join(F.broadcast(chosen), "h").groupBy("h").agg(F.first("v").alias("v")).orderBy("h").collect()
    points, rng = np.array([r["v"] for r in found], dtype=float), np.random.default_rng(seed)
    out, far = [points[rng.integers(len(points))]], None
    while len(out) < n:
        away = ((points - out[-1]) ** 2).sum(axis=1)
        far = away if far is None else np.minimum(far, away)
        if not far.sum():
            break
        out.append(points[rng.choice(len(points), p=far / far.sum())])
    return np.array(out)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2.0 * (x @ centres.T), 0)


def _cluster_sums(centres: dict[int, np.ndarray]):
    def part(x):
        summed = np.concatenate([np.ones((len(x), 1)), (x * x).sum(axis=1)[:, None], x], axis=1)
        for k, c in centres.items():
            own = _squares(x, c).argmin(axis=1)
            yield k, ((own == np.arange(k)[:, None]).astype(float) @ summed).ravel()

    return part


def _silhouettes(fitted: dict[int, tuple[np.ndarray, np.ndarray]]):
    """Sums and number of the points' silhouettes, from sums of the clusters alone."""

    def part(x):
        for k, (centres, sums) in fitted.items():
            own, rows = _squares(x, centres).argmin(axis=1), np.arange(len(x))
            size = np.maximum(sums[:, 0], 1)
            # mean squared distance to the points of each cluster
            away = (x * x).sum(axis=1)[:, None] + (sums[:, 1] / size)[None, :] - 2.0 * (x @ (sums[:, 2:] / size[:, None]).T)
            alone = size[own] <= 1
            inside = away[rows, own] * size[own] / np.maximum(size[own] - 1, 1)
            away[rows, own] = np.inf
            away[:, sums[:, 0] == 0] = np.inf
            near = away.min(axis=1)
            largest = np.maximum(inside, near)
            value = np.where(alone | (largest <= 0) | ~np.isfinite(near), 0.0, (near - inside) / np.where(largest > 0, largest, 1))
            yield k, np.array([value.sum(), len(x)])

    return part


def _scan(rows: DataFrame, part) -> dict[int, np.ndarray]:
    """One pass over the points: the sums of ``part``, by number of clusters."""

    def run(batches):
        added: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                for k, values in part(x):
                    added[k] = added[k] + values if k in added else values
        yield _batch(added)

    def add(batches):
        added: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                added[k] = added[k] + np.array(values) if k in added else np.array(values)
        yield _batch(added)

    sums = rows.mapInArrow(run, "k int, sums array<double>").repartition("k").mapInArrow(add, "k int, sums array<double>")
    return {r["k"]: np.array(r["sums"]) for r in sums.collect()}


def _batch(added: dict[int, np.ndarray]) -> pa.RecordBatch:
    arrays = [pa.array(list(added), pa.int32()), pa.array([v.tolist() for v in added.values()], pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays(arrays, ["k", "sums"])


def centroid_distance(df: DataFrame, model: Centres, features: str, out: str = "kmeans_score") -> DataFrame:
    """Distance of each row to the nearest centre; a null vector has none."""
    centres = model.centres

    @F.arrow_udf(DoubleType())
    def distance(values: pa.Array) -> pa.Array:
        x = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, centres.shape[1])
        nearest = _squares(x, centres).argmin(axis=1)
        valid = values.is_valid().to_numpy(zero_copy_only=False)
        found = np.zeros(len(values))
        found[valid] = np.sqrt(((x - centres[nearest]) ** 2).sum(axis=1))
        return pa.array(found, mask=~valid)

    return df.withColumn(out, distance(F.when(F.col(features).isNotNull(), vector_to_array(features))))


def kmeans_flags(df: DataFrame, model: Centres, features: str, contamination: float) -> DataFrame:
    scored = centroid_distance(df, model, features)
    return flag_above(scored, "kmeans_score", "kmeans_anomaly", 1 - contamination)
