"""Kernel support vectors: a Nyström feature map and linear machines for all classes and folds at once."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsieve.session import Scratch

LANDMARKS = 200
STEPS = 0.5 ** np.arange(10)  # step lengths that a line search tries together
ROWS = 5_000  # rows of a task while machines are trained


@dataclass
class NystromMap:
    """``k(x, landmarks) @ weights`` for the kernel exp(-gamma |x - y|^2); products of two images approach the kernel.

    Values are standardised first; ``landmarks`` are so already.
    """

    landmarks: np.ndarray
    weights: np.ndarray
    gamma: float
    centre: np.ndarray
    scale: np.ndarray

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) / self.scale

    def kernel(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
        return np.exp(-self.gamma * np.maximum(square, 0))

    def map(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(self.standard(x), self.landmarks) @ self.weights

    def error(self, x: np.ndarray) -> float:
        """Mean absolute difference to the exact kernel over all pairs of the rows ``x``."""
        image = self.map(x)
        x = self.standard(x)
        return float(np.abs(image @ image.T - self.kernel(x, x)).mean())


def fit_nystrom(df: DataFrame, features: str, landmarks: int = LANDMARKS, gamma: float | None = None, seed: int = 42) -> NystromMap:
    """Landmarks are ``landmarks`` distinct points, those with the smallest hashes.

    Values are standardised by mean and population deviation, a constant feature is only centred;
    ``gamma`` is by default one over the number of features that vary. One pass for the
    moments, a top-k of hashes and one pass for the landmarks, which alone come to the driver.
    Null vectors don't count.
    """
    rows = df.where(F.col(features).isNotNull())
    moments = rows.agg(Summarizer.metrics("count", "mean", "variance").summary(F.col(features)).alias("s")).first()["s"]
    n, centre = moments["count"], moments["mean"].toArray()
    deviation = np.sqrt(moments["variance"].toArray() * max(n - 1, 0) / max(n, 1))
    scale = np.where(deviation > 0, deviation, 1.0)
    rows = rows.select(vector_to_array(features).alias("v")).withColumn("h", F.xxhash64("v", F.lit(seed)))
    smallest = [r["h"] for r in rows.groupBy("h").count().orderBy("h").limit(landmarks).collect()]
    chosen = rows.where(F.col("h").isin(smallest)).groupBy("h").agg(F.first("v").alias("v")).orderBy("h").collect()
    out = NystromMap(np.zeros(0), np.zeros(0), gamma or 1.0 / max(int((deviation > 0).sum()), 1), centre, scale)
    out.landmarks = out.standard(np.array([r["v"] for r in chosen], dtype=float))
    values, vectors = np.linalg.eigh(out.kernel(out.landmarks, out.landmarks))
    held = values > 1e-10 * values.max(initial=0)
    out.weights = vectors[:, held] / np.sqrt(values[held])
    return out


class KernelModel:
    """One machine a class over the mapped features; the largest value decides."""

    def __init__(self, features: str, mapping: NystromMap, machines: np.ndarray):
        self.features, self.mapping, self.machines = features, mapping, machines

    def decide(self, x: np.ndarray) -> np.ndarray:
        return _with_one(self.mapping.map(x)) @ self.machines

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``decision``, an array by class, and ``prediction``; a null vector has none."""
        model = self

        @F.arrow_udf("array<double>")
        def decision(values: pa.Array) -> pa.Array:
            valid = values.is_valid().to_numpy(zero_copy_only=False)
            width = model.mapping.landmarks.shape[1]
            out = model.decide(values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
            ends = np.cumsum(valid, dtype=np.int32) * out.shape[1]
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32), mask=np.append(~valid, False))
            return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))

        out = df.withColumn("decision", decision(F.when(F.col(self.features).isNotNull(), vector_to_array(self.features))))
        return out.withColumn("prediction", (F.array_position("decision", F.array_max("decision")) - 1).cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        m = self.mapping
        state = {"features": self.features, "gamma": m.gamma, "landmarks": m.landmarks.tolist(), "weights": m.weights.tolist(), "centre": m.centre.tolist(), "scale": m.scale.tolist(), "machines": self.machines.tolist()}
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> KernelModel:
        s = json.loads(spark.read.text(path).first()[0])
        mapping = NystromMap(np.array(s["landmarks"]), np.array(s["weights"]), s["gamma"], np.array(s["centre"]), np.array(s["scale"]))
        return cls(s["features"], mapping, np.array(s["machines"]))


class KernelSVM:
    """Support vectors with the Gaussian kernel, one class against the rest, squared hinge loss.

    ``cost`` weighs the loss against half the squared length of the weights, as in the usual
    machine. The machines of all classes and folds take Newton steps together: a pass sums
    value, slope and curvature for each, another one tries ten step lengths at once.
    """

    def __init__(self, landmarks=LANDMARKS, gamma=None, cost=1.0, steps=30, tolerance=1e-3, features="features", label="target", seed=42):
        self.landmarks, self.gamma, self.cost, self.steps, self.tolerance = landmarks, gamma, cost, steps, tolerance
        self.features, self.label, self.seed = features, label, seed

    def fit(self, train: DataFrame) -> KernelModel:
        return self.fit_folds(train, 0)[0]

    def fit_folds(self, train: DataFrame, folds: int, fold: str = "fold") -> tuple[KernelModel, list[KernelModel]]:
        """The model of all rows, and one of each fold, trained without it; all share the landmarks."""
        mapping = fit_nystrom(train, self.features, self.landmarks, self.gamma, self.seed)
        with Scratch(train.sparkSession) as scratch:
            rows = train.where(F.col(self.features).isNotNull())
            own = F.col(fold).cast("int") if folds else F.lit(-2)
            rows = rows.select(vector_to_array(self.features).alias("values"), F.col(self.label).cast("int").alias("target"), own.alias("fold"))
            n, last = rows.agg(F.count("*"), F.max("target")).first()
            rows = rows.repartition(max(-(-n // ROWS), 1)).mapInArrow(_mapped(mapping), "image array<double>, target int, fold int")
            machines = self._train(scratch.store(rows), mapping.weights.shape[1] + 1, folds + 1, (last or 0) + 1)
        models = [KernelModel(self.features, mapping, m) for m in machines]
        return models[0], models[1:]

    def _train(self, rows: DataFrame, width: int, jobs: int, classes: int) -> np.ndarray:
        n, cost = jobs * classes, self.cost
        keep = np.append(np.ones(width - 1), 1e-8)  # the constant is all but free
        weights, open_, first = np.zeros((n, width)), np.arange(n), None
        for _ in range(self.steps):
            held = weights[open_]

            def curvature(batches, held=held, open_=open_):
                grad, hess = np.zeros((len(open_), width)), np.zeros((len(open_), width, width))
                for x, sign, inside in _blocks(batches, jobs, classes, open_):
                    short = np.maximum(1 - sign * (x @ held.T), 0) * inside
                    grad -= 2 * cost * (sign * short).T @ x
                    for t in range(len(open_)):
                        active = x[short[:, t] > 0]
                        hess[t] += 2 * cost * active.T @ active
                blobs = [np.concatenate([g, h.ravel()]).tobytes() for g, h in zip(grad, hess, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(open_), pa.array(blobs, pa.binary())], ["machine", "sums"])

            def solve(batches, held=held, open_=open_):
                for machine, sums in _added(batches):
                    w = held[np.searchsorted(open_, machine)]
                    grad = sums[:width] + keep * w
                    step = np.linalg.solve(sums[width:].reshape(width, width) + np.diag(keep), -grad)
                    yield _vector_batch(machine, np.append(step, np.linalg.norm(grad)))

            found = rows.mapInArrow(curvature, "machine long, sums binary").repartition(len(open_), "machine")
            found = {r["machine"]: np.array(r["v"]) for r in found.mapInArrow(solve, "machine long, v array<double>").collect()}
            steps, slope = np.array([found[t][:-1] for t in open_]), np.array([found[t][-1] for t in open_])
            first = slope.copy() if first is None else first
            going = slope > self.tolerance * np.maximum(first[open_], 1e-12)
            if not going.any():
                break
            open_, held, steps = open_[going], held[going], steps[going]

            def losses(batches, held=held, steps=steps, open_=open_):
                out = np.zeros((len(open_), len(STEPS)))
                for x, sign, inside in _blocks(batches, jobs, classes, open_):
                    value, change = sign * (x @ held.T), sign * (x @ steps.T)
                    for k, s in enumerate(STEPS):
                        out[:, k] += cost * ((np.maximum(1 - value - s * change, 0) * inside) ** 2).sum(axis=0)
                for t, v in zip(open_.tolist(), out, strict=True):
                    yield _vector_batch(t, v)

            sums = rows.mapInArrow(losses, "machine long, v array<double>").groupBy("machine").agg(F.array(*[F.sum(F.col("v")[k]) for k in range(len(STEPS))]).alias("v"))
            loss = {r["machine"]: np.array(r["v"]) for r in sums.collect()}
            for k, t in enumerate(open_.tolist()):
                moved = held[k] + STEPS[:, None] * steps[k]
                weights[t] = moved[np.argmin(loss[t] + 0.5 * (keep * moved**2).sum(axis=1))]
        return weights.reshape(jobs, classes, width).transpose(0, 2, 1)


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def _mapped(mapping: NystromMap):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                image = mapping.map(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
                offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * image.shape[1])
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(image.ravel())), batch.column(1), batch.column(2)], ["image", "target", "fold"])

    return run


def _blocks(batches, jobs, classes, machines):
    """Images with a constant, signs and membership of each row for each of the machines."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _with_one(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
        target, fold = (batch.column(k).to_numpy() for k in (1, 2))
        job, own = machines // classes, machines % classes
        yield x, np.where(target[:, None] == own, 1.0, -1.0), fold[:, None] + 1 != job


def _added(batches):
    added: dict[int, np.ndarray] = {}
    for batch in batches:
        for machine, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(blob.as_buffer(), dtype=np.float64)
            added[machine] = added[machine] + part if machine in added else part
    return sorted(added.items())


def _vector_batch(machine: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([machine], pa.int64()), pa.array([values.tolist()], pa.list_(pa.float64()))], ["machine", "v"])
