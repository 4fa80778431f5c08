"""One-class support vector machine with an RBF kernel, at linear cost.

Random Fourier features (Rahimi & Recht 2007) make the kernel a dot product. The
one-class problem is then solved by fully corrective Frank-Wolfe steps: the linear
step puts equal weight on the nu-share of rows with the lowest score, so an iteration
is one pass that sums feature vectors by score bin, and the weights are the shortest
mixture of all sums so far. It ends when the duality gap, as far as the bins tell it,
is at most ``tolerance`` times the squared length of the weights.

The passes of the fit read blocks of rows in single precision, whose error is far below
``tolerance``; scores are double.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from netsieve.operators.ordering import exact_quantile

BINS = 256
BLOCK = 256  # rows mapped at once; what they map to stays in the processor's cache
AHEAD = 24  # bins beyond the last cut whose sums are taken along
# sin(2 pi t) / t by powers of t squared, exact to doubles for t within a quarter
_SINE = [(-1) ** k * (2 * math.pi) ** (2 * k + 1) / math.factorial(2 * k + 1) for k in range(10)]


def _map_rows(x: np.ndarray, proj: np.ndarray, phase: np.ndarray) -> np.ndarray:
    """``sqrt(2 / width) * cos(x @ proj + phase)``; the cosine is a sine of the rest of a turn."""
    t = x @ (proj / (2 * np.pi))
    t += phase / (2 * np.pi)
    t -= np.rint(t)
    np.abs(t, out=t)
    np.subtract(0.25, t, out=t)
    square, sine = t * t, np.full_like(t, _SINE[-1])
    for c in _SINE[-2::-1]:
        sine *= square
        sine += c
    sine *= t
    sine *= np.sqrt(2.0 / len(phase))
    return sine


def _similarity(x: np.ndarray, proj: np.ndarray, phase: np.ndarray, weights: np.ndarray) -> np.ndarray:
    blocks = [_map_rows(x[at : at + BLOCK], proj, phase) @ weights for at in range(0, len(x), BLOCK)]
    return np.concatenate(blocks) if blocks else np.zeros(0)


def _packed(df: DataFrame, features: str) -> DataFrame:
    """A row per batch: its vectors in single precision, their number, and sum and sum of squares of all entries."""

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                row = [flat.astype(np.float32).tobytes()], [batch.num_rows], [flat.sum()], [flat @ flat]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["x", "n", "total", "square"])

    return df.select(vector_to_array(features).alias("v")).mapInArrow(pack, "x binary, n long, total double, square double")


def scale_gamma(df: DataFrame, features: str) -> float:
    """1 / (width * variance of all matrix entries)."""
    return _gamma(_packed(df, features), len(df.select(features).first()[0]))


def _gamma(packed: DataFrame, width: int) -> float:
    n, total, square = packed.agg(F.sum("n"), F.sum("total"), F.sum("square")).first()
    variance = square / (n * width) - (total / (n * width)) ** 2
    return 1.0 / (width * variance) if variance > 0 else 1.0


@dataclass
class OneClassSVM:
    proj: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    rho: float = 0.0

    def score(self, df: DataFrame, features: str, out: str = "one_class_svm_score") -> DataFrame:
        """Anomaly score: minus the similarity to the training rows."""
        parts = df.sparkSession.sparkContext.broadcast((self.proj, self.phase, self.weights))

        @F.arrow_udf(DoubleType())
        def similarity(values: pa.Array) -> pa.Array:
            proj, phase, weights = parts.value
            valid = values.is_valid().to_numpy(zero_copy_only=False)
            found = np.zeros(len(values))
            found[valid] = -_similarity(values.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(proj)), proj, phase, weights)
            return pa.array(found, mask=~valid)

        return df.withColumn(out, similarity(F.when(F.col(features).isNotNull(), vector_to_array(features))))

    def predict(self, df: DataFrame, features: str) -> DataFrame:
        return self.flag(self.score(df, features))

    def flag(self, scored: DataFrame) -> DataFrame:
        return scored.withColumn("one_class_svm_anomaly", (F.col("one_class_svm_score") > F.lit(-self.rho)).cast("int"))

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps(
            {"proj": self.proj.tolist(), "phase": self.phase.tolist(), "weights": self.weights.tolist(), "rho": self.rho}
        )
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "OneClassSVM":
        d = json.loads(spark.read.text(path).first()[0])
        return cls(np.array(d["proj"]), np.array(d["phase"]), np.array(d["weights"]), d["rho"])


def _bin_sums(packed: DataFrame, proj, phase, weights, edges, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Count per score bin, and feature-map sum of the bins up to ``last``: each task emits at most one row per bin."""
    factor = np.sqrt(2.0 / len(phase))
    single = [a.astype(np.float32) for a in (proj, phase, weights * factor)]
    parts = packed.sparkSession.sparkContext.broadcast((*single, edges))

    def fold(batches):
        proj, phase, weights, edges = parts.value
        counts = np.zeros(len(edges) + 1, dtype=np.int64)
        sums = np.zeros((len(edges) + 1, len(phase)))
        for batch in batches:
            for blob in batch.column(0):
                x = np.frombuffer(blob.as_buffer(), dtype=np.float32).reshape(-1, len(proj))
                for at in range(0, len(x), BLOCK):
                    z = x[at : at + BLOCK] @ proj
                    z += phase
                    np.cos(z, out=z)
                    where = np.searchsorted(edges, z @ weights)
                    counts += np.bincount(where, minlength=len(counts))
                    kept = np.flatnonzero(where <= last)
                    if len(kept):
                        order = kept[np.argsort(where[kept], kind="stable")]
                        bins, starts = np.unique(where[order], return_index=True)
                        sums[bins] += np.add.reduceat(z[order], starts, axis=0, dtype=np.float64)
        used = np.flatnonzero(counts)
        columns = [pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array((sums[used] * factor).tolist(), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["bin", "n", "total"])

    folded = packed.select("x").mapInArrow(fold, "bin int, n bigint, total array<double>")
    rows = folded.groupBy("bin").agg(F.sum("n").alias("n"), Summarizer.sum(array_to_vector("total")).alias("total")).collect()
    counts, sums = np.zeros(len(edges) + 1), np.zeros((len(edges) + 1, len(phase)))
    for r in rows:
        counts[r["bin"]], sums[r["bin"]] = r["n"], r["total"].toArray()
    return counts, sums


def _shortest_mixture(points: np.ndarray) -> np.ndarray:
    """The point nearest to zero in the hull of a few points, by pairwise steps."""
    gram = points @ points.T
    share = np.zeros(len(points))
    share[gram.diagonal().argmin()] = 1.0
    for _ in range(100_000):
        slope = gram @ share
        low, high = slope.argmin(), np.where(share > 0, slope, -np.inf).argmax()
        drop = slope[high] - slope[low]
        bend = gram[low, low] - 2 * gram[low, high] + gram[high, high]
        if drop <= 1e-9 * (share @ slope) or bend <= 0:
            break
        step = min(share[high], drop / bend)
        share[low] += step
        share[high] -= step
    return share @ points


def fit_one_class_svm(
    df: DataFrame, features: str, nu: float = 0.05, gamma: float | None = None, width: int = 200,
    tolerance: float = 0.01, seed: int = 42,
) -> OneClassSVM:
    model = _fit_weights(df, features, nu, gamma, width, tolerance, seed)
    scores = model.score(df.select(features), features).select("one_class_svm_score")
    model.rho = _edge(scores, nu)
    return model


def fit_predict(
    df: DataFrame, features: str, nu: float = 0.05, gamma: float | None = None, width: int = 200,
    tolerance: float = 0.01, seed: int = 42, keep: list[str] | None = None,
) -> tuple[OneClassSVM, DataFrame]:
    """The machine and ``df`` with its scores and flags; rows are scored once, for threshold and flags.

    The scored rows stay persisted on disk, with the columns ``keep`` of ``df`` (all, if not given);
    ``unpersist`` them when they are no longer read.
    """
    model = _fit_weights(df, features, nu, gamma, width, tolerance, seed)
    scored = model.score(df, features)
    if keep is not None:
        scored = scored.select(*keep, "one_class_svm_score")
    scored = scored.persist(StorageLevel.DISK_ONLY)
    model.rho = _edge(scored, nu)
    return model, model.flag(scored)


def _edge(scored: DataFrame, nu: float) -> float:
    return exact_quantile(scored.select((-F.col("one_class_svm_score")).alias("s")), "s", nu)


def _fit_weights(df, features, nu, gamma, width, tolerance, seed) -> OneClassSVM:
    d = len(df.select(features).first()[0])
    packed = _packed(df, features).persist(StorageLevel.DISK_ONLY)
    try:
        return _solve(packed, d, nu, _gamma(packed, d) if gamma is None else gamma, width, tolerance, seed)
    finally:
        packed.unpersist()


def _solve(packed: DataFrame, d: int, nu: float, gamma: float, width: int, tolerance: float, seed: int) -> OneClassSVM:
    rng = np.random.default_rng(seed)
    proj = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(d, width))
    phase = rng.uniform(0.0, 2.0 * np.pi, size=width)
    weights, sums_so_far, last = np.zeros(width), np.zeros((0, width)), BINS
    while True:
        # a similarity is at most sqrt(2) times the length of the weights
        reach = np.sqrt(2.0) * np.linalg.norm(weights)
        edges = np.linspace(-reach, reach, BINS - 1) if reach > 0 else np.array([])
        counts, sums = _bin_sums(packed, proj, phase, weights, edges, last)
        want = nu * counts.sum() if reach > 0 else counts.sum()
        if counts[: last + 1].sum() < want:
            # the cut is beyond the bins that were summed
            counts, sums = _bin_sums(packed, proj, phase, weights, edges, BINS)
        taken, target, cut = 0.0, np.zeros(width), 0
        for at, (n, total) in enumerate(zip(counts, sums)):
            if n and taken < want:
                share = min(1.0, (want - taken) / n)
                target += share * total
                taken += share * n
                cut = at
        target /= taken
        if len(sums_so_far) and weights @ (weights - target) <= tolerance * (weights @ weights):
            return OneClassSVM(proj, phase, weights)
        sums_so_far = np.vstack([sums_so_far, target])
        weights = _shortest_mixture(sums_so_far)
        # next to no rows have other bins than before, once there are bins
        last = cut + AHEAD if reach > 0 else BINS
