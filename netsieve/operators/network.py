"""Dense network: L-BFGS whose loss and gradient are sums of Spark tasks over packed rows.

Rows are packed once into single-precision blocks and stored. Every evaluation is one pass over
the blocks: a task multiplies whole blocks and returns one sum, in double precision. The weights
begin as Spark's multilayer perceptron begins, and go back into a model of that class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.session import Scratch

BLOCK = 512  # rows of a product, so that the values of a layer stay in the processor's cache
SUMS = 8  # tasks that add the sums of the others
MEMORY = 10  # steps that the curvature is learnt from


class DenseNetwork:
    """Sigmoid layers and a softmax with cross entropy, fitted as an estimator."""

    def __init__(self, hidden: list[int], classes: int = 2, iterations: int = 100, tolerance: float = 1e-6, features="features", label="target", seed=42):
        self.hidden, self.classes, self.iterations, self.tolerance = hidden, classes, iterations, tolerance
        self.features, self.label, self.seed = features, label, seed

    def fit(self, train: DataFrame) -> MultilayerPerceptronClassificationModel:
        width = len(train.select(self.features).first()[0])
        layers = [width, *self.hidden, self.classes]
        # no iteration: a model with the weights it begins with
        bare = MultilayerPerceptronClassifier(layers=layers, featuresCol=self.features, labelCol=self.label, maxIter=0, seed=self.seed)
        row = train.sparkSession.createDataFrame([(Vectors.dense([0.0] * width), 0.0)], [self.features, self.label])
        start = np.array(bare.fit(row).weights.toArray())
        with Scratch(train.sparkSession) as scratch:
            blocks = scratch.store(_packed(train, self.features, self.label, self.classes))
            weights = minimise(lambda w: _evaluate(blocks, w, layers), start, self.iterations, self.tolerance)
        return bare.setInitialWeights(Vectors.dense(weights)).fit(row)


def _packed(df: DataFrame, features: str, label: str, classes: int) -> DataFrame:
    """``x``, ``y``: values and classes of the rows of a batch, one block a batch."""
    rows = df.select(vector_to_array(features, "float32").alias("x"), F.col(label).cast("double").alias("y"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                y = batch.column(1).to_numpy(zero_copy_only=False)
                if not np.isin(y, np.arange(classes)).all():
                    raise ValueError(f"labels must be integers from 0 to {classes - 1}")
                if batch.column(0).null_count or not np.isfinite(x).all():
                    raise ValueError("features must not be null or hold values that are not finite")
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.astype(np.int8).tobytes()], pa.binary())], ["x", "y"])

    return rows.mapInArrow(run, "x binary, y binary")


def _views(weights: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights (inputs by outputs) and constants of each layer, as views."""
    out, at = [], 0
    for n, m in zip(layers, layers[1:]):
        out.append((weights[at : at + n * m].reshape(n, m), weights[at + n * m : at + n * m + m]))
        at += n * m + m
    return out


def loss_and_gradient(x: np.ndarray, y: np.ndarray, weights: np.ndarray, layers: list[int]) -> tuple[float, np.ndarray]:
    """Summed cross entropy of the rows and its gradient, in the precision of ``x``."""
    parts, grad = _views(weights.astype(x.dtype), layers), np.zeros(len(weights))
    sums, values = _views(grad, layers), [x]
    for w, b in parts:
        z = values[-1] @ w
        z += b
        if len(values) < len(parts):
            np.negative(z, out=z)
            np.minimum(z, 80, out=z)
            np.exp(z, out=z)
            z += 1
            np.reciprocal(z, out=z)
        else:
            z -= z.max(axis=1, keepdims=True)
        values.append(z)
    logits, at = values[-1], np.arange(len(y))
    p = np.exp(logits)
    total = p.sum(axis=1, keepdims=True)
    loss = float((np.log(total[:, 0].astype(np.float64)) - logits[at, y]).sum())
    error = p / total
    error[at, y] -= 1
    for k in range(len(parts) - 1, -1, -1):
        sums[k][0][:] += values[k].T @ error
        sums[k][1][:] += error.sum(axis=0)
        if k:
            error = error @ parts[k][0].T
            error *= values[k]
            error *= 1 - values[k]
    return loss, grad


def _evaluate(blocks: DataFrame, weights: np.ndarray, layers: list[int]) -> tuple[float, np.ndarray]:
    """Mean loss of all rows and its gradient."""

    def run(batches):
        out = np.zeros(len(weights) + 2)  # rows, loss, gradient
        for batch in batches:
            for xs, ys in zip(batch.column(0), batch.column(1), strict=True):
                x = np.frombuffer(xs.as_buffer(), dtype=np.float32).reshape(-1, layers[0])
                y = np.frombuffer(ys.as_buffer(), dtype=np.int8)
                for k in range(0, len(y), BLOCK):
                    loss, grad = loss_and_gradient(x[k : k + BLOCK], y[k : k + BLOCK], weights, layers)
                    out[1] += loss
                    out[2:] += grad
                out[0] += len(y)
        yield _one(out)

    def add(batches):
        out = np.zeros(len(weights) + 2)
        for batch in batches:
            for blob in batch.column(0):
                out += np.frombuffer(blob.as_buffer(), dtype=np.float64)
        yield _one(out)

    found = blocks.mapInArrow(run, "sums binary")
    if blocks.rdd.getNumPartitions() > SUMS:
        found = found.repartition(SUMS).mapInArrow(add, "sums binary")
    out = np.sum([np.frombuffer(r["sums"], dtype=np.float64) for r in found.collect()], axis=0)
    return out[1] / out[0], out[2:] / out[0]


def _one(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary())], ["sums"])


# --- L-BFGS with a line search for the strong Wolfe conditions ----------------------


class SearchFailed(Exception):
    """No step along the direction keeps the conditions."""


def minimise(f, x: np.ndarray, iterations: int, tolerance: float, window: int = 20) -> np.ndarray:
    """Where ``f``, which gives value and gradient, is least, after at most ``iterations`` steps.

    It ends when the value has moved by less than ``tolerance`` of the first one within ``window``
    steps, when the gradient is small against the value, or when a search fails twice.
    """
    value, grad = f(x)
    first, past, steps, failed = value, [np.inf], [], False
    for n in range(iterations):
        if np.linalg.norm(grad) <= max(tolerance * value, 1e-8):
            break
        try:
            direction = _direction(steps, grad)
            length, (new, slope) = _search(f, x, direction, value, grad, 1.0 if n else 1.0 / np.linalg.norm(direction))
        except SearchFailed:
            if failed:
                break
            failed, steps = True, []
            continue
        step = length * direction
        steps = [(step, slope - grad), *steps][:MEMORY]
        x, value, grad = x + step, new, slope
        past = [*past, value][-window:]
        if abs(value - max(past)) <= tolerance * first:
            break
    return x


def _direction(steps: list, grad: np.ndarray) -> np.ndarray:
    """Downhill by the inverse curvature that the latest steps show."""
    out, factors = grad.copy(), []
    for step, change in steps:
        factors.append((step @ out) / (step @ change))
        out -= factors[-1] * change
    if steps:
        step, change = steps[0]
        out *= (step @ change) / (change @ change)
    for (step, change), a in zip(reversed(steps), reversed(factors), strict=True):
        out += step * (a - (change @ out) / (step @ change))
    if not np.isfinite(out).all():
        raise SearchFailed
    return -out


def _search(f, x, direction, value, grad, length, tries: int = 10, c1: float = 1e-4, c2: float = 0.9):
    """Step length and ``f`` there: enough decrease, and a slope of at most ``c2`` of the first."""
    first = direction @ grad
    if first > 0:
        raise SearchFailed

    def at(t):
        v, g = f(x + t * direction)
        return t, v, direction @ g, (v, g)

    def zoom(low, high):
        for _ in range(tries):
            c = at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if c[1] > value + c1 * c[0] * first or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= c2 * abs(first):
                return c[0], c[3]
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise SearchFailed

    low = (0.0, value, first, None)
    for k in range(tries):
        c = at(length)
        if not np.isfinite(c[1]):
            length /= 2
        elif c[1] > value + c1 * length * first or (c[1] >= low[1] and k):
            return zoom(low, c)
        elif abs(c[2]) <= c2 * abs(first):
            return c[0], c[3]
        elif c[2] >= 0:
            return zoom(c, low)
        else:
            low, length = c, length * 1.5
    raise SearchFailed


def _between(left, right) -> float:
    """Least point of the cubic through both ends, kept off the ends."""
    (l, lv, ld, _), (r, rv, rd, _) = left, right
    with np.errstate(invalid="ignore", divide="ignore"):
        d1 = ld + rd - 3 * (lv - rv) / (l - r)
        d2 = np.sqrt(d1 * d1 - ld * rd)
        t = r - (r - l) * (rd + d2 - d1) / (rd - ld + 2 * d2)
    return float(min(max(t, l + 0.1 * (r - l)), l + 0.9 * (r - l))) if np.isfinite(t) else (l + r) / 2
