"""Multi-class gradient boosting on histograms, all classes and all folds in one run.

Features are binned once. Every level of every round is one pass over the binned rows that
sums gradients per bin for the trees of all classes and all folds together; the sums of a
tree meet in one task, which finds its splits, and only splits come to the driver. Scores of
the rows are stored every few rounds, so a pass replays the latest trees only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.session import Scratch

REPLAY = 10  # rounds between two stored scores
ROWS = 5_000  # rows of a task, so that a pass over a small table is a small job
TIE = 1e-9  # gains closer than this are equal; the first feature and bin win


@dataclass
class Bins:
    """Upper edges of the bins of each feature, numbered through from ``start``; ``usual`` is the bin of 0."""

    edges: list[np.ndarray]

    def __post_init__(self):
        sizes = [len(e) + 1 for e in self.edges]
        self.start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.usual = np.array([np.searchsorted(e, 0.0) for e in self.edges], dtype=np.int64)
        self.feature = np.repeat(np.arange(len(self.edges)), sizes)

    def cells(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and bin of every value that isn't in the bin of 0."""
        width = len(self.edges)
        at = np.flatnonzero(flat)
        row, feature = at // width, at % width
        bins = np.empty(len(at), dtype=np.int64)
        order = np.argsort(feature, kind="stable")
        cuts = np.searchsorted(feature[order], np.arange(width + 1))
        for f in np.flatnonzero(np.diff(cuts)):
            some = order[cuts[f] : cuts[f + 1]]
            bins[some] = np.searchsorted(self.edges[f], flat[at[some]])
        other = bins != self.usual[feature]
        return row[other], self.start[feature[other]] + bins[other]

    def matrix(self, n: int, row: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Bin of every feature in every row, counted from the feature's first."""
        out = np.tile(self.usual.astype(np.int32), (n, 1))
        out[row, self.feature[cell]] = cell - self.start[self.feature[cell]]
        return out


def fit_bins(df: DataFrame, features: str, bins: int = 32) -> Bins:
    """Bins at the quantiles of each feature's values other than 0, and at 0.

    The quantiles are mergeable sketches over all rows, one shuffle of one sketch per
    feature and task; the driver gets ``bins`` numbers a feature.
    """
    width = len(df.select(features).first()[0])
    values = df.select(F.posexplode(vector_to_array(features)).alias("feature", "v")).where("v <> 0 and not isnan(v)")
    cuts = [i / bins for i in range(1, bins + 1)]
    found = values.groupBy("feature").agg(F.percentile_approx("v", cuts, 10_000).alias("q"), F.min("v").alias("low"))
    edges: list[np.ndarray] = [np.zeros(0)] * width
    for feature, q, low in found.collect():
        edges[feature] = np.unique(np.array([0.0, low, *q]))[:-1]
    return Bins(edges)


class BoostingModel:
    """Trees of one job: ``split`` and ``limit`` of the inner nodes, ``value`` of the leaves, by round and class."""

    def __init__(self, bins: Bins, prior, split, limit, value, gain, features: str):
        self.bins, self.prior, self.split, self.limit, self.value, self.gain = bins, prior, split, limit, value, gain
        self.features = features

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name that Spark's tree models use
        total = self.gain.sum()
        return DenseVector(self.gain / total if total else self.gain)

    def scores(self, matrix: np.ndarray) -> np.ndarray:
        out = np.tile(self.prior, (len(matrix), 1))
        for split, limit, value in zip(self.split, self.limit, self.value, strict=True):
            out += _leaf_values(matrix, split, limit, value)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability``, an array by class, and ``prediction``, the likeliest class."""
        model = self

        @F.arrow_udf("array<double>")
        def probability(values: pa.Array) -> pa.Array:
            flat = values.flatten().to_numpy(zero_copy_only=False)
            p = _softmax(model.scores(model.bins.matrix(len(values), *model.bins.cells(flat))))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))

        out = df.withColumn("probability", probability(vector_to_array(self.features)))
        return out.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True, initial=-np.inf))
    return e / e.sum(axis=-1, keepdims=True)


def _nodes(matrix, split, limit, levels: int) -> np.ndarray:
    """Node of each row after ``levels`` levels in each tree, as in a heap."""
    trees, inner = split.shape
    # a node without a split sends all rows to the left
    feature = np.maximum(split, 0).ravel()
    bound = np.where(split >= 0, limit, np.iinfo(np.int64).max).ravel()
    node = np.zeros((len(matrix), trees), dtype=np.int64)
    flat, first, tree = matrix.ravel(), np.arange(len(matrix))[:, None] * matrix.shape[1], np.arange(trees) * inner
    for _ in range(levels):
        at = node + tree
        right = flat.take(feature.take(at) + first) > bound.take(at)
        node *= 2
        node += 1
        node += right
    return node


def _leaf_values(matrix, split, limit, value) -> np.ndarray:
    inner = split.shape[1]
    leaf = _nodes(matrix, split, limit, (inner + 1).bit_length() - 1) - inner
    return value.ravel().take(leaf + np.arange(len(value)) * value.shape[1])


class HistogramBoosting:
    """Softmax boosting with ``rounds`` rounds of one tree a class, as an estimator.

    Leaves take Newton steps shrunk by ``rate``; a split needs a positive gain and some
    curvature on both sides. The bins, and so the trees, depend on all training rows.
    """

    def __init__(self, rounds=100, depth=3, rate=0.1, bins=32, l2=1e-6, features="features", label="target"):
        self.rounds, self.depth, self.rate, self.n_bins, self.l2 = rounds, depth, rate, bins, l2
        self.features, self.label = features, label

    def fit(self, train: DataFrame) -> BoostingModel:
        return self.fit_folds(train, 0)[0]

    def fit_folds(self, train: DataFrame, folds: int, fold: str = "fold") -> tuple[BoostingModel, list[BoostingModel]]:
        """The model of all rows, and one of each fold, trained without it, in one run."""
        with Scratch(train.sparkSession) as scratch:
            return self._fit(train, folds, fold, scratch)

    def _fit(self, train, folds, fold, scratch):
        bins = fit_bins(train, self.features, self.n_bins)
        rows = scratch.store(_binned(train, bins, self.features, self.label, fold if folds else None))
        counts = rows.groupBy("fold", "target").count().collect()  # folds times classes
        parts = max(-(-sum(r["count"] for r in counts) // ROWS), 1)
        classes = max((r["target"] for r in counts), default=0) + 1
        sizes = np.zeros((folds + 1, classes))
        for r in counts:
            inside = np.arange(folds + 1) != r["fold"] + 1 if folds else np.ones(1, dtype=bool)
            sizes[inside, r["target"]] += r["count"]
        prior = np.log(np.maximum(sizes, 1e-9) / np.maximum(sizes.sum(axis=1, keepdims=True), 1e-9))
        jobs, inner = folds + 1, 2**self.depth - 1
        n = jobs * classes
        # of all rounds: split feature (-1: none), last bin on the left, value of the leaves
        split = np.full((self.rounds, n, inner), -1, dtype=np.int64)
        limit = np.zeros((self.rounds, n, inner), dtype=np.int64)
        value = np.zeros((self.rounds, n, inner + 1))
        gains = np.zeros((n, len(bins.edges)))
        done = 0  # rounds whose trees the stored scores hold
        for m in range(self.rounds):
            if m - done == REPLAY:
                rows = scratch.store(_with_scores(rows, bins, prior, split[done:m], limit[done:m], value[done:m]))
                done = m
            for level in range(self.depth):
                trees = (split[done : m + 1], limit[done : m + 1], value[done:m])
                for tree, feature, bound, gain, leaves in self._level(rows, bins, prior, trees, level, jobs, classes, parts):
                    at = slice(2**level - 1, 2 ** (level + 1) - 1)
                    split[m, tree, at], limit[m, tree, at] = feature, bound
                    np.add.at(gains[tree], np.maximum(feature, 0), np.where(np.array(feature) >= 0, gain, 0))
                    if level == self.depth - 1:
                        value[m, tree] = np.array(leaves) * (self.rate * (classes - 1) / classes)
        models = [
            BoostingModel(bins, prior[j], *(x[:, j * classes : (j + 1) * classes] for x in (split, limit, value)), gains[j * classes : (j + 1) * classes].sum(axis=0), self.features)
            for j in range(jobs)
        ]
        return models[0], models[1:]

    def _level(self, rows, bins, prior, trees, level, jobs, classes, parts):
        """Tree, split features, limits, gains and values of both sides for each tree's nodes of a level."""
        total, l2 = int(bins.start[-1]), self.l2
        first, width = 2**level - 1, 2**level

        def sums(batches):
            out = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                block = _Block(batch, bins)
                p = _softmax(block.scores(prior, *trees, done=len(trees[2])).reshape(-1, jobs, classes))
                wrong = (np.arange(classes) == block.target[:, None])[:, None, :] - p
                inside = (np.arange(jobs) != block.fold[:, None] + 1)[:, :, None]
                # by tree, so that the rows of one lie side by side
                both = np.stack([wrong * inside, p * (1 - p) * inside]).reshape(2, len(p), -1).transpose(0, 2, 1).copy()
                node = (_nodes(block.matrix, trees[0][-1], trees[1][-1], level) - first).T * (total + 1)
                if out is None:
                    out = np.zeros((jobs * classes, 2, width, total + 1))
                for t in range(jobs * classes):
                    at = node[t].take(block.row) + block.cell
                    every = node[t] + total
                    for k in (0, 1):
                        flat = np.bincount(at, weights=both[k, t].take(block.row), minlength=width * (total + 1))
                        flat += np.bincount(every, weights=both[k, t], minlength=width * (total + 1))
                        out[t, k] += flat.reshape(width, -1)
            if out is not None:
                blobs = [x.tobytes() for x in out]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(blobs), dtype=np.int32)), pa.array(blobs, pa.binary())], ["tree", "sums"])

        def best(batches):
            added: dict[int, np.ndarray] = {}
            for batch in batches:
                for tree, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    part = np.frombuffer(blob.as_buffer(), dtype=np.float64).reshape(2, width, total + 1)
                    added[tree] = added[tree] + part if tree in added else part
            found = [(tree, *_splits(s, bins, l2)) for tree, s in sorted(added.items())]
            types = (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(types)], ["tree", "feature", "bound", "gain", "leaves"])

        summed = rows.mapInArrow(sums, "tree int, sums binary")
        if parts > 1:  # the sums of one task need no shuffle
            summed = summed.repartition(min(jobs * classes, parts), "tree")
        return summed.mapInArrow(best, "tree int, feature array<long>, bound array<long>, gain array<double>, leaves array<double>").collect()


class _Block:
    """The rows of a batch: bins as cells and as a matrix, target, fold and stored scores."""

    def __init__(self, batch: pa.RecordBatch, bins: Bins):
        cells, self.target, self.fold, self.stored = (batch.column(batch.schema.get_field_index(c)) for c in ("cells", "target", "fold", "scores"))
        self.target, self.fold = self.target.to_numpy().astype(np.int64), self.fold.to_numpy().astype(np.int64)
        offsets = cells.offsets.to_numpy()
        self.row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        self.cell = cells.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64)
        self.matrix = bins.matrix(batch.num_rows, self.row, self.cell)

    def scores(self, prior, split, limit, value, done) -> np.ndarray:
        flat = self.stored.flatten().to_numpy(zero_copy_only=False)
        out = flat.reshape(len(self.target), -1).copy() if len(flat) else np.tile(prior.ravel(), (len(self.target), 1))
        for m in range(done):
            out += _leaf_values(self.matrix, split[m], limit[m], value[m])
        return out


def _binned(df: DataFrame, bins: Bins, features: str, label: str, fold: str | None) -> DataFrame:
    """``cells, target, fold, scores`` in parts of about ``ROWS`` rows; without folds ``fold`` is out of reach."""
    own = F.col(fold).cast("int") if fold else F.lit(-2)
    rows = df.select(vector_to_array(features).alias("values"), F.col(label).cast("int").alias("target"), own.alias("fold"))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            row, cell = bins.cells(batch.column(0).flatten().to_numpy(zero_copy_only=False)) if n else (np.zeros(0, dtype=np.int64),) * 2
            order = np.argsort(row, kind="stable")
            offsets = pa.array(np.searchsorted(row[order], np.arange(n + 1)).astype(np.int32))
            cells = pa.ListArray.from_arrays(offsets, pa.array(cell[order].astype(np.int32)))
            none = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, dtype=np.int32)), pa.array([], pa.float64()))
            yield pa.RecordBatch.from_arrays([cells, batch.column(1), batch.column(2), none], ["cells", "target", "fold", "scores"])

    binned = rows.mapInArrow(run, "cells array<int>, target int, fold int, scores array<double>")
    return binned.repartition(max(-(-df.count() // ROWS), 1))


def _with_scores(rows: DataFrame, bins: Bins, prior, split, limit, value) -> DataFrame:
    def run(batches):
        for batch in batches:
            scores = _Block(batch, bins).scores(prior, split, limit, value, len(value)) if batch.num_rows else np.zeros((0, 1))
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * scores.shape[1])
            column = pa.ListArray.from_arrays(offsets, pa.array(scores.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], column], batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def _splits(sums: np.ndarray, bins: Bins, l2: float):
    """Best feature, limit and gain of each node, and the Newton steps of both sides, node by node."""
    g, h = sums[0, :, :-1].copy(), sums[1, :, :-1].copy()
    whole = sums[:, :, -1]
    usual = bins.start[:-1] + bins.usual
    first, last = bins.start[:-1], bins.start[1:] - 1

    def through(x, total):
        # what no cell holds is in the bin of 0
        c = np.cumsum(x, axis=1)
        of = c[:, last] - c[:, first] + x[:, first]
        x[:, usual] += total[:, None] - of
        c = np.cumsum(x, axis=1)
        return c - (c[:, first] - x[:, first])[:, bins.feature]

    gl, hl = through(g, whole[0]), through(h, whole[1])
    gr, hr = whole[0][:, None] - gl, whole[1][:, None] - hl
    few = 1e-6
    ok = (hl > few) & (hr > few)
    ok[:, last] = False
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, gl**2 / (hl + l2) + gr**2 / (hr + l2) - (whole[0] ** 2 / (whole[1] + l2))[:, None], -np.inf)
    feature, bound, gains, leaves = [], [], [], []
    for n in range(len(gain)):
        top = gain[n].max(initial=-np.inf)
        at = int(np.argmax(gain[n] >= top - TIE * (1 + abs(top)))) if top > TIE else -1
        feature.append(int(bins.feature[at]) if at >= 0 else -1)
        bound.append(int(at - bins.start[bins.feature[at]]) if at >= 0 else 0)
        gains.append(float(gain[n, at]) if at >= 0 else 0.0)
        left = (gl[n, at], hl[n, at]) if at >= 0 else (whole[0, n], whole[1, n])
        right = (gr[n, at], hr[n, at]) if at >= 0 else (0.0, 0.0)
        leaves += [float(x / (y + l2)) if y > 0 else 0.0 for x, y in (left, right)]
    return feature, bound, gains, leaves
