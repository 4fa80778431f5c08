"""Random forest on wide sparse rows: Gini trees on bins, one pass a level for all trees.

Rows are binned once into stored blocks that hold only the values outside a feature's bin of 0,
with a Poisson weight for each row and tree. A pass counts classes per bin for the features
that each node may split on; the counts of a tree meet in one task, and only splits come to the
driver. Rules and defaults are those of Spark's forest: the root of the number of features drawn
for each node, thresholds between the values of about 10,000 rows, leaves joined that predict alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.operators.boosting import Bins
from netsieve.session import Scratch

ROWS = 16_384  # rows of a block
COUNTS = 1 << 24  # counts of a tree in a pass; a level with more open nodes takes several passes
REPLAY = 5  # levels between two stored places of the rows
SCORED = 1_000  # rows that are scored together


def sparse_cells(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of all stored values of sparse or dense vectors."""
    if vectors.null_count:
        raise ValueError("features must not be null")
    values, indices = vectors.field("values"), vectors.field("indices")
    lengths = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(len(vectors)), lengths)
    feature = np.arange(len(row)) - first[row]  # right for dense vectors
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    feature[sparse[row]] = indices.flatten().to_numpy(zero_copy_only=False)
    return row, feature, values.flatten().to_numpy(zero_copy_only=False)


def thresholds(values: np.ndarray, counts: np.ndarray, zeros: int, bins: int) -> np.ndarray:
    """Midpoints between the sorted distinct values other than 0, all of them or at equal shares of the rows."""
    if zeros > 0:
        at = np.searchsorted(values, 0.0)
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, zeros)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle
    stride, seen, cuts = counts.sum() / bins, np.cumsum(counts), []
    target = stride
    for i in range(len(middle)):
        if abs(seen[i] - target) < abs(seen[i + 1] - target):
            cuts.append(middle[i])
            target += stride
    return np.array(cuts)


def fit_thresholds(df: DataFrame, features: str, width: int, n: int, bins: int, seed: int) -> Bins:
    """Bins from a sample of about ``max(bins ** 2, 10000)`` rows, the number that Spark's trees take."""
    share = max(bins**2, 10_000) / n
    some = df.select(features) if share >= 1 else df.select(features).sample(False, share, seed).persist()
    size = n if share >= 1 else some.count()

    def values(batches):
        for batch in batches:
            _, feature, value = sparse_cells(batch.column(0))
            kept = (value != 0) & ~np.isnan(value)
            yield pa.RecordBatch.from_arrays([pa.array(feature[kept].astype(np.int32)), pa.array(value[kept])], ["feature", "v"])

    def edges(batches):
        for batch in batches:
            cuts = []
            for found in batch.column(1):
                v, k = (found.values.field(c).to_numpy(zero_copy_only=False) for c in ("v", "n"))
                cuts.append(thresholds(v, k, size - int(k.sum()), bins))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cuts, pa.list_(pa.float64()))], ["feature", "edges"])

    counted = some.mapInArrow(values, "feature int, v double").groupBy("feature", "v").agg(F.count("*").alias("n"))
    lists = counted.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("found"))
    out: list[np.ndarray] = [np.zeros(0)] * width
    for feature, cuts in lists.mapInArrow(edges, "feature int, edges array<double>").collect():
        out[feature] = np.array(cuts)
    if share < 1:
        some.unpersist()
    return Bins(out)


@dataclass
class _Level:
    """Open nodes of a level, tree by tree: those of tree ``t`` are ``first[t]`` to ``first[t + 1]``."""

    number: int
    first: np.ndarray


@dataclass
class _Step:
    """Split of each open node of a level, and the open nodes of the next level (-1: none) on both sides."""

    feature: np.ndarray
    limit: np.ndarray
    following: np.ndarray


class _Block:
    """Rows of a block with their classes; of each tree the rows in open nodes, with node and weight; cells feature by feature."""

    def __init__(self, batch: pa.RecordBatch, i: int, bins: Bins):
        own = {c: np.frombuffer(batch.column(k)[i].as_buffer(), dtype=kind) for k, (c, kind) in enumerate(BLOCK.items())}
        self.target, self.end, self.member, self.node, self.weight = (own[c] for c in ("target", "end", "member", "node", "weight"))
        self.row, self.start, self.bin = own["row"], own["start"], own["bin"]
        self.feature = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        self.cell = bins.start[self.feature] + self.bin
        self.usual = bins.usual.astype(np.uint8)

    def follow(self, steps: list[_Step]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows that are in open nodes after ``steps``, their nodes and weights, tree by tree."""
        # bins of the features that the steps split on, row by row
        used = np.unique(np.concatenate([s.feature for s in steps] or [[0]])).astype(np.int64)
        column = np.zeros(len(self.start) - 1, dtype=np.int64)
        column[used] = np.arange(len(used))
        some = self.cells_of(used)
        row, feature, bin_ = self.row[some], self.feature[some], self.bin[some]
        if isinstance(some, slice):
            kept = np.isin(feature, used)
            row, feature, bin_ = row[kept], feature[kept], bin_[kept]
        matrix = np.tile(self.usual[used], (len(self.target), 1))
        matrix[row, column[feature]] = bin_
        flat, columns = matrix.ravel(), [column[s.feature] for s in steps]
        for low, high in zip(self.end, self.end[1:]):
            member, node, weight = self.member[low:high].astype(np.int64), self.node[low:high].astype(np.int64), self.weight[low:high]
            begin = member * len(used)
            for step, at in zip(steps, columns, strict=True):
                node = step.following.take(2 * node + (flat.take(begin + at.take(node)) > step.limit.take(node)))
                if len(kept := np.flatnonzero(node >= 0)) < len(node):
                    member, node, weight, begin = member[kept], node[kept], weight[kept], begin[kept]
            yield member, node, weight

    def cells_of(self, features: np.ndarray) -> np.ndarray | slice:
        """Places of the cells of some features, in order."""
        if 2 * len(features) > len(self.start) - 1:
            return slice(None)
        first, length = self.start[features], self.start[features + 1] - self.start[features]
        return np.repeat(first - np.cumsum(length) + length, length) + np.arange(length.sum())


BLOCK = {"target": np.int16, "end": np.int64, "member": np.int32, "node": np.int32, "weight": np.uint8, "row": np.int32, "start": np.int64, "bin": np.uint8}
_SCHEMA = ", ".join(f"{c} binary" for c in BLOCK)


def _packed(own: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([own[c].astype(kind).tobytes()], pa.binary()) for c, kind in BLOCK.items()], list(BLOCK))


def _blocks(df: DataFrame, bins: Bins, n: int, features: str, label: str, classes: int, trees: int, seed: int) -> DataFrame:
    width = len(bins.edges)
    size, parts = ROWS, max(-(-n // ROWS), 1)
    rows = df.select(features, F.col(label).cast("int").alias("target")).repartition(parts)
    flat_edges = np.concatenate([*bins.edges, np.zeros(0)])
    edge_start = bins.start[:-1] - np.arange(width)
    lengths = np.diff(bins.start) - 1

    def binned(feature, value):
        # all features are halved together: the first edge that is not below the value
        low, high = np.zeros(len(value), dtype=np.int64), lengths[feature]
        while (at := np.flatnonzero(low < high)).size:
            middle = (low[at] + high[at]) // 2
            below = ~(flat_edges[edge_start[feature[at]] + middle] >= value[at])
            low[at] = np.where(below, middle + 1, low[at])
            high[at] = np.where(below, high[at], middle)
        return low

    def block(parts, rng):
        target = np.concatenate([p[0] for p in parts])
        if len(target) and not (target.min() >= 0 and target.max() < classes):
            raise ValueError(f"labels must be integers from 0 to {classes - 1}")
        shift = np.cumsum([0, *(len(p[0]) for p in parts)])
        row = np.concatenate([p[1] + s for p, s in zip(parts, shift)])
        feature, value = (np.concatenate([p[k] for p in parts]) for k in (2, 3))
        bin_ = binned(feature, value)
        other = np.flatnonzero(bin_ != bins.usual[feature])
        other = other[np.argsort(feature[other], kind="stable")]
        weight = rng.poisson(1.0, (trees, len(target)))
        tree, member = np.nonzero(weight)
        return _packed(
            {
                "target": target, "end": np.searchsorted(tree, np.arange(trees + 1)), "member": member, "node": tree, "weight": weight[tree, member],
                "row": row[other], "start": np.searchsorted(feature[other], np.arange(width + 1)), "bin": bin_[other],
            }
        )

    def run(batches):
        # what a task draws depends on its number alone, so a lost one draws the same again
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        waiting, held = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, size):
                batch = whole.slice(at, size)
                if held and held + batch.num_rows > size:
                    yield block(waiting, rng)
                    waiting, held = [], 0
                waiting.append((batch.column(1).to_numpy(zero_copy_only=False), *sparse_cells(batch.column(0))))
                held += batch.num_rows
        if held:
            yield block(waiting, rng)

    return rows.mapInArrow(run, _SCHEMA)


def _moved(blocks: DataFrame, bins: Bins, steps: list[_Step]) -> DataFrame:
    """The blocks with the places of their rows after ``steps``."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch, i, bins)
                found = list(block.follow(steps))
                own = {c: np.concatenate([f[k] for f in found]) for k, c in enumerate(("member", "node", "weight"))}
                own["end"] = np.cumsum([0, *(len(f[0]) for f in found)])
                yield _packed({c: own.get(c, getattr(block, c)) for c in BLOCK})

    return blocks.mapInArrow(run, _SCHEMA)


def drawn_features(nodes: int, width: int, k: int, seed: list[int]) -> np.ndarray:
    """``k`` different features for each of some nodes, every set as likely."""
    if k == width:
        return np.tile(np.arange(width), (nodes, 1))
    rng = np.random.default_rng(seed)
    out = np.sort(rng.integers(0, width, (nodes, k)), axis=1)
    while (again := np.flatnonzero((out[:, 1:] == out[:, :-1]).any(axis=1))).size:
        out[again] = np.sort(rng.integers(0, width, (len(again), k)), axis=1)
    return out


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    one, place = np.unique(np.concatenate(keys), return_inverse=True)
    return one, np.bincount(place, weights=np.concatenate(counts), minlength=len(one)).astype(np.int64)


def best_splits(keys: np.ndarray, counts: np.ndarray, bins: Bins, classes: int):
    """Node, class counts, split feature (-1: none), limit, class counts on the left and gain of each node that has rows.

    ``keys`` are ``(node * (cells + 1) + cell) * classes + class`` in order, ``counts`` the rows of
    each; the last cell stands for all rows of the node. Bins of 0 have no counts, they are what is left.
    """
    cells = int(bins.start[-1])
    group, cls = np.divmod(keys, classes)
    node, cell = np.divmod(group, cells + 1)
    whole = cell == cells
    nodes, place = np.unique(node[whole], return_inverse=True)
    total = np.zeros((len(nodes), classes), dtype=np.int64)
    total[place, cls[whole]] = counts[whole]
    feature, limit = np.full(len(nodes), -1, dtype=np.int32), np.zeros(len(nodes), dtype=np.int32)
    best_left, best_gain = np.zeros_like(total), np.zeros(len(nodes))
    part = np.flatnonzero(~whole)
    if not part.size:
        return nodes, total, feature, limit, best_left, best_gain
    width = len(bins.edges)
    pair, of = np.unique(node[part] * width + bins.feature[cell[part]], return_inverse=True)
    pair_node, pair_feature = np.searchsorted(nodes, pair // width), pair % width
    size = bins.start[pair_feature + 1] - bins.start[pair_feature]
    first = np.cumsum(size) - size
    left = np.zeros((int(size.sum()), classes), dtype=np.int64)
    left[first[of] + cell[part] - bins.start[pair_feature[of]], cls[part]] = counts[part]
    left[first + bins.usual[pair_feature]] = total[pair_node] - np.add.reduceat(left, first)
    head = left[first]
    np.cumsum(left, axis=0, out=left)
    left -= np.repeat(left[first] - head, size, axis=0)
    owner = np.repeat(pair_node, size)
    right = total[owner] - left
    nl, nr = left.sum(axis=1), right.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        # the fall of the Gini index; 0 exactly if both sides have equal shares
        apart = ((left / nl[:, None] - right / nr[:, None]) ** 2).sum(axis=1)
        gain = np.where((nl > 0) & (nr > 0), apart * nl * nr / (nl + nr) ** 2.0, 0.0)
    begin = np.flatnonzero(np.diff(owner, prepend=-1))
    top = np.maximum.reduceat(gain, begin)
    hit = np.flatnonzero(gain == np.repeat(top, np.diff(begin, append=len(owner))))
    hit = hit[np.diff(owner[hit], prepend=-1) != 0]  # the first of each node
    hit = hit[gain[hit] > 0]
    at, which = owner[hit], np.searchsorted(first, hit, side="right") - 1
    feature[at], limit[at] = pair_feature[which], hit - first[which]
    best_left[at], best_gain[at] = left[hit], gain[hit]
    return nodes, total, feature, limit, best_left, best_gain


_FOUND = {"node": np.int64, "total": np.int64, "feature": np.int32, "limit": np.int32, "left": np.int64, "gain": np.float64}


def _pass(blocks: DataFrame, bins: Bins, steps: list[_Step], level: _Level, low: int, high: int, k: int, classes: int, seed: int, parts: int):
    """Splits of the open nodes ``low`` to ``high`` of every tree, a row a tree."""
    trees, width, cells = len(level.first) - 1, len(bins.edges), int(bins.start[-1])

    def sums(batches):
        chosen: dict[int, tuple] = {}
        found = [([], []) for _ in range(trees)]
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch, i, bins)
                target = block.target.astype(np.int64)
                for t, (member, node, weight) in enumerate(block.follow(steps)):
                    first, nodes = level.first[t] + low, min(level.first[t + 1] - level.first[t], high) - low
                    if nodes <= 0:
                        continue
                    if nodes < level.first[t + 1] - level.first[t]:
                        kept = np.flatnonzero((node >= first) & (node < first + nodes))
                        member, node, weight = member[kept], node[kept], weight[kept]
                    if not len(member):
                        continue
                    if t not in chosen:
                        drawn = drawn_features(level.first[t + 1] - level.first[t], width, k, [seed, t, level.number])[low : low + nodes]
                        may = np.zeros((nodes + 1, width), dtype=bool)  # the last row: no open node of this pass
                        may[np.arange(nodes)[:, None], drawn] = True
                        chosen[t] = np.unique(drawn), np.packbits(may.ravel())
                    features, packed = chosen[t]
                    may = np.unpackbits(packed, count=(nodes + 1) * width).view(bool)
                    at, weights = np.full(len(target), nodes), np.zeros(len(target), dtype=np.uint8)
                    at[member], weights[member] = node - first, weight
                    some = block.cells_of(features)
                    row, feature = block.row[some], block.feature[some]
                    hit = np.flatnonzero(may.take(at.take(row) * width + feature))
                    row = row[hit].astype(np.int64)
                    keys = ((at.take(row) + low) * (cells + 1) + block.cell[some][hit]) * classes + target.take(row)
                    every = ((node - first + low) * (cells + 1) + cells) * classes + target.take(member)
                    one, count = _added([keys, every], [weights.take(row), weight])
                    found[t][0].append(one)
                    found[t][1].append(count)
        for t, (keys, counts) in enumerate(found):
            if keys:
                both = _added(keys, counts)
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in both)], ["tree", "keys", "counts"])

    def best(batches):
        parts: dict[int, tuple] = {}
        for batch in batches:
            for tree, *blobs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                for out, blob in zip(parts.setdefault(tree, ([], [])), blobs, strict=True):
                    out.append(np.frombuffer(blob.as_buffer(), dtype=np.int64))
        for tree in sorted(parts):
            found = best_splits(*_added(*parts.pop(tree)), bins, classes)
            blobs = [pa.array([x.astype(kind).tobytes()], pa.binary()) for x, kind in zip(found, _FOUND.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), *blobs], ["tree", *_FOUND])

    summed = blocks.mapInArrow(sums, "tree int, keys binary, counts binary")
    summed = summed.repartition(min(trees, parts), "tree")
    return summed.mapInArrow(best, "tree int, " + ", ".join(f"{c} binary" for c in _FOUND)).collect()


class SparseForest:
    """Forest of ``trees`` trees of at most ``depth`` levels of splits, as an estimator; ``classes`` counts the label's codes."""

    def __init__(self, classes: int, trees=100, depth=20, bins=32, seed=42, features="features", label="target", prediction="prediction", probability="probability", raw="rawPrediction"):
        if not 2 <= bins <= 256:
            raise ValueError("bins must lie between 2 and 256")
        self.classes, self.trees, self.depth, self.bins, self.seed = classes, trees, depth, bins, seed
        self.features, self.label = features, label
        self.columns = {"predictionCol": prediction, "probabilityCol": probability, "rawPredictionCol": raw}

    def fit(self, train: DataFrame) -> SparseForestModel:
        width, n = len(train.select(self.features).first()[0]), train.count()
        bins = fit_thresholds(train, self.features, width, n, self.bins, self.seed)
        with Scratch(train.sparkSession) as scratch:
            blocks = scratch.store(_blocks(train, bins, n, self.features, self.label, self.classes, self.trees, self.seed))
            levels = self._grow(blocks, bins, scratch)
        return self._model(levels, bins)

    def _grow(self, blocks: DataFrame, bins: Bins, scratch: Scratch) -> list[dict]:
        """Nodes of each level, tree by tree; ``left`` is the place of the left child in the next level, the right one follows."""
        width, classes = len(bins.edges), self.classes
        k = int(np.ceil(np.sqrt(width))) if self.trees > 1 else width
        most = np.sort(np.diff(bins.start))[-k:].sum() * classes
        nodes = max(int(COUNTS // most), 1)
        parts = blocks.sparkSession.sparkContext.defaultParallelism
        levels, steps = [], []
        tree, total, open_ = np.arange(self.trees), np.zeros((self.trees, classes), dtype=np.int64), np.ones(self.trees, dtype=bool)
        for number in range(self.depth + 1):
            size = len(tree)
            here = {"tree": tree, "total": total, "feature": np.full(size, -1, dtype=np.int32), "limit": np.zeros(size, dtype=np.int32), "left": np.full(size, -1, dtype=np.int64), "gain": np.zeros(size)}
            levels.append(here)
            ids = np.flatnonzero(open_)
            if not ids.size:
                break
            level = _Level(number, np.searchsorted(tree[ids], np.arange(self.trees + 1)))
            below = np.zeros((size, classes), dtype=np.int64)
            if len(steps) == REPLAY:
                blocks, steps = scratch.store(_moved(blocks, bins, steps)), []
            for low in range(0, int(np.diff(level.first).max()), nodes):
                for r in _pass(blocks, bins, steps, level, low, low + nodes, k, classes, self.seed, parts):
                    found = {c: np.frombuffer(r[c], dtype=kind) for c, kind in _FOUND.items()}
                    at = ids[level.first[r["tree"]] + found["node"]]
                    for c in ("feature", "limit", "gain"):
                        here[c][at] = found[c]
                    total[at], below[at] = found["total"].reshape(-1, classes), found["left"].reshape(-1, classes)
            if number == self.depth:  # depth 0: the root has its counts, and no splits
                here["feature"][:] = -1
                break
            split = np.flatnonzero(here["feature"] >= 0)
            here["left"][split] = 2 * np.arange(len(split))
            tree = np.repeat(tree[split], 2)
            total = np.stack([below[split], total[split] - below[split]], axis=1).reshape(-1, classes)
            open_ = ((total > 0).sum(axis=1) > 1) & (number + 1 < self.depth)
            slot = np.where(open_, np.cumsum(open_) - 1, -1)
            following = np.full((size, 2), -1)
            following[split] = slot.reshape(-1, 2)
            steps.append(_Step(np.maximum(here["feature"][ids], 0), here["limit"][ids].astype(np.uint8), following[ids].ravel()))
        return levels

    def _model(self, levels: list[dict], bins: Bins) -> SparseForestModel:
        for here, deeper in zip(levels[-2::-1], levels[::-1]):
            split = np.flatnonzero(here["feature"] >= 0)
            left = here["left"][split]
            guess = deeper["total"].argmax(axis=1)
            joined = (deeper["feature"][left] < 0) & (deeper["feature"][left + 1] < 0) & (guess[left] == guess[left + 1])
            here["feature"][split[joined]] = -1
        importance = np.zeros((self.trees, len(bins.edges)))
        feature, limit, left, share = [], [], [], []
        kept, after = np.arange(self.trees), self.trees
        for here in levels:
            inner = here["feature"][kept] >= 0
            split = kept[inner]
            np.add.at(importance, (here["tree"][split], here["feature"][split]), here["gain"][split] * here["total"][split].sum(axis=1))
            own = np.full(len(kept), -1, dtype=np.int64)
            own[inner] = after + 2 * np.arange(len(split))
            feature += here["feature"][kept].tolist()
            limit += [float(bins.edges[f][b]) if f >= 0 else 0.0 for f, b in zip(here["feature"][kept], here["limit"][kept])]
            left += own.tolist()
            total = here["total"][kept]
            share += (total / np.maximum(total.sum(axis=1, keepdims=True), 1)).ravel().tolist()
            kept = (here["left"][split][:, None] + np.arange(2)).ravel()
            after += len(kept)
        importance /= np.maximum(importance.sum(axis=1, keepdims=True), 1e-300)
        importance = importance.sum(axis=0)
        importance /= max(importance.sum(), 1e-300)
        return SparseForestModel(
            trees=self.trees, classes=self.classes, feature=feature, limit=limit, left=left, share=share,
            importance=importance.tolist(), featuresCol=self.features, **self.columns,
        )


class SparseForestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds raw scores, probabilities and the likeliest class. All its state is parameters; the roots are the first nodes."""

    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)
    feature = Param(Params._dummy(), "feature", "feature that a node splits on, -1 for a leaf", TypeConverters.toListInt)
    limit = Param(Params._dummy(), "limit", "largest value that goes to the left", TypeConverters.toListFloat)
    left = Param(Params._dummy(), "left", "left child of a node, the right one follows", TypeConverters.toListInt)
    share = Param(Params._dummy(), "share", "shares of the classes, node by node", TypeConverters.toListFloat)
    importance = Param(Params._dummy(), "importance", "importance of each feature", TypeConverters.toListFloat)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector of a row", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "likeliest class", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "probabilities of the classes", TypeConverters.toString)
    rawPredictionCol = Param(Params._dummy(), "rawPredictionCol", "votes of the trees", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, trees=None, classes=None, feature=None, limit=None, left=None, share=None, importance=None, featuresCol=None, predictionCol=None, probabilityCol=None, rawPredictionCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name that Spark's tree models use
        return DenseVector(self.getOrDefault("importance"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        feature, limit, left, share = (np.array(self.getOrDefault(p)) for p in ("feature", "limit", "left", "share"))
        trees, classes = self.getOrDefault("trees"), self.getOrDefault("classes")
        share = share.reshape(-1, classes)
        used, column = np.unique(np.maximum(feature, 0), return_inverse=True)
        inner = feature >= 0

        def votes(vectors):
            row, own, value = sparse_cells(vectors)
            at = np.minimum(np.searchsorted(used, own), len(used) - 1)
            known = used[at] == own
            x = np.zeros((len(vectors), len(used)))
            x[row[known], at[known]] = value[known]
            rows, node = np.arange(len(vectors))[:, None], np.tile(np.arange(trees), (len(vectors), 1))
            while inner[node].any():
                right = ~(x[rows, column[node]] <= limit[node])
                node = np.where(inner[node], left[node] + right, node)
            return share[node].sum(axis=1)

        @F.arrow_udf("array<double>")
        def raw(vectors: pa.Array) -> pa.Array:
            found = [votes(vectors.slice(k, SCORED)) for k in range(0, len(vectors), SCORED)]
            flat = np.concatenate([*found, np.zeros((0, classes))]).ravel()
            return pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * classes), pa.array(flat))

        raw_col, probability_col, prediction_col = (self.getOrDefault(p) for p in ("rawPredictionCol", "probabilityCol", "predictionCol"))
        all_votes = F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
        out = dataset.withColumn("_votes", raw(self.getOrDefault("featuresCol")))
        out = out.withColumns(
            {
                raw_col: array_to_vector("_votes"),
                probability_col: array_to_vector(F.transform("_votes", lambda x: x / all_votes)),
                prediction_col: (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double"),
            }
        )
        return out.drop("_votes")
