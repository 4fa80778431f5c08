"""Isolation forest (Liu, Ting, Zhou 2008).

Trees need only a few hundred random rows each, so the draw is a narrow filter and
the shuffle carries the drawn rows alone. Each tree grows in its own task; the
finished forest, at most ``trees * (2 * sample - 1)`` nodes, scores all rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from netsieve.operators.ordering import exact_quantile

STEP = 64.0  # the largest mean that is inverted at once
NODE_SCHEMA = "tree int, node int, feature int, split double, left_node int, right_node int, length double"


def _mean_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def draw_samples(df: DataFrame, features: str, trees: int, sample: int, seed: int) -> DataFrame:
    """``(tree, values)``: ``sample`` random rows per tree, by one rule at all sizes.

    Each row is drawn a Poisson number of times, three times ``trees * sample`` over the number of
    rows on average, and each draw goes to a tree of its own, where those with the smallest
    hashes are cut to size. All follows from hashes of the values and ``seed``, so samples are
    the same however the rows are partitioned. Equal rows draw as one with
    their number as weight, so they are no more likely to be drawn than any rows. What is
    shuffled is a hash and a count per distinct row; ``trees * sample`` drawn hashes at most are
    broadcast to fetch their values.
    """
    rows = df.where(F.col(features).isNotNull()).select(vector_to_array(features).alias("values"))
    rows = rows.withColumn("h", F.xxhash64("values", F.lit(seed)))
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("m"))
    n = df.count()
    drawn = counts.mapInArrow(_draws(3 * trees * sample / max(n, 1), trees, seed), "h long, tree int, key double")
    place = F.row_number().over(Window.partitionBy("tree").orderBy("key", "h"))
    drawn = drawn.withColumn("place", place).where(F.col("place") <= sample).groupBy("h", "tree").agg(F.count(F.lit(1)).cast("int").alias("times"))
    wanted = F.broadcast(drawn.groupBy("h").agg(F.collect_list(F.struct("tree", "times")).alias("draws")))
    found = rows.join(wanted, "h").groupBy("h").agg(F.first("values").alias("values"), F.first("draws").alias("draws"))
    each = found.select("values", F.explode("draws").alias("d")).select("d.tree", "d.times", "values")
    return each.select("tree", "values", F.explode(F.sequence(F.lit(1), F.col("times")))).select("tree", "values")


def _draws(rate: float, trees: int, seed: int):
    """The draws of each distinct row: tree and random key."""

    def run(batches):
        for batch in batches:
            h, m = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            times = _poisson(rate * m, h, seed)
            row = np.repeat(np.arange(len(h)), times)
            number = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            tree = (_uniform(h[row], seed + 1 + number) * trees).astype(np.int64)
            arrays = [pa.array(h[row].view(np.int64)), pa.array(tree.astype(np.int32)), pa.array(_uniform(h[row], seed + 500_009 + number))]
            yield pa.RecordBatch.from_arrays(arrays, ["h", "tree", "key"])

    return run


def _uniform(h: np.ndarray, salt) -> np.ndarray:
    """Numbers in [0, 1) that follow from hashes."""
    x = h + (np.atleast_1d(salt).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def _poisson(mean: np.ndarray, h: np.ndarray, seed: int) -> np.ndarray:
    """Poisson numbers by inversion; a mean beyond ``STEP`` is the sum of several."""
    out, part = np.zeros(len(mean), dtype=np.int64), 0
    while (mean > 0).any():
        now = np.minimum(mean, STEP)
        u, p, k = _uniform(h, seed - 1_000_003 * (part + 1) & 0x7FFFFFFF), np.exp(-now), 0
        total = p.copy()
        open_ = (u >= total) & (now > 0)
        while open_.any():
            k += 1
            p = p * now / k
            total += p
            out[open_] += 1
            # beyond what doubles tell apart nothing is left
            open_ &= (u >= total) & (p > 0)
        mean = mean - now
        part += 1
    return out


def _grow(tree: int, x: np.ndarray, depth_limit: int, rng) -> list[tuple]:
    nodes = []

    def build(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append(None)
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= depth_limit or len(rows) <= 1 or len(usable) == 0:
            nodes[me] = (tree, me, -1, 0.0, -1, -1, depth + _mean_path(len(rows)))
            return me
        f = int(rng.choice(usable))
        split = float(rng.uniform(low[f], high[f]))
        go_left = part[:, f] <= split
        left = build(rows[go_left], depth + 1)
        right = build(rows[~go_left], depth + 1)
        nodes[me] = (tree, me, f, split, left, right, 0.0)
        return me

    build(np.arange(len(x)), 0)
    return nodes


@dataclass
class IsolationForest:
    nodes: list
    sample: int
    threshold: float = float("inf")

    def _arrays(self):
        """Per tree: feature, split, both sides and length of the nodes, and the number of levels; a leaf leads to itself."""
        table = pd.DataFrame(self.nodes, columns=["tree", "node", "feature", "split", "left_node", "right_node", "length"])
        out = []
        for _, t in table.groupby("tree"):
            t = t.sort_values("node")
            feature, own, leaf = t["feature"].to_numpy(), np.arange(len(t)), t["feature"].to_numpy() < 0
            # a value that is not at most the split goes right, to the first of both sides
            sides = np.stack([np.where(leaf, own, t["right_node"]), np.where(leaf, own, t["left_node"])], axis=1).ravel()
            level, levels = own[:1], 0
            while (level := level[~leaf[level]]).size:
                level, levels = np.concatenate([sides[2 * level], sides[2 * level + 1]]), levels + 1
            out.append((np.maximum(feature, 0).astype(np.int64), t["split"].to_numpy(), sides.astype(np.int64), t["length"].to_numpy(), levels))
        return out

    def score(self, df: DataFrame, features: str, out: str = "isolation_forest_score") -> DataFrame:
        forest = df.sparkSession.sparkContext.broadcast(self._arrays())
        norm = _mean_path(self.sample) or 1.0

        @F.arrow_udf(DoubleType())
        def path_score(values: pa.Array) -> pa.Array:
            valid = values.is_valid().to_numpy(zero_copy_only=False)
            flat, n = values.flatten().to_numpy(zero_copy_only=False), int(valid.sum())
            first = np.arange(n) * (len(flat) // max(n, 1))
            total = np.zeros(n)
            for feature, split, sides, length, levels in forest.value:
                at = np.zeros(n, dtype=np.int64)
                for _ in range(levels):
                    left = flat.take(feature.take(at) + first) <= split.take(at)
                    at = sides.take(2 * at + left)
                total += length.take(at)
            found = np.zeros(len(values))
            found[valid] = 2.0 ** (-(total / len(forest.value)) / norm)
            return pa.array(found, mask=~valid)

        return df.withColumn(out, path_score(F.when(F.col(features).isNotNull(), vector_to_array(features))))

    def predict(self, df: DataFrame, features: str) -> DataFrame:
        return self.flag(self.score(df, features))

    def flag(self, scored: DataFrame) -> DataFrame:
        flag = (F.col("isolation_forest_score") > F.lit(self.threshold)).cast("int")
        return scored.withColumn("isolation_forest_anomaly", flag)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = json.dumps({"sample": self.sample, "threshold": self.threshold})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "IsolationForest":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        nodes = [tuple(r) for r in spark.read.parquet(f"{path}/nodes").collect()]
        return cls(nodes, meta["sample"], meta["threshold"])


def fit_isolation_forest(
    df: DataFrame, features: str, contamination: float = 0.05, trees: int = 100, sample: int = 256, seed: int = 42
) -> IsolationForest:
    model = _fit_trees(df, features, trees, sample, seed)
    scores = model.score(df.select(features), features).select("isolation_forest_score")
    model.threshold = exact_quantile(scores, "isolation_forest_score", 1 - contamination)
    return model


def fit_predict(
    df: DataFrame, features: str, contamination: float = 0.05, trees: int = 100, sample: int = 256, seed: int = 42,
    keep: list[str] | None = None,
) -> tuple[IsolationForest, DataFrame]:
    """The forest and ``df`` with its scores and flags; rows are scored once, for threshold and flags.

    The scored rows stay persisted on disk, with the columns ``keep`` of ``df`` (all, if not given);
    ``unpersist`` them when they are no longer read.
    """
    model = _fit_trees(df, features, trees, sample, seed)
    scored = model.score(df, features)
    if keep is not None:
        scored = scored.select(*keep, "isolation_forest_score")
    scored = scored.persist(StorageLevel.DISK_ONLY)
    model.threshold = exact_quantile(scored, "isolation_forest_score", 1 - contamination)
    return model, model.flag(scored)


def _fit_trees(df: DataFrame, features: str, trees: int, sample: int, seed: int) -> IsolationForest:
    size = min(sample, df.count())
    depth = int(np.ceil(np.log2(max(size, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        # row order in a group is not fixed, so sort before drawing splits
        x = np.stack(pdf["values"].to_numpy())
        x = x[np.lexsort(x.T)]
        nodes = _grow(tree, x, depth, np.random.default_rng([seed, tree]))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "split", "left_node", "right_node", "length"])

    drawn = draw_samples(df, features, trees, size, seed)
    nodes = [tuple(r) for r in drawn.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).collect()]
    return IsolationForest(nodes, size)
