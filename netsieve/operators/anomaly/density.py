"""Density noise flag: neither ``min_points`` rows within ``eps`` nor such a row nearby.

Only the noise flag is needed, so no clusters are connected. Work grows with the
rows in thin regions, not with pairs:

1. equal points fold to one with a multiplicity;
2. in a grid of cells with diagonal ``eps`` a cell that holds enough rows makes all
   of them core, without any distance;
3. only points of thin cells look for neighbours. Points meet in buckets of width
   ``eps`` along the principal axes; a rotation keeps distances, so all neighbours
   lie in adjacent buckets. A crowded bucket is cut along further axes, and what
   remains crowded is counted block by block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.operators.skew import join_spread
from netsieve.session import cut_lineage

# Points of one bucket that are compared with each other in one go.
BLOCK = 2000


def _point_id(values):
    return F.md5(values.cast("string"))


def _cell(values, side: float):
    return F.md5(F.transform(values, lambda v: F.floor(v / F.lit(side))).cast("string"))


def density_noise(
    df: DataFrame, features: str, eps: float = 0.5, min_points: int = 5, out: str = "dbscan_anomaly", block: int = BLOCK
) -> DataFrame:
    """Add ``out``: 1 for noise rows. A batch operator: the flag depends on all rows."""
    width = len(df.select(features).first()[0])
    axes = PCA(k=width, inputCol="v", outputCol="z").fit(df.select(F.col(features).alias("v")))
    # by values: a dense and a sparse vector of one point are one point
    distinct = df.groupBy(vector_to_array(features).alias("x")).agg(F.count(F.lit(1)).alias("mult"))
    distinct = distinct.withColumn("v", array_to_vector("x"))
    rotated = axes.transform(distinct).select("x", vector_to_array("z").alias("z"), "mult")
    # a hair below the exact side, so that rounding never joins points farther than eps
    side = eps / math.sqrt(width) * (1 - 1e-9)
    points = rotated.withColumns({"id": _point_id(F.col("x")), "_cell": _cell(F.col("x"), side)})
    points = cut_lineage(points)
    dense = points.groupBy("_cell").agg(F.sum("mult").alias("w")).where(F.col("w") >= min_points)
    points = join_spread(points, dense.select("_cell", F.lit(True).alias("core")), ["_cell"]).drop("_cell")
    points = cut_lineage(points.withColumn("core", F.coalesce("core", F.lit(False))))

    thin = points.where(~F.col("core"))
    weights = neighbour_weights(thin, points, width, eps, block)
    thin = cut_lineage(
        thin.drop("core").join(weights, "id", "left").withColumn("core", F.col("weight") >= min_points).drop("weight")
    )
    core = points.where("core").unionByName(thin.where("core"))
    border = neighbour_weights(thin.where(~F.col("core")), core, width, eps, block)
    noise = thin.where(~F.col("core")).select("id").join(border, "id", "left_anti")
    noise = noise.select(F.col("id").alias("_point"), F.lit(1).alias(out))
    # noise points have fewer than min_points copies, the hot ids are all on the left
    flagged = join_spread(df.withColumn("_point", _point_id(vector_to_array(features))), noise, ["_point"])
    return flagged.withColumn(out, F.coalesce(out, F.lit(0))).drop("_point")


def _step(axis: int, eps: float):
    # slightly wider than eps: neighbours differ by at most one step despite rounding
    return F.floor(F.col("z")[axis] / F.lit(eps * (1 + 1e-6)))


def _cut_targets(df: DataFrame, axis: int, eps: float) -> DataFrame:
    return df.withColumn("key", F.concat_ws(",", "key", _step(axis, eps).cast("string")))


def _cut_queries(df: DataFrame, axis: int, eps: float) -> DataFrame:
    here = _step(axis, eps)
    df = df.withColumn("_at", F.explode(F.array(here - 1, here, here + 1)))
    return df.withColumn("key", F.concat_ws(",", "key", F.col("_at").cast("string"))).drop("_at")


def neighbour_weights(queries: DataFrame, targets: DataFrame, width: int, eps: float, block: int = BLOCK) -> DataFrame:
    """``(id, weight)``: rows of ``targets`` within ``eps`` of each query that has any."""
    # fresh column identities: queries and targets stem from the same table
    q = queries.select(*[F.col(c).alias(c) for c in ("id", "x", "z")], F.lit("").alias("key"))
    t = targets.select("id", "x", "z", "mult", F.lit("").alias("key"))
    start = min(3, width)
    for axis in range(start):
        q, t = _cut_queries(q, axis, eps), _cut_targets(t, axis, eps)
    parts = []
    for axis in range(start, width + 1):
        sizes = t.groupBy("key").agg(F.count(F.lit(1)).alias("nt"))
        sizes = sizes.join(q.groupBy("key").agg(F.count(F.lit(1)).alias("nq")), "key")
        sizes = cut_lineage(sizes.withColumn("crowded", (F.col("nt") > block) & F.lit(axis < width)))
        parts.append(_count_pairs(q, t, sizes.where(~F.col("crowded")), eps, block))
        crowded = sizes.where("crowded").select("key")
        if axis == width or crowded.isEmpty():
            break
        q = _cut_queries(join_spread(q, crowded, ["key"], "inner"), axis, eps)
        t = _cut_targets(join_spread(t, crowded, ["key"], "inner"), axis, eps)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("id").agg(F.sum("weight").alias("weight"))


def _count_pairs(q: DataFrame, t: DataFrame, sizes: DataFrame, eps: float, block: int) -> DataFrame:
    """Count neighbours bucket by bucket; big buckets meet in blocks of bounded size."""
    blocks = sizes.select(
        "key", F.ceil(F.col("nt") / block).alias("tb"), F.ceil(F.col("nq") / block).alias("qb"),
    )
    rows = sizes.agg(F.sum(F.col("nt") + F.col("nq"))).first()[0] or 0
    # small buckets share a group, so that a group is worth its call
    groups = max(1, rows // block)
    last = lambda c: F.col(c).cast("bigint") - 1

    def grouped(df, own, other):
        mine = F.pmod(F.xxhash64("id"), F.col(own)).alias(f"_{own}")
        df = join_spread(df, blocks, ["key"], "inner")
        df = df.select("*", mine).withColumn(f"_{other}", F.explode(F.sequence(F.lit(0).cast("bigint"), last(other))))
        df = df.withColumn("sub", F.concat_ws("|", "key", "_tb", "_qb"))
        return df.withColumn("g", F.pmod(F.xxhash64("sub"), F.lit(groups)))

    limit = eps * eps

    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            by_sub = {s: p for s, p in right.groupby("sub")}
            for sub, part in left.groupby("sub"):
                if sub not in by_sub:
                    continue
                other = by_sub[sub]
                a, b = np.stack(part["qx"].to_numpy()), np.stack(other["x"].to_numpy())
                mult = other["mult"].to_numpy()
                square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
                inside = square <= limit
                # the fast form rounds: settle close calls by plain differences
                for i, j in zip(*np.nonzero(np.abs(square - limit) < 1e-6 * (1.0 + limit))):
                    inside[i, j] = ((a[i] - b[j]) ** 2).sum() <= limit
                weight = inside @ mult
                hit = weight > 0
                found.append(pd.DataFrame({"id": part["qid"].to_numpy()[hit], "weight": weight[hit]}))
        return pd.concat(found) if found else pd.DataFrame({"id": pd.Series([], dtype=str), "weight": pd.Series([], dtype="int64")})

    left = grouped(q, "qb", "tb").select("g", "sub", F.col("id").alias("qid"), F.col("x").alias("qx"))
    right = grouped(t, "tb", "qb").select("g", "sub", "x", "mult")
    return left.groupBy("g").cogroup(right.groupBy("g")).applyInPandas(count, "id string, weight bigint")
