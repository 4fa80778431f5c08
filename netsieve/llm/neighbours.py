"""Nearest vectors by inner product: a block matrix join on int8 tiles with error bounds."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsieve.llm.store import stored, whole_groups

CANDIDATES, QUERIES = 8192, 2048  # vectors of a tile's sides, on average
EXACT_IN_FLOAT = (1 << 24) // (127 * 127)  # int8 products that a float32 sum holds exactly
_STEP = 256
TINY = 1e-290  # what scaling may lose of products next to nothing


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest other rows.

    Nearness is the inner product in double precision, summed in order of the components;
    ties go to the smaller id. Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do rows without an id; rows with a query's own id are not its
    candidates. Vectors meet only vectors of their length. Of repeated ids as queries one row
    (the smallest vector) asks; as candidates each row counts. Fewer candidates than ``k`` are
    all returned, none gives no row.

    Both sides are dealt over blocks by hash, and each pair of blocks is one tile, so equal or
    crowded vectors load no single task. A tile multiplies int8 vectors; with the norms of what
    quantisation cut off, each product has an upper and a lower bound. Pairs whose upper bound
    reaches the query's k-th largest lower bound are computed again in double, so no true
    neighbour is lost. Bounds are taken on vectors scaled by powers of two, so components of any finite size
    keep them finite; scores beyond the range of doubles are infinite or NaN, NaN ranks last, and
    pairs that may have one are all computed in double. Each tile keeps ``k`` per query, and a heap merges the tiles' lists.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("asks"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    rows = stored(rows.withColumn("dim", F.size("v")), "vectors")
    queries = rows.where("asks").groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
    n, n_queries = rows.count(), queries.count()
    across, down = max(-(-n // CANDIDATES), 1), max(-(-n_queries // QUERIES), 1)
    left = queries.withColumn("r", F.pmod(F.xxhash64("vec_id"), F.lit(down)).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    right = rows.withColumn("c", F.pmod(F.xxhash64("vec_id", "v"), F.lit(across)).cast("int")).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    columns = ("dim", "r", "c", "vec_id", "v")
    tiles = left.select(*columns, F.lit(True).alias("asks")).union(right.select(*columns, F.lit(False)))
    tiles = tiles.repartition(max(across * down, 1), "dim", "r", "c").sortWithinPartitions("dim", "r", "c")

    def compare(batches):
        for table in whole_groups(batches, "dim", "r", "c"):
            groups = table.select(["dim", "r", "c"]).to_pandas()
            for _, at in groups.groupby(["dim", "r", "c"]).indices.items():
                part = table.take(pa.array(at))
                ids = part["vec_id"].to_numpy()
                matrix = part["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
                asks = part["asks"].to_numpy()
                yield from _tile(ids[asks], matrix[asks], ids[~asks], matrix[~asks], k)

    best = tiles.mapInArrow(compare, "query_id long, vec_id long, score double")
    ordered = best.repartition("query_id").sortWithinPartitions("query_id")

    def merge(batches):
        for table in whole_groups(batches, "query_id"):
            q, v, s = (table[c].to_numpy() for c in ("query_id", "vec_id", "score"))
            cuts = np.flatnonzero(np.diff(q)) + 1
            out = []
            for lo, hi in zip([0, *cuts], [*cuts, len(q)], strict=True):
                found = zip(np.isnan(s[lo:hi]).tolist(), np.nan_to_num(-s[lo:hi], nan=0.0, posinf=np.inf, neginf=-np.inf).tolist(), v[lo:hi].tolist(), strict=True)
                top = heapq.nsmallest(k, found)
                out += [(int(q[lo]), rank, vec, float("nan") if lost else -score) for rank, (lost, score, vec) in enumerate(top, 1)]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["query_id", "rank", "vec_id", "score"])

    return ordered.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")


def _quantise(matrix):
    """Whole numbers up to 127 (kept as float32), step, norm of the rounded vectors, norm of the rest, exponent.

    Vectors are scaled by powers of two first, so that their largest component lies in [0.5, 1); the
    last result is the exponent taken off.
    """
    exponent = np.frexp(np.abs(matrix).max(axis=1))[1]
    matrix = np.ldexp(matrix, -exponent[:, None])
    step = np.abs(matrix).max(axis=1, keepdims=True) / 127
    codes = np.rint(matrix / step)
    rounded = codes * step
    rest = np.linalg.norm(matrix - rounded, axis=1)
    return codes.astype(np.float32), step[:, 0], np.linalg.norm(rounded, axis=1), rest, exponent


def _products(a, b):
    """Exact products of whole-number vectors."""
    total = 0
    for lo in range(0, a.shape[1], EXACT_IN_FLOAT):
        total = total + (a[:, lo : lo + EXACT_IN_FLOAT] @ b[:, lo : lo + EXACT_IN_FLOAT].T).astype(np.float64)
    return total


@np.errstate(over="ignore", invalid="ignore")
def _tile(query_ids, queries, ids, matrix, k):
    """The ``k`` best candidates of each query, in record batches."""
    if not len(query_ids) or not len(ids):
        return
    q_codes, q_step, q_norm, q_rest, q_exponent = _quantise(queries)
    codes, step, norm, rest, exponent = _quantise(matrix)
    whole = norm + rest
    # candidates of all sizes are compared at the size of the largest; a query's own size changes no order
    size = exponent - exponent.max()
    for lo in range(0, len(query_ids), _STEP):
        some = slice(lo, min(lo + _STEP, len(query_ids)))
        near = _products(q_codes[some], codes) * q_step[some, None] * step[None, :]
        # q.x = q^.x^ + q^.(x - x^) + (q - q^).x, with a little for rounding in double
        slack = (q_norm[some, None] * rest + q_rest[some, None] * whole) * (1 + 1e-9) + 1e-12 * (q_norm[some, None] + q_rest[some, None]) * whole
        near, slack = np.ldexp(near, size), np.ldexp(slack, size) + TINY
        own = query_ids[some, None] == ids[None, :]
        low = np.where(own, -np.inf, near - slack)
        kth = np.partition(low, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(low), -np.inf)
        # where a term may leave the range of doubles, only the score itself tells
        huge = np.isinf(np.ldexp((q_norm + q_rest)[some, None] * whole, q_exponent[some, None] + exponent))
        row, col = np.nonzero(((near + slack >= kth[:, None]) | huge) & ~own)
        score = np.zeros(len(row))
        for d in range(matrix.shape[1]):
            score += queries[some][row, d] * matrix[col, d]
        order = np.lexsort((ids[col], -score, row))  # NaN last
        row, col, score = row[order], col[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < k
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[some][row[keep]]), pa.array(ids[col[keep]]), pa.array(score[keep])], ["query_id", "vec_id", "score"]
        )
