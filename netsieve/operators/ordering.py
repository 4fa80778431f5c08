"""Total order at scale: running totals, global row numbers and exact quantiles.

A window without a partition key would pull all rows into one task. These helpers
cut the order into ranges instead, work inside each range in parallel and add the
totals of the ranges before it; only one row per range meets in one place.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsieve.session import cut_lineage

# Rank error that percentile_approx may make, as a share of the rows.
ACCURACY = 10_000


def range_buckets(df: DataFrame, order: list, buckets: int | None = None) -> DataFrame:
    """Range-partition by the order columns and store the range number as ``_bucket``.

    The ranges come from a sample, so they are stored in the checkpoint folder: two
    readers, or a retried task, must see the same cut. Order by enough columns to
    tell rows apart, and a value shared by a third of them is still spread out.
    """
    spark = df.sparkSession
    n = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return cut_lineage(df.repartitionByRange(n, *order).withColumn("_bucket", F.spark_partition_id()))


def _offsets(bucketed: DataFrame, amounts: dict[str, Column]) -> DataFrame:
    """Totals of all earlier ranges, one row per range."""
    totals = bucketed.groupBy("_bucket").agg(*[a.alias(f"_total_{k}") for k, a in amounts.items()])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_bucket", *[F.coalesce(F.sum(f"_total_{k}").over(before), F.lit(0)).alias(f"_offset_{k}") for k in amounts]
    )


def running_totals(df: DataFrame, order: list, values: dict[str, str], buckets: int | None = None) -> DataFrame:
    """Add, per entry ``name: column``, the sum of ``column`` over all earlier rows."""
    ranged = range_buckets(df, order, buckets)
    # one row per range: the number of ranges bounds what is broadcast
    offsets = F.broadcast(_offsets(ranged, {k: F.sum(c) for k, c in values.items()}))
    w = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(offsets, "_bucket")
    for name, column in values.items():
        inside = F.coalesce(F.sum(column).over(w), F.lit(0))
        out = out.withColumn(name, inside + F.col(f"_offset_{name}"))
    return out.drop("_bucket", *[f"_offset_{k}" for k in values])


def global_index(df: DataFrame, order: list, name: str = "index", buckets: int | None = None) -> DataFrame:
    """Row number from 0 in the total order."""
    ranged = range_buckets(df, order, buckets)
    offsets = F.broadcast(_offsets(ranged, {"rows": F.count(F.lit(1))}))
    w = Window.partitionBy("_bucket").orderBy(*order)
    out = ranged.join(offsets, "_bucket").withColumn(name, F.row_number().over(w) - 1 + F.col("_offset_rows"))
    return out.drop("_bucket", "_offset_rows")


def occurrence_number(df: DataFrame, keys: list[str], order: list, name: str = "number", buckets: int | None = None) -> DataFrame:
    """Number from 1 of each row among those of its key, for keys of any size.

    Rows are numbered inside a range of key and order; a key that goes over several ranges goes on
    where the range before ends. Each range begins with at most one such key, so what is
    broadcast is at most one row per range.
    """
    ranged = range_buckets(df, [*keys, *order], buckets)
    pieces = ranged.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.withColumn("_before", F.sum("_n").over(along)).where("_before is not null")
    first = carried.select("_bucket", "_before", F.struct(*keys).alias("_key"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    out = ranged.withColumn(name, inside).join(F.broadcast(first), "_bucket", "left")
    more = F.when(F.struct(*keys).eqNullSafe(F.col("_key")), F.col("_before")).otherwise(0)
    return out.withColumn(name, F.col(name) + more).select(*df.columns, name)


def exact_quantile(df: DataFrame, column: str, p: float) -> float | None:
    """Quantile with linear interpolation, exact at any size.

    One pass brackets the ranks on both sides of the position, one counts what lies below
    the bracket, and the counts of the distinct values inside are totalled up in ranges. The
    driver reads a handful of numbers.
    """
    rows = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    # one narrow column, read a few times: spills to disk rather than run its source again
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        total = rows.count()
        if total == 0:
            return None
        position = p * (total - 1)
        rank = int(position)
        ranks = [rank, min(rank + 1, total - 1)]
        cut = [max(ranks[0] / total - 3 / ACCURACY, 0.0), min((ranks[1] + 1) / total + 3 / ACCURACY, 1.0)]
        low, high = rows.agg(F.percentile_approx("v", cut, ACCURACY)).first()[0]
        below, inside = rows.agg(F.count_if(F.col("v") < low), F.count_if(F.col("v").between(low, high))).first()
        if not below <= ranks[0] <= ranks[1] < below + inside:
            raise AssertionError("quantile bracket missed its rank")
        counts = rows.where(F.col("v").between(low, high)).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        ends = running_totals(counts, ["v"], {"before": "n"}).withColumn("before", F.col("before") + below)
        hit = [(F.col("before") <= r) & (F.col("before") + F.col("n") > r) for r in ranks]
        found = ends.agg(*[F.max(F.when(h, F.col("v"))) for h in hit]).first()
        return found[0] + (found[1] - found[0]) * (position - rank)
    finally:
        rows.unpersist()
