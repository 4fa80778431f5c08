"""Sequence windows: the rows before each row as one sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsieve.operators.ordering import exact_quantile, global_index, range_buckets


def order_events(df: DataFrame, order: list) -> DataFrame:
    """Index events from 0 in time order, over the whole table."""
    return global_index(df, order, "event_index")


def previous_rows(
    df: DataFrame, key: str | None, order: list, value: str, length: int = 10, out: str = "sequence", buckets: int | None = None
) -> DataFrame:
    """Add ``out``: ``value`` of the ``length`` rows before each row of its key, oldest
    first and nulls included; rows with fewer predecessors are dropped.

    ``key=None`` is the global order. The windows run per range of key and order, so a key of
    any size is spread, and each range receives the last rows of the ranges before it.
    """
    keys = [key] if key is not None else ["_all"]
    rows = df if key is not None else df.withColumn("_all", F.lit(0))
    rows = range_buckets(rows, keys + order, buckets)
    # the last rows of each key in each range
    latest = Window.partitionBy(*keys, "_bucket").orderBy(*[F.desc(c) for c in order])
    tails = rows.withColumn("_r", F.row_number().over(latest)).where(F.col("_r") <= length).drop("_r")
    # what precedes the first tail row of a range stems from earlier ranges only: a key
    # has at most `length` tail rows per range, so this window stays small
    item = F.struct(*dict.fromkeys([*order, value]))
    along = Window.partitionBy(*keys).orderBy(*order)
    first = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    carried = (
        tails.withColumn("_before", F.collect_list(item).over(along.rowsBetween(-length, -1)))
        .withColumn("_r", F.row_number().over(first))
        .where("_r = 1")
        .select(*keys, "_bucket", F.explode("_before").alias("_c"))
        .select(*keys, "_bucket", "_c.*", F.lit(True).alias("_carried"))
    )
    both = rows.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    # structs, since lists leave nulls out
    before = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(-length, -1)
    done = both.withColumn(out, F.collect_list(F.struct(F.col(value).alias("v"))).over(before)).where(F.size(out) == length)
    done = done.withColumn(out, F.transform(out, lambda x: x["v"]))
    return done.where(~F.col("_carried")).drop("_carried", "_bucket", "_all")


def split_by_time(df: DataFrame, ts: str, test: float = 0.2) -> DataFrame:
    """Mark the latest rows as test rows, so that no test window overlaps a training row's future."""
    edge = exact_quantile(df.select(F.unix_micros(ts).alias("t")), "t", 1 - test)
    return df.withColumn("is_test", F.unix_micros(ts) > F.lit(edge))
