"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_spread(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left", salts: int = 16) -> DataFrame:
    """Join ``rows`` to ``table``, whose keys are unique.

    Rows of one key go to ``salts`` tasks, by the partition they come from, and each
    table row is copied that often.
    """
    salt = _free([*rows.columns, *table.columns], "_salt")
    left = rows.withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(salts)))
    right = table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, salt], how).drop(salt)


HOT_KEYS = 4096  # keys whose rows are met by a broadcast, at most


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], count: str, how: str = "left") -> DataFrame:
    """Join ``rows`` to ``table``, whose keys are unique and whose column ``count`` tells how many rows each has.

    At most ``HOT_KEYS`` keys can have more than that part of all rows: those few are
    broadcast, so their rows stay where they are; the others are joined by a shuffle. Both
    inputs are read twice: pass stored tables. ``count`` isn't part of the result.
    """
    total = table.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    edge = max(total // HOT_KEYS, 1000)
    hot = _free([*rows.columns, *table.columns], "_hot")
    crowded = table.where(F.col(count) > edge).drop(count).withColumn(hot, F.lit(True))
    met = rows.join(F.broadcast(crowded), keys, "inner").drop(hot)
    rest = rows.join(F.broadcast(crowded.select(*keys)), keys, "left_anti")
    return met.unionByName(rest.join(table.where(F.col(count) <= edge).drop(count), keys, how))


def _free(taken: list[str], name: str) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name
