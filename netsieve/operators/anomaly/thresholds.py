"""Quantile flags, z-scores and the majority vote."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.operators.encode import population_stats
from netsieve.operators.ordering import exact_quantile


def flag_above(df: DataFrame, score: str, flag: str, p: float, exact: bool = True) -> DataFrame:
    """1 where the score exceeds its p-quantile; ``exact=False`` takes the one-pass estimate."""
    if exact:
        edge = exact_quantile(df, score, p)
    else:
        edge = df.agg(F.percentile_approx(score, p, 10_000)).first()[0]
    return df.withColumn(flag, (F.col(score) > F.lit(edge)).cast("int"))


def z_scores(df: DataFrame, column: str, out: str = "z_score", limit: float = 3.0) -> DataFrame:
    mean, dev = population_stats(df, [column])[column]
    centred = F.col(column) - F.lit(mean)
    z = centred / F.lit(dev) if dev else centred * 0
    return df.withColumn(out, z).withColumn(f"{out}_outlier", (F.abs(out) > limit).cast("int"))


def vote(df: DataFrame, flags: list[str]) -> DataFrame:
    """``ensemble_anomaly`` if at least half the models agree; ``confidence`` is their share."""
    total = reduce(lambda a, b: a + b, [F.col(f) for f in flags])
    return df.withColumns(
        {
            "ensemble_anomaly": (total >= len(flags) / 2).cast("int"),
            "confidence": total / F.lit(float(len(flags))),
        }
    )
