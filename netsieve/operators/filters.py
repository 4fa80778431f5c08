"""Record filters: one criteria object compiles to one predicate."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsieve import fixed_values as V


def check_pattern(spark: SparkSession, pattern: str) -> bool:
    """Does the JVM accept this regular expression?"""
    try:
        spark.range(1).select(F.lit("").rlike(pattern)).first()
        return True
    except Exception:  # the message depends on the Spark version
        return False


@dataclass
class Criteria:
    """AND-combined conditions; an unset field does not restrict."""

    min_risk: int = 0
    max_risk: int = 0
    device_types: tuple = ()
    categories: tuple = ()
    severities: tuple = ()
    security_only: bool = False
    auth_only: bool = False
    start: datetime | None = None
    end: datetime | None = None
    has_threat: bool = False
    has_username: bool = False
    source_ip_pattern: str = ""
    hostname_pattern: str = ""

    def conditions(self, spark: SparkSession | None = None) -> list[Column]:
        out = []
        if self.min_risk > 0:
            out.append(F.col("risk_score") >= self.min_risk)
        if self.max_risk > 0:
            out.append(F.col("risk_score") <= self.max_risk)
        if self.device_types:
            out.append(F.col("device_type").isin(*self.device_types))
        if self.categories:
            out.append(F.col("event_category").isin(*self.categories))
        if self.severities:
            out.append(F.col("severity").isin(*self.severities))
        if self.security_only:
            out.append(F.col("is_security"))
        if self.auth_only:
            out.append(F.col("is_authentication"))
        # an unparsed time is older than any start and never after an end
        if self.start is not None:
            out.append(F.col("timestamp") >= F.lit(self.start))
        if self.end is not None:
            out.append(F.col("timestamp").isNull() | (F.col("timestamp") <= F.lit(self.end)))
        if self.has_threat:
            out.append(F.col("threat_name").isNotNull())
        if self.has_username:
            out.append(F.col("username").isNotNull())
        for column, pattern in (
            ("source_ip", self.source_ip_pattern),
            ("hostname", self.hostname_pattern),
        ):
            if pattern:
                if spark is not None and not check_pattern(spark, pattern):
                    out.append(F.lit(False))
                else:
                    out.append(F.coalesce(F.col(column), F.lit("")).rlike(pattern))
        return out

    def predicate(self, spark: SparkSession | None = None) -> Column:
        parts = self.conditions(spark)
        return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)

    def apply(self, df: DataFrame) -> DataFrame:
        parts = self.conditions(df.sparkSession)
        return df.where(reduce(lambda a, b: a & b, parts)) if parts else df


HIGH_RISK_SECURITY = Criteria(min_risk=50, security_only=True)
AUTHENTICATION = Criteria(auth_only=True)


def error_rows(df: DataFrame, level_col: str = "level") -> DataFrame:
    return df.where(F.col(level_col).isin(*V.ERROR_LEVELS))


def text_contains(df: DataFrame, text: str, column: str = "message") -> DataFrame:
    """Case-insensitive literal containment; null text does not match."""
    return df.where(F.lower(F.col(column)).contains(text.lower()))


def above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.where(F.col(column) > threshold)
