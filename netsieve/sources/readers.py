"""Readers for raw log folders and cleaned tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsieve import schema


def _lines(raw: DataFrame) -> DataFrame:
    # one trailing carriage return belongs to the line end
    return raw.select(
        F.regexp_replace("value", r"\r$", "").alias("line"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def read_log_dir(spark: SparkSession, path: str, glob: str = "*.log") -> DataFrame:
    """Lines of all matching files with an order key.

    File name, then split start, then row id restores the order of lines: a split is
    read by one task from front to back.
    """
    raw = spark.read.option("pathGlobFilter", glob).option("lineSep", "\n").text(path)
    return _lines(raw).withColumn("line_seq", F.monotonically_increasing_id())


def stream_log_dir(spark: SparkSession, path: str, glob: str = "*.log", max_files: int | None = None) -> DataFrame:
    """The same lines as a stream; a stream has no row id, so no ``line_seq``."""
    reader = spark.readStream.option("pathGlobFilter", glob).option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _lines(reader.text(path))


def read_cleaned_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Cleaned records; columns a file lacks come back as typed nulls."""
    reader = spark.read.schema(schema.CLEANED).option("multiLine", multiline)
    return reader.json(path)


def read_metrics_json(spark: SparkSession, folder: str, parts: list[str]) -> DataFrame:
    """All parts of classification results in one table, each row with the ``part`` it is of."""
    frames = [spark.read.json(f"{folder}/{p}").select(F.lit(p).alias("part"), "*") for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
