"""Continuous cleaning of log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve import schema
from netsieve.functions.parsing import origin, parse_lines, parseable, record_id
from netsieve.operators.dedup import keep_first_stream
from netsieve.plans.clean import CleanOptions, enrich


def clean_stream(lines: DataFrame, options: CleanOptions | None = None, dedup_watermark: str | None = None) -> DataFrame:
    """The batch column functions on a stream of lines (``line, source_file, block_start``).

    Without ``dedup_watermark`` the plan is stateless. With it, repeats are dropped that
    arrive within that time of the first occurrence; the batch plan drops them for good.
    The watermark runs on arrival, so no record is ever late, whatever its own time says or
    if it says none. Ids are those of the batch plan after dedup: file and text.
    """
    options = options or CleanOptions()
    rows = parse_lines(lines.where(parseable(F.col("line"))), options.ref_year)
    rows = rows.withColumn("processed_at", F.current_timestamp())
    if dedup_watermark:
        rows = keep_first_stream(rows, "processed_at", dedup_watermark)
    rows = enrich(rows.withColumn("id", record_id(origin(rows), "original_message")), options)
    return options.criteria.apply(rows.select(*[f.name for f in schema.CLEANED.fields], "source_file"))


def write_stream(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str = "1 minute"):
    """Append to Parquet; ``available_now`` reads what is there and stops."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def window_counts(df: DataFrame, ts: str = "timestamp", width: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """Tumbling-window counts; on a batch the watermark has no effect."""
    counts = df.withWatermark(ts, watermark).groupBy(F.window(ts, width).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), "n")
