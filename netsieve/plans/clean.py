"""The cleaning plan: parse, deduplicate, classify, extract, score.

Everything before and after the keep-first step is narrow; that step is the only
shuffle. Enrichment runs after it, on survivors only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve import schema
from netsieve.functions.extraction import EXTRACTION_GROUPS, extract_fields
from netsieve.functions.parsing import origin, parse_lines, parseable, record_id
from netsieve.functions.rules import classify_messages, risk_score
from netsieve.operators.dedup import keep_first
from netsieve.operators.filters import Criteria
from netsieve.operators.ordering import occurrence_number


@dataclass
class CleanOptions:
    """What a cleaning run does. Switched-off parts drop out of the plan."""

    ref_year: int | None = None
    remove_duplicates: bool = True
    extract: tuple = EXTRACTION_GROUPS
    score: bool = True
    criteria: Criteria = field(default_factory=Criteria)
    outputs: tuple = ("json", "csv", "normalized_syslog")


CLEANED_COLUMNS = [f.name for f in schema.CLEANED.fields]
POSITION = ["source_file", "block_start", "line_seq"]


def enrich(df: DataFrame, options: CleanOptions | None = None) -> DataFrame:
    """Classify, extract and score parsed rows (batch or stream)."""
    options = options or CleanOptions()
    df = extract_fields(classify_messages(df), options.extract)
    score = risk_score() if options.score else F.lit(None).cast("int")
    return df.withColumn("risk_score", score)


def parse_table(lines: DataFrame, options: CleanOptions | None = None) -> DataFrame:
    options = options or CleanOptions()
    return parse_lines(lines, options.ref_year)


def parsed_rows(lines: DataFrame, options: CleanOptions | None = None) -> DataFrame:
    """Parsed fields of the lines that have a layout; rejects never reach the parser."""
    return parse_table(lines.where(parseable(F.col("line"))), options)


def rejected(lines: DataFrame) -> DataFrame:
    """Lines that could not be parsed, with their place."""
    return lines.where((F.length("line") > 0) & ~parseable(F.col("line"))).select(*POSITION, "line")


def clean(lines: DataFrame, options: CleanOptions | None = None) -> DataFrame:
    """Raw lines (with ``source_file, block_start, line_seq``, and ``source_path`` if known) to cleaned records.

    The result has the cleaned schema plus the line's place and ``ips``, all
    addresses of the message.
    """
    options = options or CleanOptions()
    rows = parsed_rows(lines, options)
    if options.remove_duplicates:
        rows = keep_first(rows)
        rows = rows.withColumn("id", record_id(origin(rows), "original_message"))
    else:
        # equal lines of a file are told apart by their order; the first has the id it has after dedup
        rows = rows.withColumn("_origin", origin(rows))
        rows = occurrence_number(rows, ["_origin", "original_message"], ["block_start", "line_seq"], "_again")
        number = F.when(F.col("_again") > 1, F.col("_again").cast("string"))
        rows = rows.withColumn("id", record_id("_origin", "original_message", number)).drop("_origin", "_again")
    rows = enrich(rows, options).withColumn("processed_at", F.current_timestamp())
    out = rows.select(*CLEANED_COLUMNS, *POSITION, "ips")
    return options.criteria.apply(out)
