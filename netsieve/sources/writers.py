"""Sinks: every writer is a projection plus a distributed write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve import fixed_values as V
from netsieve import schema
from netsieve.functions.render import normalized_line
from netsieve.operators import filters, profile

_CLEANED = [f.name for f in schema.CLEANED.fields]


def csv_projection(cleaned: DataFrame) -> DataFrame:
    """The fixed CSV columns; absent text is empty, absent numbers are 0, issues joined by ``;``.

    An unparsed time prints as the zero time of year 1.
    """
    kinds = {f.name: f.dataType.simpleString() for f in schema.CLEANED.fields}
    out = []
    for name in V.CSV_COLUMNS:
        col = F.col(name)
        if name == "timestamp":
            text = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
            col = F.coalesce(text, F.lit("0001-01-01 00:00:00"))
        elif name == "data_quality_issues":
            col = F.concat_ws(";", col)
        elif kinds[name] == "string":
            col = F.coalesce(col, F.lit(""))
        elif kinds[name] in ("int", "bigint"):
            col = F.coalesce(col, F.lit(0).cast(kinds[name]))
        out.append(col.alias(name))
    return cleaned.select(*out)


def write_csv(cleaned: DataFrame, path: str, mode: str = "error") -> None:
    csv_projection(cleaned).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_json(cleaned: DataFrame, path: str, mode: str = "error") -> None:
    """JSON lines with the cleaned schema; absent values are left out."""
    cleaned.select(*_CLEANED).write.mode(mode).json(path)


def write_normalized_lines(cleaned: DataFrame, path: str, mode: str = "error") -> None:
    cleaned.select(normalized_line().alias("value")).write.mode(mode).text(path)


def write_by_source_file(cleaned: DataFrame, path: str, mode: str = "error") -> None:
    """One table in one pass, a partition per input file; the whole table is the combined output.

    Rows are brought together by file, so that few output files are written; a file that holds a
    third of the rows is split over several tasks by the adaptive plan.
    """
    rows = cleaned.select(*_CLEANED, "source_file").hint("rebalance", "source_file")
    rows.write.mode(mode).partitionBy("source_file").parquet(path)


def write_subsets(cleaned: DataFrame, folder: str, mode: str = "error") -> None:
    """The two derived subsets: high-risk security events and authentication events."""
    write_json(filters.HIGH_RISK_SECURITY.apply(cleaned), f"{folder}/high_risk_security_events", mode)
    write_json(filters.AUTHENTICATION.apply(cleaned), f"{folder}/authentication_events", mode)


def cleaning_report(parsed_lines: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Report rows ``(section, name, n, percent)``: totals, distributions and field coverage."""
    totals = profile.cleaning_totals(parsed_lines)
    names = totals.columns
    long = totals.unpivot([], names, "name", "n").select(
        F.lit("totals").alias("section"), "name", "n", F.lit(None).cast("double").alias("percent")
    )
    shares = profile.distribution(cleaned, ["device_type", "event_category", "severity_name"], 1)
    fields = profile.extraction_coverage(cleaned)
    return long.unionByName(shares.withColumnRenamed("kind", "section")).unionByName(
        fields.select(
            F.lit("extracted_fields").alias("section"), F.col("field").alias("name"), "n",
            F.round("percent", 1).alias("percent"),
        )
    )


def report_text(report: DataFrame) -> DataFrame:
    """Summary lines of a report; the report has a few dozen rows."""
    share = F.when(F.col("percent").isNotNull(), F.format_string(" (%.1f%%)", "percent")).otherwise("")
    line = F.concat(F.lit("- "), F.col("name"), F.lit(": "), F.col("n").cast("string"), share)
    return report.orderBy("section", F.desc("n"), "name").select(
        F.concat_ws(" | ", F.col("section"), line).alias("value")
    )


def write_report(report: DataFrame, folder: str, mode: str = "error") -> None:
    # a few dozen rows, written twice
    report = report.coalesce(1).persist()
    try:
        report.write.mode(mode).json(f"{folder}/cleaning_report")
        report_text(report).coalesce(1).write.mode(mode).text(f"{folder}/cleaning_summary")
    finally:
        report.unpersist()


def anomaly_results(source: DataFrame, models: list[str]) -> DataFrame:
    """Input columns, one flag per model, the vote and its confidence."""
    flags = [f"{m}_anomaly" for m in models]
    helper = [f"{m}_score" for m in models] + ["features", "scaled"]
    keep = [c for c in source.columns if c not in flags + helper + ["ensemble_anomaly", "confidence"]]
    return source.select(*keep, *flags, "ensemble_anomaly", "confidence")


def write_anomaly_csv(scored: DataFrame, models: list[str], path: str, mode: str = "error") -> None:
    anomaly_results(scored, models).write.mode(mode).option("header", True).csv(path)


def write_metrics_json(frames: dict[str, DataFrame], folder: str, mode: str = "error") -> None:
    """Classification results: one small JSON folder per part (metrics, importances, insights)."""
    for name, frame in frames.items():
        frame.coalesce(1).write.mode(mode).json(f"{folder}/{name}")
