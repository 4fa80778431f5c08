"""Counts, distributions, top-k lists and reports over cleaned or device logs.

Every function is one pass with map-side partial aggregation, so a value that
holds a third of all rows costs one partial row per task. Windows appear only
over already aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsieve import fixed_values as V
from netsieve.functions.parsing import is_parsed
from netsieve.functions.rules import content_class
from netsieve.operators.dedup import content_key


def _count():
    return F.count(F.lit(1)).alias("n")


def _percent(part: Column, whole: Column, digits: int = 6) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), digits)


# --- cleaning counters ---------------------------------------------------------


def issue_counters(parsed: DataFrame) -> DataFrame:
    def has(issue):
        return F.count_if(F.array_contains("data_quality_issues", issue))

    return parsed.agg(
        has(V.ISSUE_TIMESTAMP).alias("malformed_timestamps"),
        has(V.ISSUE_PRIORITY_PARSE).alias("invalid_priorities"),
        has(V.ISSUE_HOSTNAME).alias("missing_hostnames"),
    )


def cleaning_totals(all_lines: DataFrame) -> DataFrame:
    """One row of run totals from parsed lines of every format."""
    key = F.when(is_parsed(), content_key())
    out = all_lines.withColumn("_key", key).agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_distinct("_key").alias("valid_messages"),
        F.count_if(F.col("format") == "invalid").alias("invalid_messages"),
        F.count_if(F.col("format") == "blank").alias("blank_lines"),
        F.count("_key").alias("_parsed"),
        F.count_if(F.array_contains("data_quality_issues", V.ISSUE_TIMESTAMP)).alias("malformed_timestamps"),
        F.count_if(F.array_contains("data_quality_issues", V.ISSUE_PRIORITY_PARSE)).alias("invalid_priorities"),
        F.count_if(F.array_contains("data_quality_issues", V.ISSUE_HOSTNAME)).alias("missing_hostnames"),
    )
    return out.withColumn("duplicates_removed", F.col("_parsed") - F.col("valid_messages")).drop("_parsed")


def duplicates_by_file(parsed: DataFrame) -> DataFrame:
    """Parsed, kept and removed rows per file; the file that sorts first keeps a record.

    Two aggregates that fold on the map side: no task gathers the files of a record.
    """
    rows = parsed.select(content_key().alias("_key"), "source_file")
    read = rows.groupBy("source_file").agg(_count().alias("parsed"))
    kept = rows.groupBy("_key").agg(F.min("source_file").alias("source_file")).groupBy("source_file").agg(_count().alias("kept"))
    both = read.join(kept, "source_file", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    return both.withColumn("removed", F.col("parsed") - F.col("kept"))


# --- distributions ----------------------------------------------------------------


def distribution(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """``(kind, name, n, percent)`` of several columns from one scan."""
    text = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    counts = text.unpivot([], columns, "kind", "name").groupBy("kind", "name").agg(_count())
    # one row per column of the request; a window would gather all values of a kind in one task
    totals = F.broadcast(counts.groupBy("kind").agg(F.sum("n").alias("_whole")))
    shares = counts.join(totals, "kind").withColumn("percent", _percent(F.col("n"), F.col("_whole"), digits))
    return shares.drop("_whole")


def extraction_counts(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(*[F.count(c).alias(c) for c in V.EXTRACTED_FIELDS])


def extraction_coverage(cleaned: DataFrame) -> DataFrame:
    """``(field, n, percent)`` for each extracted field."""
    one = cleaned.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in V.EXTRACTED_FIELDS])
    long = one.unpivot(["_rows"], V.EXTRACTED_FIELDS, "field", "n")
    return long.select("field", "n", _percent(F.col("n"), F.col("_rows")).alias("percent"))


def record_totals(cleaned: DataFrame, exact: bool = True) -> DataFrame:
    """Totals, distinct hosts, source addresses and threats, and the mean risk."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    return cleaned.agg(
        F.count(F.lit(1)).alias("total_messages"),
        distinct("hostname").alias("unique_hosts"),
        distinct("source_ip").alias("unique_source_ips"),
        distinct("threat_name").alias("unique_threat_names"),
        F.round(F.avg("risk_score"), 6).alias("avg_risk_score"),
    )


PROFILED = ("device_type", "event_category", "severity_name", "hostname", "source_ip", "threat_name")


def profile_table(cleaned: DataFrame, columns=PROFILED, by: str = "source_file") -> DataFrame:
    """``(source_file, section, name, n, risk)``: partial results that merge, from one pass.

    A row counts once in the section ``record``, where ``risk`` sums the scores and ``scored``
    counts them, and once in the section of each column that it has a value for. Reports of
    any file and of all together follow by adding rows, so store the table and read it for each.
    A file, or a value, that holds a third of all rows folds before the shuffle.
    """
    parts = [F.struct(F.lit("record").alias("section"), F.lit(None).cast("string").alias("name"), F.col("risk_score").cast("long").alias("risk"))]
    none = F.lit(None).cast("long").alias("risk")
    for c in columns:
        part = F.struct(F.lit(c).alias("section"), F.col(c).cast("string").alias("name"), none)
        parts.append(F.when(F.col(c).isNotNull(), part))
    long = cleaned.select(F.col(by), F.inline(F.array_compact(F.array(*parts))))
    return long.groupBy(by, "section", "name").agg(_count(), F.sum("risk").alias("risk"), F.count("risk").alias("scored"))


def merged_profile(table: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A profile table with its files added up, for each value of ``by`` (default: all together)."""
    sums = [F.sum(c).alias(c) for c in ("n", "risk", "scored")]
    return table.groupBy(*(by or []), "section", "name").agg(*sums)


def profile_totals(table: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The numbers of :func:`record_totals` from a profile table, of all files or by file."""
    merged = merged_profile(table, by)

    def distinct(section):
        return F.count_if((F.col("section") == section) & F.col("name").isNotNull())

    record = F.col("section") == "record"
    return merged.groupBy(*(by or [])).agg(
        F.sum(F.when(record, F.col("n"))).alias("total_messages"),
        distinct("hostname").alias("unique_hosts"),
        distinct("source_ip").alias("unique_source_ips"),
        distinct("threat_name").alias("unique_threat_names"),
        F.round(F.try_divide(F.sum(F.when(record, F.col("risk"))), F.sum(F.when(record, F.col("scored")))), 6).alias("avg_risk_score"),
    )


def profile_top(table: DataFrame, section: str, k: int = 10, by: list[str] | None = None) -> DataFrame:
    """The ``k`` most frequent values of a section, ties by name, of all files or by file."""
    merged = merged_profile(table.where(F.col("section") == section), by)
    if not by:
        return merged.select("name", "n").orderBy(F.desc("n"), "name").limit(k)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "name"))
    return merged.withColumn("_place", place).where(F.col("_place") <= k).select(*by, "name", "n")


def time_histograms(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Hour-of-day and per-day counts in one pass; unparsed times form the null bucket."""
    parts = df.select(
        F.hour(ts).cast("string").alias("hour"), F.to_date(ts).cast("string").alias("day")
    )
    return (
        parts.unpivot([], ["hour", "day"], "kind", "bucket").groupBy("kind", "bucket").agg(_count())
    )


def top_counts(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values, ties by name; absent values do not count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("name"))
        .agg(_count())
        .orderBy(F.desc("n"), "name")
        .limit(k)
    )


def raw_statistics(parsed: DataFrame, k: int = 10) -> DataFrame:
    """Content classes, severities and the k top programs with shares, one scan.

    The limit cuts programs only.
    """
    rows = parsed.withColumn("_low", F.lower("message")).select(
        content_class("_low").alias("content_class"), "severity", "program"
    )
    counts = distribution(rows, ["content_class", "severity", "program"])
    programs = counts.where("kind = 'program'").orderBy(F.desc("n"), "name").limit(k)
    return counts.where("kind <> 'program'").unionByName(programs)


def dataset_profile(cleaned: DataFrame) -> DataFrame:
    """Row count, hosts, time range and risk statistics.

    The exact median keeps one counter per distinct score, at most 101 of them.
    """
    return cleaned.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("hostname").alias("hosts"),
        F.min("normalized_time").alias("first_time"),
        F.max("normalized_time").alias("last_time"),
        F.round(F.avg("risk_score"), 6).alias("risk_mean"),
        F.median("risk_score").alias("risk_median"),
        F.max("risk_score").alias("risk_max"),
        F.min("risk_score").alias("risk_min"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20, bounds=None) -> DataFrame:
    """Equal-width bins between the smallest and largest value, the last bin closed."""
    value = F.col(column).cast("double")
    if bounds is None:
        bounds = df.agg(F.min(value), F.max(value)).first()
    low, high = (float(b) if b is not None else 0.0 for b in bounds)
    if high == low:
        low, high = low - 0.5, high + 0.5
    number = F.least(F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    return (
        df.where(value.isNotNull())
        .groupBy((number - 1).cast("int").alias("bin"))
        .agg(_count())
        .withColumn("lower_edge", F.round(F.lit(low) + F.col("bin") * F.lit((high - low) / bins), 6))
    )


def hourly_counts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.groupBy(F.hour(ts).alias("hour")).agg(_count()).orderBy("hour")


def security_split(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("is_security").agg(_count())


# --- device-log patterns ------------------------------------------------------------


def most_active(df: DataFrame, column: str = "device", k: int = 5) -> DataFrame:
    return top_counts(df, column, k)


def peak_hours(df: DataFrame, ts: str = "ts", k: int = 3) -> DataFrame:
    counts = df.groupBy(F.hour(ts).alias("hour")).agg(_count())
    return counts.orderBy(F.desc("n"), "hour").limit(k)


def errors_by_category(df: DataFrame, level: str = "level") -> DataFrame:
    return df.where(F.col(level).isin(*V.ERROR_LEVELS)).groupBy("category").agg(_count())


def flapping(df: DataFrame, more_than: int = 2) -> DataFrame:
    """(device, message) pairs of state changes seen more than twice."""
    hits = df.where(F.lower("message").contains("changed state"))
    return hits.groupBy("device", "message").agg(_count()).where(F.col("n") > more_than)


def instability_by_hour(df: DataFrame, word: str = "bgp", ts: str = "ts") -> DataFrame:
    hits = df.where(F.lower("message").contains(word))
    return hits.groupBy(F.hour(ts).alias("hour")).agg(_count())


def hourly_extremes(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Mean and max of the hourly counts and the hour of the max (the earliest on a tie)."""
    hours = df.groupBy(F.hour(ts).alias("hour")).agg(_count())
    return hours.agg(
        F.round(F.avg("n"), 6).alias("mean_per_hour"),
        F.max("n").alias("max_per_hour"),
        F.max_by("hour", F.struct(F.col("n"), -F.col("hour"))).alias("peak_hour"),
    )


def insight_report(df: DataFrame, level: str = "level", ts: str = "ts", top_categories: int = 5) -> DataFrame:
    """``(section, name, n, percent)``: period, totals, shares and the critical breakdown.

    Every section is a row of the same unpivoted count: the input is read once for
    counts and once for the period and distinct devices.
    """
    critical = F.when(F.col(level) == "CRITICAL", F.col("category"))
    base = df.select(F.col(level).alias("severity"), "category", critical.alias("critical"))
    counts = base.unpivot([], ["severity", "category", "critical"], "section", "name")
    counts = counts.groupBy("section", "name").agg(_count())
    # every input row counts once per section, missing names included: the sum is the row count
    # three sections, so three rows to broadcast
    counts = counts.join(F.broadcast(counts.groupBy("section").agg(F.sum("n").alias("_all"))), "section").where("name is not null")
    share = F.when(F.col("section") != "critical", _percent(F.col("n"), F.col("_all"), 1))
    shares = counts.select("section", "name", "n", share.alias("percent"))
    categories = shares.where("section = 'category'").orderBy(F.desc("n"), "name").limit(top_categories)
    shares = shares.where("section <> 'category'").unionByName(categories)
    one = df.agg(
        F.date_format(F.min(ts), "yyyy-MM-dd HH:mm:ss").alias("from"),
        F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss").alias("to"),
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("device").alias("devices"),
        F.count_if(F.col(level) == "CRITICAL").alias("critical"),
    )
    heads = one.select(
        F.explode(
            F.array(
                F.struct(F.lit("period").alias("section"), F.concat_ws(" to ", "from", "to").alias("name"), F.lit(None).cast("bigint").alias("n")),
                F.struct(F.lit("total").alias("section"), F.lit("rows").alias("name"), F.col("rows").alias("n")),
                F.struct(F.lit("total").alias("section"), F.lit("devices").alias("name"), F.col("devices").alias("n")),
                F.struct(F.lit("total").alias("section"), F.lit("critical").alias("name"), F.col("critical").alias("n")),
            )
        ).alias("r")
    ).select("r.*", F.lit(None).cast("double").alias("percent"))
    return heads.unionByName(shares)


def recommendations(df: DataFrame, level: str = "level", ts: str = "ts") -> DataFrame:
    """One row per recommendation rule with its measured value, limit and outcome."""
    by_hour = df.groupBy(F.hour(ts).alias("hour")).agg(
        _count(),
        F.count_if(F.col(level).isin(*V.ERROR_LEVELS)).alias("errors"),
        F.count_if(F.col("category") == "interface_down").alias("down"),
        F.count_if(F.col("category") == "bgp_issues").alias("bgp"),
    )
    one = by_hour.agg(
        F.sum("n").alias("rows"), F.sum("errors").alias("errors"), F.sum("down").alias("down"),
        F.sum("bgp").alias("bgp"), F.max("n").alias("top"), F.avg("n").alias("mean"),
    )

    def rule(name, value, limit):
        return F.struct(
            F.lit(name).alias("rule"), value.cast("double").alias("value"),
            F.round(limit.cast("double"), 6).alias("limit_value"), (value > limit).alias("fired"),
        )

    rules = F.array(
        rule("high_error_rate", F.col("errors"), F.col("rows") * V.ERROR_SHARE_LIMIT),
        rule("interface_issues", F.col("down"), F.lit(V.INTERFACE_DOWN_LIMIT)),
        rule("bgp_instability", F.col("bgp"), F.lit(V.BGP_ISSUE_LIMIT)),
        rule("activity_spike", F.col("top"), F.col("mean") * V.HOUR_SPIKE_FACTOR),
    )
    return one.select(F.explode(rules).alias("r")).select("r.*")


# --- scored rows ----------------------------------------------------------------------


def score_summary(scored: DataFrame, flag: str = "is_anomaly", score: str = "anomaly_score") -> DataFrame:
    """Totals of a scored batch and the count above the high-risk score."""
    return scored.agg(
        F.count(F.lit(1)).alias("total_logs"),
        F.count_if(F.col(flag) == 1).alias("anomalies"),
        F.count_if(F.col(flag) != 1).alias("normal_logs"),
        _percent(F.count_if(F.col(flag) == 1), F.count(F.lit(1)), 2).alias("anomaly_rate"),
        F.count_if(F.col(score) > V.HIGH_RISK_SCORE).alias("high_risk"),
    )


def high_risk(scored: DataFrame, score: str = "anomaly_score") -> DataFrame:
    return scored.where(F.col(score) > V.HIGH_RISK_SCORE)


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    return distribution(df.na.drop(subset=[target]), [target])


def first_per_source(df: DataFrame, source: str, order: list, k: int = 3) -> DataFrame:
    """First k rows per source; the group limit keeps k rows per task before the shuffle."""
    w = Window.partitionBy(source).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")
