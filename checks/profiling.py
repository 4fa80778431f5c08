"""Checks of counts, distributions, reports (H), sinks built on them (A8) and relational shapes (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.cleaning import CONTENT_CLASS_SQL, cleaned, lines, parsed, parsed_all, OPTIONS
from checks.registry import check
from checks.sql import clean_sql, derived_sql
from netsieve import fixed_values as V
from netsieve.operators import profile
from netsieve.sources import derived, writers

KEY = "md5(concat(hostname, '-', program, '-', message, '-', coalesce(severity_name, '')))"
TOTALS_SQL = f"""select (select count(*) from log_lines) as total_processed,
  (select count(distinct {KEY}) from parsed) as valid_messages,
  (select count(*) from formatted where format = 'invalid') as invalid_messages,
  (select count(*) from formatted where format = 'blank') as blank_lines,
  (select count(*) filter (contains(issues, 'unparseable_timestamp')) from parsed) as malformed_timestamps,
  (select count(*) filter (contains(issues, 'unparseable_priority')) from parsed) as invalid_priorities,
  (select count(*) filter (contains(issues, 'missing_hostname')) from parsed) as missing_hostnames,
  (select count(*) - count(distinct {KEY}) from parsed) as duplicates_removed"""


@check("h1_cleaning_totals", clean_sql(TOTALS_SQL, "parsed"))
def h1(spark, sf):
    return profile.cleaning_totals(parsed_all(spark, sf))


def _dist_sql(columns, table, digits=6):
    parts = [
        f"select '{c}' as kind, coalesce(cast({c} as varchar), '') as name, count(*) as n, "
        f"round(count(*) * 100.0::double / (select count(*) from {table}), {digits}) as percent from {table} group by {c}"
        for c in columns
    ]
    return " union all ".join(parts)


@check("h2_distributions", clean_sql(_dist_sql(["device_type", "event_category", "severity_name"], "cleaned")))
def h2(spark, sf):
    return profile.distribution(cleaned(spark, sf), ["device_type", "event_category", "severity_name"])


_COVER = " union all ".join(
    f"select '{c}' as field, count({c}) as n, round(count({c}) * 100.0::double / count(*), 6) as percent from cleaned"
    for c in V.EXTRACTED_FIELDS
)


@check("h3_extraction_coverage", clean_sql(_COVER))
def h3(spark, sf):
    return profile.extraction_coverage(cleaned(spark, sf))


@check(
    "a8_cleaning_report",
    clean_sql(
        "select 'totals' as section, name, n, cast(null as double) as percent from (unpivot ("
        + TOTALS_SQL
        + ") on columns(*) into name name value n) union all select kind as section, name, n, percent from ("
        + _dist_sql(["device_type", "event_category", "severity_name"], "cleaned", 1)
        + ") union all select 'extracted_fields' as section, field as name, n, round(percent, 1) as percent from ("
        + _COVER
        + ")"
    ),
)
def a8(spark, sf):
    return writers.cleaning_report(parsed_all(spark, sf), cleaned(spark, sf))


@check(
    "h4_record_totals",
    clean_sql(
        """select count(*) as total_messages, count(distinct hostname) as unique_hosts,
  count(distinct source_ip) as unique_source_ips, count(distinct threat_name) as unique_threat_names,
  round(avg(risk_score), 6) as avg_risk_score from cleaned"""
    ),
)
def h4(spark, sf):
    return profile.record_totals(cleaned(spark, sf))


@check(
    "h5_time_histograms",
    clean_sql(
        """select 'hour' as kind, cast(hour(ts) as varchar) as bucket, count(*) as n from cleaned group by all
union all select 'day' as kind, strftime(ts, '%Y-%m-%d') as bucket, count(*) as n from cleaned group by all"""
    ),
)
def h5(spark, sf):
    return profile.time_histograms(cleaned(spark, sf))


for _col in ("hostname", "source_ip", "threat_name"):

    def _top(col=_col):
        @check(
            f"h6_top_{col}",
            clean_sql(
                f"select {col} as name, count(*) as n from cleaned where {col} is not null group by 1 order by n desc, name limit 10"
            ),
        )
        def run(spark, sf):
            return profile.top_counts(cleaned(spark, sf), col)

    _top()


_FILES = "(select *, concat('f', line_no % 7) as source_file from cleaned)"
_TOTALS = """count(*) as total_messages, count(distinct hostname) as unique_hosts, count(distinct source_ip) as unique_source_ips,
  count(distinct threat_name) as unique_threat_names, round(avg(risk_score), 6) as avg_risk_score"""


def _profile_table(spark, sf):
    # lines dealt over seven files
    rows = cleaned(spark, sf).withColumn("source_file", F.concat(F.lit("f"), (F.col("line_no") % 7).cast("string")))
    return profile.profile_table(rows)


@check("h4_totals_by_file", clean_sql(f"select source_file, {_TOTALS} from {_FILES} group by 1"))
def h4_by_file(spark, sf):
    return profile.profile_totals(_profile_table(spark, sf), ["source_file"])


@check("h4_totals_of_all_files", clean_sql(f"select {_TOTALS} from cleaned"))
def h4_merged(spark, sf):
    return profile.profile_totals(_profile_table(spark, sf))


@check(
    "h6_top_hosts_by_file",
    clean_sql(
        f"""select source_file, name, n from (select source_file, hostname as name, count(*) as n,
  row_number() over (partition by source_file order by count(*) desc, hostname) as k from {_FILES} where hostname is not null group by 1, 2) where k <= 3"""
    ),
)
def h6_by_file(spark, sf):
    return profile.profile_top(_profile_table(spark, sf), "hostname", 3, ["source_file"])


@check(
    "h7_raw_statistics",
    clean_sql(
        f"""select kind, name, n, percent from (
  select *, row_number() over (partition by kind order by n desc, name) as rk from ({_dist_sql(["content_class", "severity", "program"], "raw")})
) where rk <= 3 or kind <> 'program'""".replace("from raw", f"from (select *, {CONTENT_CLASS_SQL} as content_class from parsed)"),
        "parsed",
    ),
)
def h7(spark, sf):
    return profile.raw_statistics(parsed(spark, sf), k=3)


@check(
    "h8_dataset_profile",
    clean_sql(
        """select count(*) as rows, count(distinct hostname) as hosts, min(normalized_time) as first_time,
  max(normalized_time) as last_time, round(avg(risk_score), 6) as risk_mean, quantile_cont(risk_score, 0.5) as risk_median,
  max(risk_score) as risk_max, min(risk_score) as risk_min from cleaned"""
    ),
)
def h8(spark, sf):
    return profile.dataset_profile(cleaned(spark, sf))


@check(
    "h9_risk_histogram",
    clean_sql(
        """select cast(least(floor((risk_score - lo) / ((hi - lo) / 20.0::double)), 19) as integer) as bin, count(*) as n,
  round(lo + least(floor((risk_score - lo) / ((hi - lo) / 20.0::double)), 19) * ((hi - lo) / 20.0::double), 6) as lower_edge
from cleaned, (select min(risk_score) as lo, max(risk_score) as hi from cleaned) group by all"""
    ),
)
def h9(spark, sf):
    return profile.histogram(cleaned(spark, sf), "risk_score")


@check("h10_hourly_counts", clean_sql("select hour(ts) as hour, count(*) as n from cleaned group by 1 order by 1"))
def h10(spark, sf):
    return profile.hourly_counts(cleaned(spark, sf)).withColumn("hour", F.col("hour").cast("bigint"))


@check("h10_security_split", clean_sql("select is_security, count(*) as n from cleaned group by 1"))
def h10b(spark, sf):
    return profile.security_split(cleaned(spark, sf))


def logs(spark, sf):
    return derived.device_logs(spark, sf)


def _logs_check(name, sql, fn):
    @check(name, derived_sql("device_logs", sql))
    def run(spark, sf):
        out = fn(logs(spark, sf))
        return out.withColumn("hour", F.col("hour").cast("bigint")) if "hour" in out.columns else out


_logs_check(
    "h11_most_active_devices",
    "select device as name, count(*) as n from device_logs group by 1 order by n desc, name limit 5",
    profile.most_active,
)
_logs_check(
    "h11_peak_hours",
    "select hour(ts) as hour, count(*) as n from device_logs group by 1 order by n desc, hour limit 3",
    profile.peak_hours,
)
_logs_check(
    "h12_errors_by_category",
    "select category, count(*) as n from device_logs where level in ('ERROR', 'CRITICAL') group by 1",
    profile.errors_by_category,
)
_logs_check(
    "h13_flapping",
    "select device, message, count(*) as n from device_logs where message ilike '%changed state%' group by 1, 2 having count(*) > 2",
    profile.flapping,
)
_logs_check(
    "h14_instability_by_hour",
    "select hour(ts) as hour, count(*) as n from device_logs where message ilike '%bgp%' group by 1",
    profile.instability_by_hour,
)
_logs_check(
    "h15_insight_report",
    """select 'period' as section, strftime(min(ts), '%Y-%m-%d %H:%M:%S') || ' to ' || strftime(max(ts), '%Y-%m-%d %H:%M:%S') as name,
  cast(null as bigint) as n, cast(null as double) as percent from device_logs
union all select 'total', 'rows', count(*), null from device_logs
union all select 'total', 'devices', count(distinct device), null from device_logs
union all select 'total', 'critical', count(*) filter (level = 'CRITICAL'), null from device_logs
union all select 'severity', level, count(*), round(count(*) * 100.0::double / (select count(*) from device_logs), 1) from device_logs group by level
union all select 'critical', category, count(*), null from device_logs where level = 'CRITICAL' group by category
union all select * from (select 'category', category, count(*) as n, round(count(*) * 100.0::double / (select count(*) from device_logs), 1)
  from device_logs group by category order by n desc, category limit 5)""",
    profile.insight_report,
)
_logs_check(
    "h16_recommendations",
    """select rule, cast(value as double) as value, round(cast(limit_value as double), 6) as limit_value, value > limit_value as fired from (
  select 'high_error_rate' as rule, count(*) filter (level in ('ERROR', 'CRITICAL'))::double as value, count(*) * 0.1::double as limit_value from device_logs
  union all select 'interface_issues', count(*) filter (category = 'interface_down')::double, 50::double from device_logs
  union all select 'bgp_instability', count(*) filter (category = 'bgp_issues')::double, 20::double from device_logs
  union all select 'activity_spike', max(c)::double, avg(c) * 3 from (select count(*) as c from device_logs group by hour(ts)))""",
    profile.recommendations,
)
_logs_check(
    "h20_hourly_extremes",
    """select round(avg(n), 6) as mean_per_hour, max(n) as max_per_hour,
  (select cast(hour(ts) as integer) from device_logs group by hour(ts) order by count(*) desc, hour(ts) limit 1) as peak_hour
from (select count(*) as n from device_logs group by hour(ts))""",
    profile.hourly_extremes,
)
_logs_check(
    "h18_class_distribution",
    _dist_sql(["category"], "device_logs"),
    lambda df: profile.class_distribution(df, "category"),
)
_logs_check(
    "h19_first_anomalies_per_source",
    """select device, event_id, level from (select *, row_number() over (partition by device order by ts, event_id) as rk
  from device_logs where true_label = 1) where rk <= 3""",
    lambda df: profile.first_per_source(df.where("true_label = 1"), "device", ["ts", "event_id"]).select(
        "device", "event_id", "level"
    ),
)

# byte volume stands in for a model score, which SQL cannot produce
_SCORED = (
    "scored",
    "select *, least(byte_count / 12500.0::double, 1.0) as anomaly_score from security_events",
)


@check(
    "h17_score_summary",
    derived_sql(
        "security_events",
        """select count(*) as total_logs, count(*) filter (is_anomaly = 1) as anomalies, count(*) filter (is_anomaly <> 1) as normal_logs,
  round(count(*) filter (is_anomaly = 1) * 100.0::double / count(*), 2) as anomaly_rate,
  count(*) filter (anomaly_score > 0.8) as high_risk from scored""",
        _SCORED,
    ),
)
def h17(spark, sf):
    scored = derived.security_events(spark, sf).withColumn(
        "anomaly_score", F.least(F.col("byte_count") / F.lit(12500.0), F.lit(1.0))
    )
    return profile.score_summary(scored)


# --- P: relational shapes ----------------------------------------------------------


@check(
    "p1_lookup_join",
    clean_sql(
        """select s.name as severity, count(*) as n from cleaned c join (values (0, 'Emergency'), (1, 'Alert'), (2, 'Critical'),
  (3, 'Error'), (4, 'Warning'), (5, 'Notice'), (6, 'Info'), (7, 'Debug')) s(code, name) on s.code = c.severity group by 1"""
    ),
)
def p1(spark, sf):
    # eight fixed rows
    names = spark.createDataFrame(list(enumerate(V.SEVERITY_NAMES)), "severity_code int, name string")
    rows = cleaned(spark, sf)
    joined = rows.join(F.broadcast(names), rows.severity == names.severity_code)
    return joined.groupBy(F.col("name").alias("severity")).agg(F.count("*").alias("n"))


@check(
    "p2_union_sources",
    clean_sql(
        """select source, count(*) as n from (select 'log' as source, ts from cleaned union all
  select 'event' as source, ts from events) group by 1"""
    ),
)
def p2(spark, sf):
    logs_part = cleaned(spark, sf).select(F.lit("log").alias("source"), F.col("timestamp").alias("ts"))
    events = derived.security_events(spark, sf).select(F.lit("event").alias("source"), "ts")
    return logs_part.unionByName(events).groupBy("source").agg(F.count("*").alias("n"))


@check("p3_distinct_addresses", clean_sql("select distinct unnest(ips) as ip from cleaned"))
def p3(spark, sf):
    return cleaned(spark, sf).select(F.explode("ips").alias("ip")).distinct()


@check(
    "p4_sorted_counts",
    derived_sql("device_logs", "select device, count(*) as n from device_logs group by 1 order by n desc, device"),
)
def p4(spark, sf):
    return logs(spark, sf).groupBy("device").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "device")


@check(
    "p5_top_with_ties",
    derived_sql(
        "device_logs",
        "select device, n from (select *, rank() over (order by n desc) as rk from (select device, count(*) as n from device_logs group by 1)) where rk <= 5",
    ),
)
def p5(spark, sf):
    # devices are counted first; the fifth count is the cut, ties stay
    counts = logs(spark, sf).groupBy("device").agg(F.count("*").alias("n"))
    fifth = counts.select("n").orderBy(F.desc("n")).limit(5).collect()[-1][0]
    return counts.where(F.col("n") >= fifth)


@check(
    "p6_derived_columns",
    derived_sql(
        "flows",
        "select src_ip as source, dst_ip as destination, bytes, packets, bytes / packets as mean_packet from flows",
    ),
)
def p6(spark, sf):
    return derived.flows(spark, sf).select(
        F.col("src_ip").alias("source"), F.col("dst_ip").alias("destination"), "bytes", "packets",
        (F.col("bytes") / F.col("packets")).alias("mean_packet"),
    )


@check(
    "p7_attached_predictions",
    derived_sql("device_logs", "select event_id, device, level, cast(level in ('ERROR', 'CRITICAL') as integer) as predicted, true_label from device_logs"),
)
def p7(spark, sf):
    return logs(spark, sf).select(
        "event_id", "device", "level", F.col("level").isin(*V.ERROR_LEVELS).cast("int").alias("predicted"), "true_label"
    )
