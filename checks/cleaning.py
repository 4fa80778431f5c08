"""Checks of reading, parsing, dedup, classification, extraction, scoring and filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import check
from checks.sql import clean_sql, derived_sql
from netsieve import fixed_values as V
from netsieve.functions import extraction, parsing, render, rules
from netsieve.operators import dedup, filters, profile
from netsieve.plans.clean import CleanOptions, clean, parse_table, parsed_rows, rejected
from netsieve.sources import derived, writers

OPTIONS = CleanOptions(ref_year=derived.REF_YEAR)


def lines(spark, sf):
    return derived.log_lines(spark, sf)


def parsed_all(spark, sf):
    return parse_table(lines(spark, sf), OPTIONS).withColumnRenamed("line_seq", "line_no")


def parsed(spark, sf):
    return parsed_rows(lines(spark, sf), OPTIONS).withColumnRenamed("line_seq", "line_no")


def survivors(spark, sf):
    rows = parsed_rows(lines(spark, sf), OPTIONS)
    return dedup.keep_first(rows).withColumnRenamed("line_seq", "line_no")


def cleaned(spark, sf):
    return clean(lines(spark, sf), OPTIONS).withColumnRenamed("line_seq", "line_no")


def big(col):
    return F.col(col).cast("bigint")


@check(
    "flagship_category_risk",
    clean_sql(
        "select event_category, count(*) as n, round(avg(risk_score), 6) as mean_risk "
        "from cleaned group by event_category"
    ),
)
def flagship(spark, sf):
    return cleaned(spark, sf).groupBy("event_category").agg(
        F.count("*").alias("n"), F.round(F.avg("risk_score"), 6).alias("mean_risk")
    )


# --- A: sources and sinks ----------------------------------------------------


@check("a1_scan_lines", derived_sql("log_lines", "select line_no, line from log_lines"))
def a1(spark, sf):
    return lines(spark, sf).select(F.col("line_seq").alias("line_no"), "line")


_CSV_SQL = clean_sql(
    """select id, strftime(ts, '%Y-%m-%d %H:%M:%S') as "timestamp", coalesce(normalized_time, '') as normalized_time,
  facility, severity, coalesce(severity_name, '') as severity_name, priority, hostname, program, pid, message,
  device_type, event_category, event_subcategory, coalesce(source_ip, '') as source_ip,
  coalesce(destination_ip, '') as destination_ip, cast(0 as integer) as source_port,
  coalesce(destination_port, 0) as destination_port, coalesce(protocol, '') as protocol,
  coalesce(username, '') as username, coalesce(interface, '') as interface, coalesce(threat_name, '') as threat_name,
  coalesce(bgp_peer, '') as bgp_peer, coalesce(as_number, 0) as as_number, coalesce(ospf_area, '') as ospf_area,
  risk_score, is_security, is_authentication, is_network_event, is_system_event, issues as data_quality_issues
from (select * replace (coalesce(ts, timestamp '0001-01-01 00:00:00') as ts) from cleaned)"""
)


@check("a4_csv_projection", _CSV_SQL)
def a4(spark, sf):
    return writers.csv_projection(cleaned(spark, sf))


@check(
    "a5_normalized_lines",
    clean_sql(
        """select line_no, concat('<', priority, '>1 ', coalesce(normalized_time, ''), ' ', hostname, ' ', program, ' ', pid,
  ' - [meta device_type="', device_type, '" event_category="', event_category, '" risk_score="', risk_score, '"] ', message) as line
from cleaned"""
    ),
)
def a5(spark, sf):
    return cleaned(spark, sf).select("line_no", render.normalized_line().alias("line"))


@check(
    "a7_high_risk_security",
    clean_sql("select id, hostname, message, risk_score from cleaned where risk_score >= 50 and is_security"),
)
def a7_security(spark, sf):
    return filters.HIGH_RISK_SECURITY.apply(cleaned(spark, sf)).select("id", "hostname", "message", "risk_score")


@check("a7_authentication_events", clean_sql("select id, hostname, message, username from cleaned where is_authentication"))
def a7_auth(spark, sf):
    return filters.AUTHENTICATION.apply(cleaned(spark, sf)).select("id", "hostname", "message", "username")


@check(
    "a10_rfc3164_lines",
    clean_sql(
        """select line_no, concat('<', facility * 8 + severity, '>', coalesce(strftime(ts, '%b %d %H:%M:%S'), ''), ' ', hostname, ' ', program,
  '[', pid, ']: ', message) as line from parsed""",
        "parsed",
    ),
)
def a10(spark, sf):
    time = F.coalesce(F.date_format("timestamp", "MMM dd HH:mm:ss"), F.lit(""))
    return parsed(spark, sf).select("line_no", render.rfc3164_line(time).alias("line"))


@check(
    "a11_rfc5424_lines",
    clean_sql(
        """select line_no, concat('<', facility * 8 + severity, '>1 ', coalesce(normalized_time, ''), ' ', hostname, ' ', program,
  ' ', pid, ' - - ', message) as line from parsed""",
        "parsed",
    ),
)
def a11(spark, sf):
    time = F.coalesce(F.col("normalized_time"), F.lit(""))
    return parsed(spark, sf).select("line_no", render.rfc5424_line(time).alias("line"))


@check(
    "a14_clean_options",
    clean_sql(
        """select line_no, source_ip, cast(null as varchar) as username, risk_score, event_category
from cleaned where event_category = 'security'"""
    ),
)
def a14(spark, sf):
    options = CleanOptions(
        ref_year=derived.REF_YEAR,
        extract=("ips", "ports", "threat_names"),
        criteria=filters.Criteria(categories=("security",)),
    )
    out = clean(lines(spark, sf), options).withColumnRenamed("line_seq", "line_no")
    return out.select("line_no", "source_ip", "username", "risk_score", "event_category")


# --- B: parse and validate ---------------------------------------------------

# every parsed line comes back; lines of another layout carry nulls

_FIELDS = ["pri", "time_text", "host", "program", "pid_text", "message"]


def _layout_sql(fmt):
    columns = ", ".join(f"case when format = '{fmt}' then {c} end as {c}" for c in _FIELDS)
    return clean_sql(f"select line_no, format, {columns} from fields", "fields")


def _layout(spark, sf, fmt):
    valid = lines(spark, sf).where(parsing.parseable(F.col("line")))
    rows = parsing.split_lines(valid).withColumnsRenamed(
        {"line_seq": "line_no", "_pri": "pri", "_time": "time_text", "_host": "host", "_pid": "pid_text"}
    )
    return rows.select("line_no", "format", *[F.when(F.col("format") == fmt, F.col(c)).alias(c) for c in _FIELDS])


@check("b1_rfc5424_match", _layout_sql("rfc5424"))
def b1(spark, sf):
    return _layout(spark, sf, "rfc5424")


@check("b2_rfc3164_match", _layout_sql("rfc3164"))
def b2(spark, sf):
    return _layout(spark, sf, "rfc3164")


@check("b3_fallback_match", _layout_sql("fallback"))
def b3(spark, sf):
    return _layout(spark, sf, "fallback")


@check("b4_line_formats", clean_sql("select format, count(*) as n from formatted group by format", "formatted"))
def b4_formats(spark, sf):
    return parsed_all(spark, sf).groupBy("format").agg(F.count("*").alias("n"))


@check("b4_rejected_lines", clean_sql("select line_no, line from formatted where format = 'invalid'", "formatted"))
def b4_rejects(spark, sf):
    return rejected(lines(spark, sf)).select(F.col("line_seq").alias("line_no"), "line")


def _column_check(name, columns, sql_columns=None, stage="parsed"):
    @check(name, clean_sql(f"select line_no, {sql_columns or ', '.join(columns)} from {stage}", stage))
    def run(spark, sf):
        source = {"parsed": parsed, "cleaned": cleaned}[stage]
        return source(spark, sf).select("line_no", *columns)


_column_check("b5_priority_decode", ["priority", "facility", "severity", "severity_name"])
_column_check("b8_normalized_time", ["normalized_time"])
_column_check("b9_hostname", ["hostname"])
_column_check("b10_pid", ["pid"])


def _time_check(name, fmt):
    @check(name, clean_sql(f"select line_no, case when format = '{fmt}' then epoch_us(ts) end as micros from parsed", "parsed"))
    def run(spark, sf):
        micros = F.when(F.col("format") == fmt, F.unix_micros("timestamp"))
        return parsed(spark, sf).select("line_no", micros.alias("micros"))


_time_check("b6_rfc3164_time", "rfc3164")
_time_check("b7_rfc5424_time", "rfc5424")


@check("b11_quality_issues", clean_sql("select line_no, issues from parsed", "parsed"))
def b11(spark, sf):
    return parsed(spark, sf).select("line_no", F.concat_ws(";", "data_quality_issues").alias("issues"))


@check("b12_record_id", clean_sql("select line_no, id from cleaned"))
def b12(spark, sf):
    return cleaned(spark, sf).select("line_no", "id")


@check(
    "b13_issue_counters",
    clean_sql(
        """select count(*) filter (contains(issues, 'unparseable_timestamp')) as malformed_timestamps,
  count(*) filter (contains(issues, 'unparseable_priority')) as invalid_priorities,
  count(*) filter (contains(issues, 'missing_hostname')) as missing_hostnames from parsed""",
        "parsed",
    ),
)
def b13(spark, sf):
    return profile.issue_counters(parsed(spark, sf))


# --- C: deduplication ----------------------------------------------------------


@check("c1_keep_first", clean_sql("select line_no, hostname, program, message, severity_name from survivors", "survivors"))
def c1(spark, sf):
    return survivors(spark, sf).select("line_no", "hostname", "program", "message", "severity_name")


@check(
    "c2_duplicates_removed",
    clean_sql(
        """select 'events.log' as source_file, count(*) as parsed,
  count(distinct md5(concat(hostname, '-', program, '-', message, '-', coalesce(severity_name, '')))) as kept,
  count(*) - count(distinct md5(concat(hostname, '-', program, '-', message, '-', coalesce(severity_name, '')))) as removed
from parsed""",
        "parsed",
    ),
)
def c2(spark, sf):
    rows = parsed_rows(lines(spark, sf), OPTIONS)
    return profile.duplicates_by_file(rows)


# --- D: classification -----------------------------------------------------------

_column_check("d1_d2_device_type", ["hostname", "program", "device_type"], stage="cleaned")
_column_check("d3_event_category", ["message", "event_category"], stage="cleaned")
_column_check("d4_event_subcategory", ["event_category", "event_subcategory"], stage="cleaned")
_column_check("d5_event_flags", ["is_security", "is_authentication", "is_network_event", "is_system_event"], stage="cleaned")

CONTENT_CLASS_SQL = """case when regexp_matches(lower(message), 'login|authentication|ssh') then 'Login Events'
  when contains(lower(message), 'bgp') then 'BGP Events' when contains(lower(message), 'ospf') then 'OSPF Events'
  when regexp_matches(lower(message), 'latency|rtt|ping') then 'Latency Events'
  when regexp_matches(lower(message), 'attack|threat|malware|security') then 'Security Events'
  when regexp_matches(lower(message), 'interface|link') then 'Interface Events'
  when regexp_matches(lower(message), 'cpu|memory|temperature|disk') then 'System Events'
  when regexp_matches(lower(message), 'route|routing') then 'Routing Events'
  when regexp_matches(lower(message), 'vpn|globalprotect') then 'VPN Events' else 'Other Events' end"""


@check("d6_content_class", clean_sql(f"select line_no, {CONTENT_CLASS_SQL} as content_class from parsed", "parsed"))
def d6(spark, sf):
    rows = parsed(spark, sf).withColumn("low", F.lower("message"))
    return rows.select("line_no", rules.content_class("low").alias("content_class"))


# --- E: extraction ---------------------------------------------------------------


@check("e1_ip_addresses", clean_sql("select line_no, source_ip, destination_ip, array_to_string(ips, ',') as ips from cleaned"))
def e1(spark, sf):
    return cleaned(spark, sf).select("line_no", "source_ip", "destination_ip", F.concat_ws(",", "ips").alias("ips"))


for _name, _cols in {
    "e2_destination_port": ["destination_port"],
    "e3_protocol": ["protocol"],
    "e4_username": ["username"],
    "e5_interface": ["interface"],
    "e6_threat_name": ["threat_name"],
    "e7_bgp_peer": ["bgp_peer"],
    "e8_as_number": ["as_number"],
    "e9_ospf_area": ["ospf_area"],
}.items():
    _column_check(_name, _cols, stage="cleaned")


@check(
    "e10_extraction_counts",
    clean_sql(
        "select * from (select " + ", ".join(f"count({c}) as {c}" for c in V.EXTRACTED_FIELDS) + " from cleaned)"
    ),
)
def e10(spark, sf):
    return profile.extraction_counts(cleaned(spark, sf))


# --- F: risk score ---------------------------------------------------------------


def _risk_part(name, sql, column):
    @check(name, clean_sql(f"select line_no, cast({sql} as integer) as points from cleaned"))
    def run(spark, sf):
        return cleaned(spark, sf).select("line_no", column().cast("int").alias("points"))


_risk_part(
    "f1_risk_base",
    "case when severity <= 1 then 50 when severity <= 5 then 60 - 10 * severity else 5 end",
    lambda: rules.risk_base(F.col("severity")),
)
_risk_part(
    "f2_risk_security",
    "case when is_security and threat_name is not null then 50 when is_security then 30 else 0 end",
    lambda: rules.risk_security(F.col("is_security"), F.col("threat_name")),
)
_risk_part(
    "f4_risk_port",
    "case when destination_port in (22, 23, 1433, 3389, 5900) then 10 else 0 end",
    lambda: rules.risk_port(F.col("destination_port")),
)
_risk_part(
    "f5_risk_external",
    "case when regexp_matches(source_ip, '^(192\\.168\\.|10\\.|172\\.16\\.)') or source_ip is null then 0 else 15 end",
    lambda: rules.risk_external(F.col("source_ip")),
)
_column_check("f6_risk_score", ["risk_score"], stage="cleaned")


# F3 is a documented no-op: no row can be both a security and an authentication event.
@check("f3_exclusive_flags", clean_sql("select count(*) filter (is_security and is_authentication) as both from cleaned"))
def f3(spark, sf):
    return cleaned(spark, sf).select(
        F.count_if(F.col("is_security") & F.col("is_authentication")).alias("both")
    )


# --- G: filters ------------------------------------------------------------------


def _filter_check(name, criteria, where):
    @check(name, clean_sql(f"select line_no, risk_score from cleaned where {where}"))
    def run(spark, sf):
        return criteria.apply(cleaned(spark, sf)).select("line_no", "risk_score")


_filter_check("g1_min_risk", filters.Criteria(min_risk=40), "risk_score >= 40")
_filter_check("g2_max_risk", filters.Criteria(max_risk=30), "risk_score <= 30")
_filter_check("g3_device_types", filters.Criteria(device_types=("cisco", "juniper")), "device_type in ('cisco', 'juniper')")
_filter_check("g4_categories", filters.Criteria(categories=("network",)), "event_category = 'network'")
_filter_check("g5_severities", filters.Criteria(severities=(0, 1, 2)), "severity in (0, 1, 2)")
_filter_check("g6_security_only", filters.Criteria(security_only=True), "is_security")
_filter_check("g7_auth_only", filters.Criteria(auth_only=True), "is_authentication")
_filter_check(
    "g8_time_range",
    filters.Criteria(start=datetime(2024, 1, 5), end=datetime(2024, 1, 12)),
    "ts >= timestamp '2024-01-05' and ts <= timestamp '2024-01-12'",
)
_filter_check("g9_has_threat", filters.Criteria(has_threat=True), "threat_name is not null")
_filter_check("g10_has_username", filters.Criteria(has_username=True), "username is not null")
_filter_check(
    "g11_source_ip_pattern",
    filters.Criteria(source_ip_pattern=r"^10\.0\.[01]\."),
    r"regexp_matches(coalesce(source_ip, ''), '^10\.0\.[01]\.')",
)
_filter_check("g12_hostname_pattern", filters.Criteria(hostname_pattern="FW|RTR"), "regexp_matches(hostname, 'FW|RTR')")
_filter_check("g13_high_risk_preset", filters.HIGH_RISK_SECURITY, "risk_score >= 50 and is_security")


@check(
    "g14_error_text_filter",
    derived_sql(
        "device_logs",
        "select event_id, level from device_logs where level in ('ERROR', 'CRITICAL') and message ilike '%BGP%'",
    ),
)
def g14(spark, sf):
    rows = filters.text_contains(filters.error_rows(derived.device_logs(spark, sf)), "BGP")
    return rows.select("event_id", "level")


@check(
    "g14_above_threshold",
    derived_sql("security_events", "select event_id, byte_count from security_events where byte_count > 5000"),
)
def g14_above(spark, sf):
    return filters.above(derived.security_events(spark, sf), "byte_count", 5000).select("event_id", "byte_count")
