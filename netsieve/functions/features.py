"""Scalar features of logs, flows and labelled events, all native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsieve import fixed_values as V


def as_int(test: Column) -> Column:
    return test.cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """Plain division; division by zero and missing values give 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def smoothed(part: Column, whole: Column) -> Column:
    return part.cast("double") / (whole + 1).cast("double")


def lookup(key: Column, codes: dict, default=0) -> Column:
    """Small fixed dictionary; an unknown key gives ``default`` (None for null)."""
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    value = F.try_element_at(F.create_map(*pairs), key)
    return value if default is None else F.coalesce(value, F.lit(default))


# --- time -------------------------------------------------------------------------


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return as_int(F.weekday(ts) >= 5)


def is_business_hours(ts: Column, variant: str) -> Column:
    first, last, weekdays_only = V.BUSINESS_HOURS[variant]
    test = F.hour(ts).between(first, last)
    return as_int(test & (F.weekday(ts) < 5) if weekdays_only else test)


def with_time_features(df: DataFrame, ts: str, variant: str) -> DataFrame:
    t = F.col(ts)
    return df.withColumns(
        {
            "hour": F.hour(t),
            "day_of_week": day_of_week(t),
            "is_weekend": is_weekend(t),
            "is_business_hours": is_business_hours(t, variant),
        }
    )


def classifier_time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Time features with defaults for unparsed times: noon, Monday, outside the
    weekend and, because a comparison with a missing hour is false, not business."""
    df = with_time_features(df, ts, "classifier")
    return df.na.fill({"hour": 12, "day_of_week": 0, "is_weekend": 0, "is_business_hours": 0})


# --- message text ------------------------------------------------------------------


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def ip_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(V.LOOSE_IP))


def interface_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(V.INTERFACE_TOKEN))


def has_error_code(text: Column) -> Column:
    return F.coalesce(text.rlike(V.ERROR_CODE), F.lit(False))


def with_message_features(df: DataFrame, message: str = "message") -> DataFrame:
    text = F.col(message)
    size = F.length(text)
    df = df.withColumns(
        {
            "message_length": size,
            "word_count": word_count(text),
            "uppercase_ratio": ratio(F.regexp_count(text, F.lit("[A-Z]")), size),
            "digit_ratio": ratio(F.regexp_count(text, F.lit(r"\d")), size),
            "special_char_ratio": ratio(F.regexp_count(text, F.lit(r"[^a-zA-Z0-9\s]")), size),
            "ip_count": ip_count(text),
            "_lower": F.lower(text),
        }
    )
    flags = {f"has_{w}": as_int(F.col("_lower").contains(w)) for w in V.ERROR_KEYWORDS}
    return df.withColumns({"has_ip": as_int(F.col("ip_count") > 0), **flags}).drop("_lower")


def log_feature_row(df: DataFrame, level_code: Column, ts: str = "ts", message: str = "message", keep=()) -> DataFrame:
    """The 18 log features, missing values 0, plus the columns in ``keep``."""
    df = with_message_features(with_time_features(df, ts, "anomaly"), message)
    df = df.withColumn("level_encoded", level_code)
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in V.LOG_FEATURES]
    return df.select(*keep, *cols)


def monitor_level_code(level: Column) -> Column:
    return lookup(level, V.LEVEL_CODES_MONITOR)


def mining_level_code(level: Column) -> Column:
    return lookup(level, V.LEVEL_CODES_MINING, None)


def monitor_protocol_code(protocol: Column) -> Column:
    return lookup(protocol, V.PROTOCOL_CODES_MONITOR)


# --- flows -------------------------------------------------------------------------


def first_octet(ip: Column) -> Column:
    return F.substring_index(ip, ".", 1).try_cast("int")


def with_flow_features(df: DataFrame, protocol_code: Column, ts: str = "ts") -> DataFrame:
    df = with_time_features(df, ts, "anomaly")
    df = df.withColumns({"src_ip_class": first_octet(F.col("src_ip")), "dst_ip_class": first_octet(F.col("dst_ip"))})
    return df.withColumns(
        {
            "packets_per_second": ratio(F.col("packets"), F.col("duration")),
            "bytes_per_second": ratio(F.col("bytes"), F.col("duration")),
            "bytes_per_packet": ratio(F.col("bytes"), F.col("packets")),
            "protocol_encoded": protocol_code,
            "is_well_known_src": as_int(F.col("src_port") < 1024),
            "is_well_known_dst": as_int(F.col("dst_port") < 1024),
            "is_common_port": as_int(F.col("dst_port").isin(V.COMMON_PORTS)),
            "is_internal_src": as_int(F.col("src_ip_class").isin(V.INTERNAL_FIRST_OCTETS)),
            "is_internal_dst": as_int(F.col("dst_ip_class").isin(V.INTERNAL_FIRST_OCTETS)),
            "duration_log": F.log1p("duration"),
            "packets_log": F.log1p("packets"),
            "bytes_log": F.log1p("bytes"),
        }
    )


def flow_feature_row(df: DataFrame, protocol_code: Column, ts: str = "ts", keep=()) -> DataFrame:
    """The 23 flow features, missing values 0, plus the columns in ``keep``."""
    wide = with_flow_features(df.withColumns({f"_keep_{c}": F.col(c) for c in keep}), protocol_code, ts)
    cols = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in V.FLOW_FEATURES]
    return wide.select(*[F.col(f"_keep_{c}").alias(c) for c in keep if c not in V.FLOW_FEATURES], *cols)


# --- labelled events -----------------------------------------------------------------


def with_event_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    df = with_time_features(df, ts, "events")
    inside_src = F.col("source_ip").startswith("192.168.")
    inside_dst = F.col("destination_ip").startswith("192.168.")
    return df.withColumns(
        {
            "source_is_internal": as_int(inside_src),
            "dest_is_internal": as_int(inside_dst),
            "internal_to_external": as_int(inside_src & ~inside_dst),
            "external_to_internal": as_int(~inside_src & inside_dst),
            "bytes_per_packet": smoothed(F.col("byte_count"), F.col("packet_count")),
            "packets_per_second": smoothed(F.col("packet_count"), F.col("session_duration")),
            "bytes_per_second": smoothed(F.col("byte_count"), F.col("session_duration")),
        }
    )


def event_feature_row(df: DataFrame, ts: str = "ts", keep=()) -> DataFrame:
    # one missing value would stop the assembler, and with it the whole job
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in V.EVENT_FEATURES]
    return with_event_features(df, ts).select(*keep, *cols)


def present_columns(df: DataFrame) -> dict[str, list[str]]:
    """Which classifier columns of each kind the table has."""
    have = set(df.columns)
    return {
        "numeric": [c for c in V.CLASSIFIER_NUMERIC if c in have],
        "boolean": [c for c in V.CLASSIFIER_BOOLEAN if c in have],
        "categorical": [c for c in V.CLASSIFIER_CATEGORICAL if c in have],
    }
