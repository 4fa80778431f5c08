"""Schemas of the tables the package reads and writes."""

from pyspark.sql import types as T

CLEANED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("original_message", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("normalized_time", T.StringType()),
        T.StructField("facility", T.IntegerType()),
        T.StructField("severity", T.IntegerType()),
        T.StructField("severity_name", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("hostname", T.StringType()),
        T.StructField("program", T.StringType()),
        T.StructField("pid", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("event_category", T.StringType()),
        T.StructField("event_subcategory", T.StringType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("destination_ip", T.StringType()),
        T.StructField("source_port", T.IntegerType()),
        T.StructField("destination_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("interface", T.StringType()),
        T.StructField("threat_name", T.StringType()),
        T.StructField("bgp_peer", T.StringType()),
        T.StructField("as_number", T.LongType()),
        T.StructField("ospf_area", T.StringType()),
        T.StructField("risk_score", T.IntegerType()),
        T.StructField("is_security", T.BooleanType()),
        T.StructField("is_authentication", T.BooleanType()),
        T.StructField("is_network_event", T.BooleanType()),
        T.StructField("is_system_event", T.BooleanType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("data_quality_issues", T.ArrayType(T.StringType())),
    ]
)

ANOMALY_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("level", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("true_label", T.IntegerType()),
    ]
)

FLOW = T.StructType(
    [
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("packets", T.IntegerType()),
        T.StructField("bytes", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("true_label", T.IntegerType()),
    ]
)

MINING_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("device", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

SECURITY_EVENT = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("facility", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("destination_ip", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("byte_count", T.LongType()),
        T.StructField("packet_count", T.LongType()),
        T.StructField("session_duration", T.LongType()),
        T.StructField("is_anomaly", T.IntegerType()),
    ]
)
