"""Scoring and alerting of logs and flows, on batches and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsieve import fixed_values as V
from netsieve.functions import features as feat
from netsieve.operators.encode import assemble
from netsieve.plans.anomaly import Detector, fit_detector

MONITOR_MODELS = ("isolation_forest", "one_class_svm")
MONITOR_CONTAMINATION = 0.1


def log_vectors(df: DataFrame, keep: list[str], ts: str = "ts") -> DataFrame:
    """Feature vectors with fixed level codes; a row that lacks text still gets a vector."""
    rows = feat.log_feature_row(df, feat.monitor_level_code(F.col("level")), ts, keep=keep)
    return assemble(rows, V.LOG_FEATURES).select(*keep, "features")


def flow_vectors(df: DataFrame, keep: list[str], ts: str = "ts") -> DataFrame:
    kept = {f"_k_{c}": F.col(c) for c in keep}
    rows = feat.flow_feature_row(
        df.withColumns(kept), feat.monitor_protocol_code(F.col("protocol")), ts, keep=list(kept)
    )
    return assemble(rows, V.FLOW_FEATURES).select(*[F.col(k).alias(c) for k, c in zip(kept, keep)], "features")


def log_error(ts: str = "ts") -> Column:
    """Why a log cannot be scored, null if it can."""
    return F.when(F.col(ts).isNull(), "Syslog processing error: no timestamp").when(
        F.col("message").isNull(), "Syslog processing error: no message"
    )


def flow_error(ts: str = "ts") -> Column:
    bad = feat.first_octet(F.col("src_ip")).isNull() | feat.first_octet(F.col("dst_ip")).isNull()
    return F.when(F.col(ts).isNull(), "Flow processing error: no timestamp").when(
        bad, "Flow processing error: invalid address"
    )


def fit_monitor(df: DataFrame, kind: str, seed: int = 42) -> Detector:
    """Two models on sample rows of one kind (``syslog`` or ``flow``)."""
    vectors = log_vectors if kind == "syslog" else flow_vectors
    return fit_detector(vectors(df, []), MONITOR_CONTAMINATION, MONITOR_MODELS, seed)


def score(df: DataFrame, detector: Detector, kind: str, ts: str = "ts") -> DataFrame:
    """``data_type, timestamp, entry, is_anomaly, confidence, individual_models, error``.

    A record that cannot be scored carries its reason in ``error`` and no verdict; it
    never stops the query.
    """
    entry = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    error = log_error(ts) if kind == "syslog" else flow_error(ts)
    rows = df.withColumns({"entry": entry, "error": error, "event_time": F.col(ts)})
    vectors = log_vectors if kind == "syslog" else flow_vectors
    scored = detector.detect(vectors(rows, ["event_time", "entry", "error"], ts))
    return result_rows(scored, detector.names, kind)


def result_rows(scored: DataFrame, models: list[str], kind: str) -> DataFrame:
    fine = F.col("error").isNull()
    votes = [x for m in models for x in (F.lit(m), F.col(f"{m}_anomaly").cast("int"))]
    return scored.select(
        F.lit(kind).alias("data_type"),
        F.col("event_time").alias("timestamp"),
        "entry",
        F.when(fine, F.col("ensemble_anomaly") == 1).alias("is_anomaly"),
        F.when(fine, F.col("confidence")).alias("confidence"),
        F.when(fine, F.create_map(*votes)).alias("individual_models"),
        "error",
    )


def monitor_batch(logs: DataFrame | None, flows: DataFrame | None, detectors: dict[str, Detector], ts: str = "ts") -> DataFrame:
    """Results of both record types in one table."""
    parts = []
    if logs is not None:
        parts.append(score(logs, detectors["syslog"], "syslog", ts))
    if flows is not None:
        parts.append(score(flows, detectors["flow"], "flow", ts))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def alert_level(confidence: Column) -> Column:
    return F.when(confidence > V.HIGH_RISK_SCORE, "HIGH").otherwise("MEDIUM")


def alerts(results: DataFrame, threshold: float = V.ALERT_THRESHOLD) -> DataFrame:
    """An alert for each anomaly whose confidence exceeds the threshold."""
    hit = F.col("is_anomaly") & (F.col("confidence") > threshold)
    kind = F.when(F.col("data_type") == "syslog", "SYSLOG_ANOMALY").otherwise("FLOW_ANOMALY")
    return results.where(hit).select(
        kind.alias("alert_type"),
        alert_level(F.col("confidence")).alias("severity"),
        "confidence",
        F.current_timestamp().alias("timestamp"),
        F.struct("is_anomaly", "confidence", "individual_models").alias("details"),
        "entry",
    )


def paired_alert(log_anomaly: Column, log_confidence: Column, flow_anomaly: Column, flow_confidence: Column,
                 threshold: float = V.ALERT_THRESHOLD) -> Column:
    """Alert of a record pair; the log alert takes precedence over the flow alert."""

    def one(kind, anomaly, confidence):
        body = F.struct(
            F.lit(kind).alias("alert_type"), alert_level(confidence).alias("severity"), confidence.alias("confidence")
        )
        return F.when(anomaly & (confidence > threshold), body)

    return F.coalesce(
        one("SYSLOG_ANOMALY", log_anomaly, log_confidence), one("FLOW_ANOMALY", flow_anomaly, flow_confidence)
    )


