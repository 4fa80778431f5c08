"""Checks of scalar features (I), text processing (J) and encoders (K)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.cleaning import cleaned, lines, OPTIONS
from checks.registry import check
from checks.sql import clean_sql, derived_sql
from netsieve import fixed_values as V
from netsieve.functions import features, text
from netsieve.operators import encode, textmining
from netsieve.plans.clean import clean
from netsieve.sources import derived

LOOSE_IP = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"


def logs(spark, sf):
    return derived.device_logs(spark, sf)


def flows(spark, sf):
    return derived.flows(spark, sf)


def events(spark, sf):
    return derived.security_events(spark, sf)


DOW = "cast(isodow(ts) - 1 as integer)"


@check(
    "i1_time_parts",
    derived_sql("device_logs", f"select event_id, cast(hour(ts) as integer) as hour, {DOW} as day_of_week, cast(isodow(ts) >= 6 as integer) as is_weekend from device_logs"),
)
def i1(spark, sf):
    return features.with_time_features(logs(spark, sf), "ts", "anomaly").select("event_id", "hour", "day_of_week", "is_weekend")


@check(
    "i2_business_hours",
    derived_sql(
        "device_logs",
        """select event_id, cast(hour(ts) between 8 and 17 and isodow(ts) < 6 as integer) as mining, cast(hour(ts) between 9 and 17 as integer) as anomaly,
  cast(hour(ts) between 8 and 18 as integer) as classifier, cast(hour(ts) between 9 and 17 as integer) as events from device_logs""",
    ),
)
def i2(spark, sf):
    cols = [features.is_business_hours(F.col("ts"), v).alias(v) for v in V.BUSINESS_HOURS]
    return logs(spark, sf).select("event_id", *cols)


_RATIO = "length(regexp_replace(message, '[^{0}]', '', 'g'))::double / length(message)"
LOG_SQL = f"""cast(hour(ts) as double) as hour, cast({DOW} as double) as day_of_week, cast(isodow(ts) >= 6 as double) as is_weekend,
  cast(length(message) as double) as message_length,
  cast(len(regexp_extract_all(message, '\\S+')) as double) as word_count,
  {_RATIO.format('A-Z')} as uppercase_ratio, {_RATIO.format('0-9')} as digit_ratio,
  length(regexp_replace(message, '[a-zA-Z0-9\\s]', '', 'g'))::double / length(message) as special_char_ratio,
  cast(len(regexp_extract_all(message, '{LOOSE_IP}')) as double) as ip_count,
  cast(regexp_matches(message, '{LOOSE_IP}') as double) as has_ip, """ + ", ".join(
    f"cast(contains(lower(message), '{w}') as double) as has_{w}" for w in V.ERROR_KEYWORDS
)


def _log_part(name, columns):
    @check(name, derived_sql("device_logs", f"select event_id, {', '.join(columns)} from (select event_id, {LOG_SQL} from device_logs)"))
    def run(spark, sf):
        return features.log_feature_row(logs(spark, sf), F.lit(0), keep=["event_id"]).select("event_id", *columns)


_log_part("i3_length_and_words", ["message_length", "word_count"])
_log_part("i4_character_ratios", ["uppercase_ratio", "digit_ratio", "special_char_ratio"])
_log_part("i5_ip_counts", ["ip_count", "has_ip"])
_log_part("i6_keyword_flags", [f"has_{w}" for w in V.ERROR_KEYWORDS])


@check(
    "i7_interfaces_and_codes",
    derived_sql(
        "device_logs",
        r"select event_id, cast(len(regexp_extract_all(message, '(?i)(?:Gi|Fa|Te|Se|Et|Lo)\d+(?:/\d+)*')) as integer) as interface_count, regexp_matches(message, '%\w+-\d+-\w+') as has_error_code from device_logs",
    ),
)
def i7(spark, sf):
    m = F.col("message")
    return logs(spark, sf).select(
        "event_id", features.interface_count(m).alias("interface_count"), features.has_error_code(m).alias("has_error_code")
    )


@check(
    "i8_fixed_codes",
    derived_sql(
        "device_logs",
        """select event_id, cast(case level when 'DEBUG' then 0 when 'INFO' then 1 when 'WARNING' then 2 when 'ERROR' then 3 when 'CRITICAL' then 4 end as integer) as mining,
  cast(case level when 'INFO' then 0 when 'WARNING' then 1 when 'ERROR' then 2 when 'CRITICAL' then 3 else 0 end as integer) as monitor from device_logs""",
    ),
)
def i8(spark, sf):
    level = F.col("level")
    return logs(spark, sf).select(
        "event_id", features.mining_level_code(level).alias("mining"), features.monitor_level_code(level).alias("monitor")
    )


@check(
    "i8_protocol_codes",
    derived_sql("flows", "select protocol, case protocol when 'TCP' then 0 when 'UDP' then 1 when 'ICMP' then 2 else 0 end as code, count(*) as n from flows group by all"),
)
def i8b(spark, sf):
    coded = flows(spark, sf).select("protocol", features.monitor_protocol_code(F.col("protocol")).alias("code"))
    return coded.groupBy("protocol", "code").agg(F.count("*").alias("n"))


FLOW_SQL = """cast(src_port as double) as src_port, cast(dst_port as double) as dst_port,
  cast(case protocol when 'ICMP' then 0 when 'TCP' then 1 else 2 end as double) as protocol_encoded,
  duration, cast(packets as double) as packets, bytes,
  case when duration = 0 then 0 else packets / duration end as packets_per_second,
  case when duration = 0 then 0 else bytes / duration end as bytes_per_second, bytes / packets as bytes_per_packet,
  cast(src_port < 1024 as double) as is_well_known_src, cast(dst_port < 1024 as double) as is_well_known_dst,
  cast(dst_port in (22, 23, 53, 80, 443, 993, 995) as double) as is_common_port,
  cast(hour(ts) as double) as hour, cast(isodow(ts) - 1 as double) as day_of_week, cast(isodow(ts) >= 6 as double) as is_weekend,
  cast(hour(ts) between 9 and 17 as double) as is_business_hours,
  cast(split_part(src_ip, '.', 1) as double) as src_ip_class, cast(split_part(dst_ip, '.', 1) as double) as dst_ip_class,
  cast(split_part(src_ip, '.', 1) in ('10', '172', '192') as double) as is_internal_src,
  cast(split_part(dst_ip, '.', 1) in ('10', '172', '192') as double) as is_internal_dst,
  round(ln(1 + duration), 6) as duration_log, round(ln(1 + packets), 6) as packets_log, round(ln(1 + bytes), 6) as bytes_log"""


def flow_rows(spark, sf):
    df = encode.label_encode(flows(spark, sf), "protocol", "protocol_code")
    return features.flow_feature_row(df, F.col("protocol_code"), keep=["flow_id"])


def _flow_part(name, columns):
    @check(name, derived_sql("flows", f"select flow_id, {', '.join(columns)} from (select flow_id, {FLOW_SQL} from flows)"))
    def run(spark, sf):
        logs_ = ("duration_log", "packets_log", "bytes_log")
        cols = [F.round(c, 6).alias(c) if c in logs_ else F.col(c) for c in columns]
        return flow_rows(spark, sf).select("flow_id", *cols)


_flow_part("i9_flow_rates", ["packets_per_second", "bytes_per_second", "bytes_per_packet"])
_flow_part("i11_port_flags", ["is_well_known_src", "is_well_known_dst", "is_common_port"])
_flow_part("i12_address_classes", ["src_ip_class", "dst_ip_class", "is_internal_src", "is_internal_dst"])
_flow_part("i14_log_scale", ["duration_log", "packets_log", "bytes_log"])
_flow_part("i17_flow_feature_row", V.FLOW_FEATURES)

EVENT_SQL = """cast(hour(ts) as double) as hour, cast(isodow(ts) - 1 as double) as day_of_week, cast(isodow(ts) >= 6 as double) as is_weekend,
  cast(hour(ts) between 9 and 17 as double) as is_business_hours, cast(source_ip like '192.168.%' as double) as source_is_internal,
  cast(destination_ip like '192.168.%' as double) as dest_is_internal,
  cast(source_ip like '192.168.%' and destination_ip not like '192.168.%' as double) as internal_to_external,
  cast(source_ip not like '192.168.%' and destination_ip like '192.168.%' as double) as external_to_internal,
  cast(byte_count as double) as byte_count, cast(packet_count as double) as packet_count, cast(session_duration as double) as session_duration,
  byte_count::double / (packet_count + 1) as bytes_per_packet, packet_count::double / (session_duration + 1) as packets_per_second,
  byte_count::double / (session_duration + 1) as bytes_per_second"""


def _event_part(name, columns):
    @check(name, derived_sql("security_events", f"select event_id, {', '.join(columns)} from (select event_id, {EVENT_SQL} from security_events)"))
    def run(spark, sf):
        return features.event_feature_row(events(spark, sf), keep=["event_id"]).select("event_id", *columns)


_event_part("i10_smoothed_rates", ["bytes_per_packet", "packets_per_second", "bytes_per_second"])
_event_part("i13_direction_flags", ["source_is_internal", "dest_is_internal", "internal_to_external", "external_to_internal"])
_event_part("i18_event_feature_row", V.EVENT_FEATURES)


@check(
    "i15_missing_time_defaults",
    clean_sql(
        """select line_no, cast(coalesce(hour(ts), 12) as integer) as hour, cast(coalesce(isodow(ts) - 1, 0) as integer) as day_of_week,
  cast(coalesce(isodow(ts) >= 6, false) as integer) as is_weekend,
  cast(coalesce(hour(ts) between 8 and 18, false) as integer) as is_business_hours from cleaned"""
    ),
)
def i15(spark, sf):
    cols = ["line_no", "hour", "day_of_week", "is_weekend", "is_business_hours"]
    return features.classifier_time_features(cleaned(spark, sf)).select(*cols)


LEVEL_CODE_SQL = "(select level, dense_rank() over (order by level) - 1 as code from (select distinct level from device_logs))"


@check(
    "i16_log_feature_row",
    derived_sql(
        "device_logs",
        f"select event_id, {', '.join(V.LOG_FEATURES)} from (select event_id, {LOG_SQL}, cast(code as double) as level_encoded from device_logs join {LEVEL_CODE_SQL} using (level))",
    ),
)
def i16(spark, sf):
    df = encode.label_encode(logs(spark, sf), "level", "level_code")
    return features.log_feature_row(df, F.col("level_code"), keep=["event_id"])


@check(
    "i19_classifier_columns",
    clean_sql(
        "select line_no, "
        + ", ".join(
            [f"coalesce({c}, 0) as {c}" for c in V.CLASSIFIER_NUMERIC if c != "source_port"]
            + ["0 as source_port"]
            + [f"cast({c} as integer) as {c}" for c in V.CLASSIFIER_BOOLEAN]
            + [f"coalesce({c}, 'unknown') as {c}" for c in V.CLASSIFIER_CATEGORICAL]
        )
        + " from cleaned"
    ),
)
def i19(spark, sf):
    df = cleaned(spark, sf)
    have = features.present_columns(df)
    return df.select(
        "line_no",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in have["numeric"]],
        *[F.col(c).cast("int").alias(c) for c in have["boolean"]],
        *[F.coalesce(c, F.lit("unknown")).alias(c) for c in have["categorical"]],
    )


# --- J: text -----------------------------------------------------------------------

ENTITY_SQL = r"""regexp_replace(regexp_replace(regexp_replace(lower(message), '\b(?:\d{1,3}\.){3}\d{1,3}\b', 'IP_ADDRESS', 'g'),
  '(?i)(?:gi|fa|te|se|et|lo)\d+(?:/\d+)*', 'INTERFACE_NAME', 'g'), '%\w+-\d+-\w+', 'ERROR_CODE', 'g')"""


@check("j1_replace_entities", derived_sql("device_logs", f"select event_id, {ENTITY_SQL} as text from device_logs"))
def j1(spark, sf):
    return logs(spark, sf).select("event_id", text.replace_entities(F.col("message")).alias("text"))


@check(
    "j2_drop_symbols",
    derived_sql("device_logs", f"select event_id, regexp_replace({ENTITY_SQL}, '[^\\p{{L}}\\p{{N}}_\\s\\-/:]', ' ', 'g') as text from device_logs"),
)
def j2(spark, sf):
    return logs(spark, sf).select("event_id", text.drop_symbols(text.replace_entities(F.col("message"))).alias("text"))


# the same step on whole free texts
@check("j2_drop_symbols_documents", "select doc_id, regexp_replace(lower(text), '[^\\p{L}\\p{N}_\\s\\-/:]', ' ', 'g') as text from documents")
def j2_docs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", text.drop_symbols(F.lower("text")).alias("text"))


# RE2 has no lookahead: a colon before a digit is protected first
TOKENS_SQL = (
    f"regexp_extract_all(regexp_replace(regexp_replace(regexp_replace({ENTITY_SQL}, '[^\\p{{L}}\\p{{N}}_\\s\\-/:]', ' ', 'g'), "
    "':(\\d)', chr(1) || '\\1', 'g'), ':|--', ' ', 'g'), '\\S+')"
)


@check("j3_tokens", derived_sql("device_logs", f"select event_id, replace(array_to_string({TOKENS_SQL}, ' '), chr(1), ':') as tokens from device_logs"))
def j3(spark, sf):
    words = text.tokens(text.drop_symbols(text.replace_entities(F.col("message"))))
    return logs(spark, sf).select("event_id", F.concat_ws(" ", words).alias("tokens"))


_STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in V.GENERAL_STOP_WORDS + V.NETWORK_STOP_WORDS)
KEPT_SQL = f"list_filter({TOKENS_SQL}, lambda w: length(w) > 2 and w not in ({_STOP_SQL}))"


@check("j4_kept_tokens", derived_sql("device_logs", f"select event_id, array_to_string({KEPT_SQL}, ' ') as tokens from device_logs"))
def j4(spark, sf):
    return logs(spark, sf).select("event_id", F.concat_ws(" ", text.kept_tokens(F.col("message"))).alias("tokens"))


@check("j5_stemmed_messages")
def j5(spark, sf):
    return logs(spark, sf).select("event_id", text.processed_message(F.col("message")).alias("processed_message"))


def _vectors(df, key, model, out="tfidf"):
    scored = model.transform(df)
    return scored.select(key, F.transform(vector_to_array(out), lambda x: F.round(x, 6)).alias(out))


@check("j6_tfidf_unigrams")
def j6(spark, sf):
    df = logs(spark, sf).select("event_id", "message")
    return _vectors(df, "event_id", textmining.fit_tfidf(df, "message", max_terms=50))


@check("j7_tfidf_bigrams")
def j7(spark, sf):
    df = logs(spark, sf).select("event_id", "message")
    model = textmining.fit_tfidf(df, "message", max_terms=50, bigrams=True, min_df=5, max_df=0.8)
    return _vectors(df, "event_id", model)


@check("j8_strip_accents", "select doc_id, strip_accents(lower(text)) as text from documents")
def j8(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", text.strip_accents(F.lower("text")).alias("text"))


@check(
    "j9_term_frequencies",
    derived_sql(
        "device_logs",
        f"select term, count(*) as n, count(distinct event_id) as documents from (select event_id, unnest({KEPT_SQL}) as term from device_logs) group by term",
    ),
)
def j9(spark, sf):
    return text.term_frequencies(logs(spark, sf), text.kept_tokens(F.col("message")))


# fixed words of the fixture messages with made-up polarities, handed over as a table
LEXICON = [("failed", -0.5), ("down", -0.2), ("high", -0.1), ("saved", 0.4), ("idle", -0.05), ("alert", -0.3)]
_LEX_SQL = "(values " + ", ".join(f"('{w}', {p}::double)" for w, p in LEXICON) + ") lexicon(word, polarity)"
_SCORES = (
    "scores",
    f"""select d.event_id, d.message, round(coalesce(s.score, 0), 6) as sentiment_score from device_logs d left join (
  select event_id, avg(polarity) as score from (select event_id, unnest(regexp_extract_all(lower(message), '[a-z'']+')) as word from device_logs)
  join {_LEX_SQL} using (word) group by event_id) s using (event_id)""",
)
_LABELLED = (
    "labelled",
    "select *, case when sentiment_score > 0.1 then 'positive' when sentiment_score < -0.1 then 'negative' else 'neutral' end as sentiment from scores",
)


def scored_logs(spark, sf):
    lexicon = spark.createDataFrame(LEXICON, "word string, polarity double")
    return textmining.polarity(logs(spark, sf), "event_id", "message", lexicon)


@check("j10_polarity", derived_sql("device_logs", "select event_id, sentiment_score, sentiment from labelled", _SCORES, _LABELLED))
def j10(spark, sf):
    return scored_logs(spark, sf).select("event_id", "sentiment_score", "sentiment")


@check("j11_sentiment_counts", derived_sql("device_logs", "select sentiment, count(*) as n from labelled group by 1", _SCORES, _LABELLED))
def j11(spark, sf):
    return textmining.sentiment_counts(scored_logs(spark, sf))


@check(
    "j12_extreme_negative",
    derived_sql(
        "device_logs",
        """select event_id, sentiment_score from (select *, rank() over (order by sentiment_score desc) as rk from labelled
  where sentiment = 'negative') where rk <= 5""",
        _SCORES,
        _LABELLED,
    ),
)
def j12(spark, sf):
    return textmining.extreme_negative(scored_logs(spark, sf)).select("event_id", "sentiment_score")


@check("j13_preview", derived_sql("device_logs", "select event_id, concat(substr(message, 1, 20), '...') as preview from device_logs"))
def j13(spark, sf):
    return logs(spark, sf).select("event_id", text.preview(F.col("message"), 20).alias("preview"))


# --- K: encoders -------------------------------------------------------------------


@check(
    "k1_label_codes",
    derived_sql("device_logs", f"select event_id, level, cast(code as integer) as code from device_logs join {LEVEL_CODE_SQL} using (level)"),
)
def k1(spark, sf):
    return encode.label_encode(logs(spark, sf), "level", "code").select("event_id", "level", "code")


@check(
    "k1_code_table",
    derived_sql("device_logs", "select message, cast(dense_rank() over (order by message) - 1 as integer) as code from (select distinct message from device_logs)"),
)
def k1_table(spark, sf):
    return encode.code_table(logs(spark, sf), "message")


_TYPES = ["data_transfer", "file_access", "login_failure", "login_success", "port_scan"]


@check(
    "k2_one_hot",
    derived_sql("security_events", "select event_id, " + ", ".join(f"cast(event_type = '{t}' as integer) as event_{t}" for t in _TYPES) + " from security_events"),
)
def k2(spark, sf):
    df = events(spark, sf)
    values = encode.fit_one_hot(df, "event_type")
    return df.select("event_id", *encode.one_hot_columns("event_type", "event", values))


@check(
    "k2_one_hot_sparse",
    derived_sql("device_logs", "select event_id, cast(dense_rank() over (order by message) - 1 as varchar) as cells from device_logs"),
)
def k2_sparse(spark, sf):
    df = logs(spark, sf)
    out = encode.one_hot_sparse(df, "message", encode.code_table(df, "message"), "cells")
    return out.select("event_id", F.concat_ws(",", F.col("cells").cast("array<string>")).alias("cells"))


@check(
    "k3_unseen_category",
    derived_sql("security_events", "select event_id, " + ", ".join(f"cast(event_type = '{t}' as integer) as event_{t}" for t in _TYPES if t != "port_scan") + " from security_events"),
)
def k3(spark, sf):
    df = events(spark, sf)
    values = encode.fit_one_hot(df.where("event_type <> 'port_scan'"), "event_type")
    return df.select("event_id", *encode.one_hot_columns("event_type", "event", values))


@check(
    "k4_standardize",
    derived_sql(
        "flows",
        "select flow_id, "
        + ", ".join(
            f"round((f.{c} - s.m_{c}) / s.d_{c}, 6) as {c}" for c in ("duration", "packets", "bytes")
        )
        + " from flows f, (select "
        + ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as d_{c}" for c in ("duration", "packets", "bytes"))
        + " from flows) s",
    ),
)
def k4(spark, sf):
    cols = ["duration", "packets", "bytes"]
    out = encode.standardize_columns(flows(spark, sf), cols)
    return out.select("flow_id", *[F.round(c, 6).alias(c) for c in cols])


@check("k4_vector_scaler")
def k4_vector(spark, sf):
    df = encode.assemble(flow_rows(spark, sf), V.FLOW_FEATURES).select("flow_id", "features")
    scaled = encode.fit_population_scaler(df).transform(df)
    return scaled.select("flow_id", F.transform(vector_to_array("scaled"), lambda x: F.round(x, 6)).alias("scaled"))


@check(
    "k5_non_negative_shift",
    derived_sql(
        "security_events",
        "select event_id, byte_count - 5000 - (select min(byte_count - 5000) from security_events) + 1 as centred, packet_count from security_events",
    ),
)
def k5(spark, sf):
    df = events(spark, sf).withColumn("centred", F.col("byte_count") - 5000)
    return encode.shift_non_negative(df, ["centred", "packet_count"]).select("event_id", "centred", "packet_count")


@check("k6_combined_features")
def k6(spark, sf):
    df = logs(spark, sf)
    rows = features.log_feature_row(df, features.monitor_level_code(F.col("level")), keep=["event_id", "message"])
    rows = textmining.fit_tfidf(rows, "message", max_terms=50).transform(rows)
    wide = encode.assemble(rows, [*V.LOG_FEATURES, "tfidf"])
    return wide.select("event_id", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))


@check("k7_drop_unlabelled", "select d.doc_id, l.quality from documents d left join labels l using (doc_id) where l.quality is not null")
def k7(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return encode.drop_unlabelled(docs.join(labels, "doc_id", "left"), "quality").select("doc_id", "quality")


@check(
    "k8_stratified_split",
    derived_sql(
        "device_logs",
        """select event_id, category, row_number() over (partition by category order by md5(concat(event_id, ':42')), event_id)
  <= ceil(count(*) over (partition by category) * 0.2::double) as is_test from device_logs""",
    ),
)
def k8(spark, sf):
    out = encode.stratified_split(logs(spark, sf), "category", ["event_id"])
    return out.select("event_id", "category", "is_test")
