"""Checks of models and evaluation (L), detectors (M), sequences (N) and streaming (O)."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.cleaning import OPTIONS, cleaned, lines
from checks.registry import check
from checks.sql import clean_sql, derived_sql
from netsieve import fixed_values as V
from netsieve.functions import features
from netsieve.operators import classify, encode, metrics, profile, sequence
from netsieve.operators.anomaly import clusters, components, density, iforest, ocsvm, thresholds
from netsieve.operators.vectorise import RecordVectorizerModel
from netsieve.plans import anomaly, classify as plans
from netsieve.plans.clean import clean
from netsieve.session import ensure_checkpoint_dir
from netsieve.sources import derived, model_store, readers, writers
from netsieve.streaming import cleaning, monitor


def logs(spark, sf):
    return derived.device_logs(spark, sf)


def flows(spark, sf):
    return derived.flows(spark, sf)


def events(spark, sf):
    return derived.security_events(spark, sf)


def scratch(spark):
    """A new folder next to the checkpoints of the session."""
    return f"{ensure_checkpoint_dir(spark)}/check-{uuid.uuid4().hex}"


# --- L: supervised models ---------------------------------------------------------


def cleaned_once(spark, sf):
    """Cleaned records, persisted. The lines are dealt out first, as one file may be a single part of a scan."""
    rows = clean(derived.spread(lines(spark, sf)), OPTIONS).withColumnRenamed("line_seq", "line_no")
    return derived.spread(rows).persist()


def classifier_rows(records, exclude_rule_flags=False):
    return plans.classifier_vectors(records, ["line_no", "event_category"], exclude_rule_flags).persist()


def _train(records, names, folds=1, **settings):
    chosen = classify.estimators(**settings)
    rows = classifier_rows(records)
    fitted, _ = classify.train_and_compare(rows, "event_category", ["line_no"], {n: chosen[n] for n in names}, folds)
    return fitted, classify.feature_names(rows)


def _model_check(key, name, **settings):
    @check(key)
    def run(spark, sf):
        fitted, _ = _train(cleaned_once(spark, sf), [name], **settings)
        return classify.comparison(spark, fitted)


_model_check("l1_random_forest", "Random Forest")
_model_check("l2_gradient_boosting", "Gradient Boosting")
_model_check("l3_logistic_regression", "Logistic Regression")
_model_check("l4_support_vectors", "Support Vector Machine")
_model_check("l5_naive_bayes", "Naive Bayes")


@check("l6_l7_cross_validated_comparison")
def l6(spark, sf):
    fitted, _ = _train(cleaned_once(spark, sf), list(classify.estimators()), folds=3)
    return classify.comparison(spark, fitted)


@check(
    "l6_stratified_folds",
    derived_sql(
        "device_logs",
        """select category, fold, cast((n + 2 - fold) // 3 as bigint) as n from (select category, count(*) as n from device_logs group by 1),
  (select unnest([0, 1, 2]) as fold) where n > fold""",
    ),
)
def l6_folds(spark, sf):
    out = encode.stratified_folds(logs(spark, sf), "category", ["event_id"], 3)
    return out.groupBy("category", "fold").agg(F.count("*").alias("n"))


# a keyword rule stands in for a model: SQL can state it, and it is often wrong
_RULE_SQL = (
    "ruled",
    """select *, case when contains(message, 'BGP') then 'bgp_issues' when contains(lower(message), 'failed') then 'authentication'
  when level = 'ERROR' then 'interface_down' when contains(message, 'CPU') then 'performance' else 'configuration' end as predicted,
  cast(level in ('ERROR', 'CRITICAL') and event_id % 3 > 0 as integer) as level_rule, cast(length(message) > 45 as integer) as length_rule,
  cast(contains(message, 'down') as integer) as down_rule from device_logs""",
)


def ruled(spark, sf):
    m, level = F.col("message"), F.col("level")
    return logs(spark, sf).withColumns(
        {
            "predicted": F.when(m.contains("BGP"), "bgp_issues")
            .when(F.lower(m).contains("failed"), "authentication")
            .when(level == "ERROR", "interface_down")
            .when(m.contains("CPU"), "performance")
            .otherwise("configuration"),
            "level_rule": (level.isin(*V.ERROR_LEVELS) & (F.col("event_id") % 3 > 0)).cast("int"),
            "length_rule": (F.length(m) > 45).cast("int"),
            "down_rule": m.contains("down").cast("int"),
        }
    )


_PER_CLASS = (
    "per_class",
    """select c as class, coalesce(tp / nullif(predicted, 0), 0)::double as precision, coalesce(tp / nullif(support, 0), 0)::double as recall, support from (
  select c, count(*) filter (category = c and predicted = c) as tp, count(*) filter (predicted = c) as predicted, count(*) filter (category = c) as support
  from ruled, (select distinct category as c from ruled union select distinct predicted from ruled) group by c)""",
)
_WITH_F1 = (
    "with_f1",
    "select class, precision, recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1_score, support from per_class",
)
_ROUNDED = "class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1_score, 6) as f1_score, support"


@check(
    "l8_class_report",
    derived_sql(
        "device_logs",
        f"""select {_ROUNDED} from (select * from with_f1
  union all select 'macro avg', avg(precision), avg(recall), avg(f1_score), cast(sum(support) as bigint) from with_f1
  union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1_score * support) / sum(support), cast(sum(support) as bigint) from with_f1)""",
        _RULE_SQL,
        _PER_CLASS,
        _WITH_F1,
    ),
)
def l8(spark, sf):
    out = metrics.class_report(ruled(spark, sf), "category", "predicted")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1_score")})


_CLASSES = ["authentication", "bgp_issues", "configuration", "interface_down", "performance"]


@check(
    "l9_confusion_matrix",
    derived_sql(
        "device_logs",
        "select category as label, " + ", ".join(f"count(*) filter (predicted = '{c}') as pred_{c}" for c in _CLASSES) + " from ruled group by 1",
        _RULE_SQL,
    ),
)
def l9(spark, sf):
    return metrics.confusion_matrix(ruled(spark, sf), "category", "predicted")


@check("l10_feature_importance")
def l10(spark, sf):
    rows = classifier_rows(cleaned_once(spark, sf), exclude_rule_flags=True)
    indexed, _ = classify.index_target(rows, "event_category")
    model = classify.estimators()["Random Forest"].fit(indexed)
    return classify.importances(spark, model, classify.feature_names(rows))


@check("l11_score_new_text")
def l11(spark, sf):
    rows = plans.mining_columns(derived.spread(logs(spark, sf))).persist()
    vectors = plans.fit_mining_vectors(rows)
    train = vectors.transform(rows).select("category", "level", "features").persist()
    models = classify.fit_text_classifiers(train, {"category": ("category", 20), "severity": ("level", 15)})
    new = plans.new_text_columns(logs(spark, sf).select("message").distinct())
    scored = classify.score_text(vectors.transform(new).select("message", "features"), models)
    return scored.drop("features")


def _dense(spark, sf, iterations=30):
    # the narrow events are kept; vectors are made when the network packs its rows and when it scores
    rows = derived.spread(events(spark, sf)).persist()
    vectors = plans.fit_event_vectors(rows)
    split = encode.stratified_split(rows, "is_anomaly", ["event_id"])
    wide = vectors.transform(plans.event_columns(split))
    names = classify.feature_names(wide, "raw_features")
    rows = wide.select("event_id", "ts", "event_type", "source_ip", "is_anomaly", "features", "is_test")
    model = classify.fit_dense(rows.where(~F.col("is_test")), "is_anomaly", iterations=iterations)
    return model, rows, names


@check("l12_l14_dense_network")
def l12(spark, sf):
    model, rows, _ = _dense(spark, sf)
    scored = classify.score_dense(rows.where("is_test"), model).select("is_anomaly", "predicted_anomaly", "anomaly_score").persist()
    acc = metrics.accuracy(scored, "is_anomaly", "predicted_anomaly").first()[0]
    area = metrics.auc(scored, "is_anomaly", "anomaly_score").first()[0]
    return spark.createDataFrame(
        [("Dense NN", acc, area, classify.parameter_count(model))], "model string, accuracy double, auc double, parameters bigint"
    )


@check(
    "l13_auc",
    derived_sql(
        "security_events",
        """select round((sum(rk) filter (is_anomaly = 1) - count(*) filter (is_anomaly = 1) * (count(*) filter (is_anomaly = 1) + 1) / 2.0::double)
  / (count(*) filter (is_anomaly = 1) * count(*) filter (is_anomaly <> 1)::double), 6) as auc
from (select is_anomaly, rank() over (order by byte_count) + (count(*) over (partition by byte_count) - 1) / 2.0::double as rk from security_events)""",
    ),
)
def l13_auc(spark, sf):
    return metrics.auc(events(spark, sf), "is_anomaly", "byte_count").select(F.round("auc", 6).alias("auc"))


@check(
    "l13_accuracy_at_threshold",
    derived_sql("security_events", "select count(*) filter ((byte_count / 12500.0::double > 0.5) = (is_anomaly = 1))::double / count(*) as accuracy from security_events"),
)
def l13_accuracy(spark, sf):
    scored = events(spark, sf).withColumn("s", F.col("byte_count") / F.lit(12500.0))
    return metrics.accuracy_at(scored, "is_anomaly", "s")


@check("l15_first_layer_importance")
def l15(spark, sf):
    model, _, names = _dense(spark, sf)
    return classify.first_layer_importance(spark, model, names)


@check("l16_score_incoming_events")
def l16(spark, sf):
    model, rows, _ = _dense(spark, sf)
    # the held-out rows stand for incoming ones
    return profile.score_summary(classify.score_dense(rows.where("is_test"), model), "predicted_anomaly")


_FLAGS = {"level": "level_rule", "length": "length_rule", "down": "down_rule"}
_METRIC_SQL = " union all ".join(
    f"""select '{n}' as model, count(*) filter ({c} = 1 and true_label = 1)::double as tp, count(*) filter ({c} = 1 and true_label = 0) as fp,
  count(*) filter ({c} = 0 and true_label = 1) as fn, count(*) filter ({c} = 0 and true_label = 0) as tn from ruled"""
    for n, c in _FLAGS.items()
)
_METRICS = (
    "metric_rows",
    f"""select model, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1_score, round((tp + tn) / (tp + fp + fn + tn), 6) as accuracy,
  cast(tp + fp as bigint) as anomalies_detected from ({_METRIC_SQL})""",
)


def _metric_rows(spark, sf):
    return metrics.binary_metrics(ruled(spark, sf), "true_label", _FLAGS).withColumns(
        {c: F.round(c, 6) for c in ("precision", "recall", "f1_score", "accuracy")}
    )


@check("l17_detector_metrics", derived_sql("device_logs", "select * from metric_rows", _RULE_SQL, _METRICS))
def l17(spark, sf):
    return _metric_rows(spark, sf)


@check("l17_best_model", derived_sql("device_logs", "select * from metric_rows order by f1_score desc, model limit 1", _RULE_SQL, _METRICS))
def l17_best(spark, sf):
    return metrics.best_model(_metric_rows(spark, sf))


# --- M: detectors -------------------------------------------------------------------


def _scaled(df, level=StorageLevel.MEMORY_AND_DISK_DESER):
    """The scaled rows, persisted; the scaler reads features that are found once."""
    rows = df.select("features").persist(level)
    scaler = encode.fit_population_scaler(rows)
    rows.unpersist()
    return scaler.transform(df).drop("features", "_scaled").persist(level)


def scaled_flows(spark, sf):
    df = flows(spark, sf)
    model = anomaly.fit_vectorizer(df, "flow")
    # there are many flows and few passes over them: their vectors stay out of the executors' memory
    return _scaled(anomaly.flow_vectors(derived.spread(df), ["flow_id", "true_label"], model=model)[0], StorageLevel.DISK_ONLY)


def scaled_logs(spark, sf):
    df, names = anomaly.log_vectors(derived.spread(logs(spark, sf)), ["event_id", "true_label"])
    return _scaled(df), names


def _flag_counts(df, name):
    return df.groupBy("true_label", f"{name}_anomaly").agg(F.count("*").alias("n"))


@check("m1_isolation_forest")
def m1(spark, sf):
    df = scaled_flows(spark, sf)
    return _flag_counts(iforest.fit_predict(df, "scaled", keep=["flow_id", "true_label"])[1], "isolation_forest")


@check("m2_one_class_svm")
def m2(spark, sf):
    df = scaled_flows(spark, sf)
    return _flag_counts(ocsvm.fit_predict(df, "scaled", keep=["flow_id", "true_label"])[1], "one_class_svm")


@check("m3_density_noise")
def m3(spark, sf):
    df, _ = scaled_logs(spark, sf)
    return _flag_counts(density.density_noise(df, "scaled"), "dbscan")


@check("m4_m5_kmeans_distance")
def m4(spark, sf):
    df, _ = scaled_logs(spark, sf)
    model, _ = clusters.choose_kmeans(df, "scaled")
    return _flag_counts(clusters.kmeans_flags(df, model, "scaled", 0.05), "kmeans")


@check("m6_pca_reconstruction")
def m6(spark, sf):
    df = scaled_flows(spark, sf)
    return _flag_counts(components.pca_flags(df, components.fit_pca(df, "scaled"), "scaled", 0.05), "pca")


@check(
    "m7_percentile_flag",
    derived_sql("flows", "select flow_id, bytes, cast(bytes > (select quantile_cont(bytes, 0.95) from flows) as integer) as flag from flows"),
)
def m7(spark, sf):
    return thresholds.flag_above(flows(spark, sf), "bytes", "flag", 0.95).select("flow_id", "bytes", "flag")


_VOTES = "level_rule + length_rule + down_rule"


@check(
    "m8_majority_vote",
    derived_sql(
        "device_logs",
        f"select event_id, cast({_VOTES} >= 1.5 as integer) as ensemble_anomaly, ({_VOTES}) / 3.0::double as confidence from ruled",
        _RULE_SQL,
    ),
)
def m8(spark, sf):
    return thresholds.vote(ruled(spark, sf), list(_FLAGS.values())).select("event_id", "ensemble_anomaly", "confidence")


@check("m9_component_report")
def m9(spark, sf):
    df, names = scaled_logs(spark, sf)
    return components.component_report(df, "scaled", names)


@check("m10_projection")
def m10(spark, sf):
    df, _ = scaled_logs(spark, sf)
    return components.project_2d(df, "scaled").select("event_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@check(
    "m11_z_score",
    derived_sql(
        "flows",
        """select flow_id, round((bytes - m) / s, 6) as z_score, cast(abs((bytes - m) / s) > 1.5 as integer) as z_score_outlier
from flows, (select avg(bytes) as m, stddev_pop(bytes) as s from flows)""",
    ),
)
def m11(spark, sf):
    out = thresholds.z_scores(flows(spark, sf), "bytes", limit=1.5)
    return out.select("flow_id", F.round("z_score", 6).alias("z_score"), "z_score_outlier")


@check("a9_anomaly_results")
def a9(spark, sf):
    df, _ = anomaly.log_vectors(derived.spread(logs(spark, sf)), ["event_id", "level", "true_label"])
    df = df.persist(StorageLevel.DISK_ONLY)
    detector = anomaly.fit_detector(df)
    return writers.anomaly_results(detector.detect(df), detector.names)


@check(
    "a12_stored_vectoriser",
    derived_sql(
        "device_logs",
        """select event_id, coalesce(code, case when level is null then 0 else (select count(*) from codes) end)::double as code, true as same_width
from device_logs left join codes using (level)""",
        ("codes", "select level, row_number() over (order by level) - 1 as code from (select distinct level from device_logs where event_id % 4 > 0 and level <> 'INFO')"),
    ),
)
def a12(spark, sf):
    # INFO rows are as new as a quarter of the others to what was fitted and stored
    path = f"{scratch(spark)}/vectors"
    anomaly.fit_vectorizer(logs(spark, sf).where("event_id % 4 > 0 and level <> 'INFO'"), "log").write().save(path)
    model = RecordVectorizerModel.load(path)
    values = vector_to_array("features")
    code, width = model.names.index("level_encoded"), len(model.names)
    return model.transform(logs(spark, sf)).select("event_id", values[code].alias("code"), (F.size(values) == width).alias("same_width"))


# --- N: sequences --------------------------------------------------------------------


@check(
    "n1_previous_rows",
    """select event_id, array_to_string(list_transform(seq, lambda x: cast(x as varchar)), ',') as previous from (
  select event_id, list(event_id) over (partition by user_id order by ts, event_id rows between 10 preceding and 1 preceding) as seq from events)
where len(seq) = 10""",
)
def n1(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "ts")
    out = sequence.previous_rows(df, "user_id", ["ts", "event_id"], "event_id", 10)
    return out.select("event_id", F.concat_ws(",", F.transform("sequence", lambda x: x.cast("string"))).alias("previous"))


@check(
    "n1_previous_nulls",
    """select event_id, array_to_string(list_transform(seq, lambda x: coalesce(cast(x as varchar), '-')), ',') as previous from (
  select event_id, list(case when event_id % 3 > 0 then event_id end) over (partition by user_id order by ts, event_id rows between 10 preceding and 1 preceding) as seq from events)
where len(seq) = 10""",
)
def n1_nulls(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "ts", F.expr("if(event_id % 3 > 0, event_id, null)").alias("v"))
    out = sequence.previous_rows(df, "user_id", ["ts", "event_id"], "v", 10)
    return out.select("event_id", F.concat_ws(",", F.transform("sequence", lambda x: F.coalesce(x.cast("string"), F.lit("-")))).alias("previous"))


@check(
    "n1_global_previous_rows",
    """select event_id, array_to_string(list_transform(seq, lambda x: cast(x as varchar)), ',') as previous from (
  select event_id, list(event_id) over (order by ts, event_id rows between 10 preceding and 1 preceding) as seq from events)
where len(seq) = 10""",
)
def n1_global(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts")
    out = sequence.previous_rows(df, None, ["ts", "event_id"], "event_id", 10)
    return out.select("event_id", F.concat_ws(",", F.transform("sequence", lambda x: x.cast("string"))).alias("previous"))


@check("n1_feature_sequences")
def n1_features(spark, sf):
    rows = features.event_feature_row(events(spark, sf), keep=["event_id", "ts", "source_ip", "is_anomaly"])
    rows = rows.withColumn("vector", F.array(*V.EVENT_FEATURES)).select("event_id", "ts", "source_ip", "is_anomaly", "vector")
    out = sequence.previous_rows(rows, "source_ip", ["ts", "event_id"], "vector")
    return out.select("event_id", "is_anomaly", F.flatten("sequence").alias("sequence"))


@check("n2_event_index", "select event_id, row_number() over (order by ts, event_id) - 1 as event_index from events")
def n2(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts")
    return sequence.order_events(df, ["ts", "event_id"]).select("event_id", "event_index")


# --- O: monitoring and streams ---------------------------------------------------------


def _detectors(spark, sf):
    return {"syslog": monitor.fit_monitor(derived.spread(logs(spark, sf)), "syslog"),
            "flow": monitor.fit_monitor(derived.spread(flows(spark, sf)), "flow")}


@check("o1_o3_monitor_batch")
def o1(spark, sf):
    out = monitor.monitor_batch(logs(spark, sf), flows(spark, sf), _detectors(spark, sf))
    return out.groupBy("data_type", "is_anomaly", "confidence").agg(F.count("*").alias("n"))


@check(
    "o2_record_errors",
    derived_sql(
        "flows",
        """select flow_id, case when protocol = 'ICMP' then 'Flow processing error: invalid address' end as error from flows""",
    ),
)
def o2(spark, sf):
    bad = F.when(F.col("protocol") == "ICMP", F.concat(F.lit("host-"), "dst_ip")).otherwise(F.col("dst_ip"))
    return flows(spark, sf).withColumn("dst_ip", bad).select("flow_id", monitor.flow_error().alias("error"))


@check(
    "o3_tagged_results",
    derived_sql(
        "device_logs",
        """select data_type, count(*) as n, min(epoch_us(ts)) as first_time, max(epoch_us(ts)) as last_time from (
  select 'syslog' as data_type, ts from device_logs union all select 'flow', l_shipdate from lineitem) group by 1""",
    ),
)
def o3(spark, sf):
    def tagged(df, kind):
        return monitor.result_rows(
            df.select(F.col("ts").alias("event_time"), F.to_json(F.struct("*")).alias("entry"), F.lit(None).cast("string").alias("error"),
                      F.lit(0).alias("rule_anomaly"), F.lit(0).alias("ensemble_anomaly"), F.lit(0.0).alias("confidence")),
            ["rule"], kind,
        )

    both = tagged(logs(spark, sf), "syslog").unionByName(tagged(flows(spark, sf), "flow"))
    micros = F.unix_micros("timestamp")
    return both.groupBy("data_type").agg(
        F.count("entry").alias("n"), F.min(micros).alias("first_time"), F.max(micros).alias("last_time")
    )


@check(
    "o4_alerts",
    derived_sql(
        "device_logs",
        f"""select event_id, 'SYSLOG_ANOMALY' as alert_type, case when ({_VOTES}) / 3.0::double > 0.8 then 'HIGH' else 'MEDIUM' end as severity,
  ({_VOTES}) / 3.0::double as confidence from ruled where {_VOTES} >= 1.5 and ({_VOTES}) / 3.0::double > 0.5""",
        _RULE_SQL,
    ),
)
def o4(spark, sf):
    voted = thresholds.vote(ruled(spark, sf), list(_FLAGS.values()))
    rows = voted.select(
        F.col("ts").alias("event_time"), F.col("event_id").cast("string").alias("entry"), F.lit(None).cast("string").alias("error"),
        *[F.col(c).alias(f"{n}_anomaly") for n, c in _FLAGS.items()], "ensemble_anomaly", "confidence",
    )
    out = monitor.alerts(monitor.result_rows(rows, list(_FLAGS), "syslog"))
    return out.select(F.col("entry").cast("bigint").alias("event_id"), "alert_type", "severity", "confidence")


@check(
    "o4_paired_alerts",
    derived_sql(
        "device_logs",
        """select event_id, case when level_rule = 1 then 'SYSLOG_ANOMALY' when length_rule = 1 then 'FLOW_ANOMALY' end as alert_type,
  case when level_rule = 1 then 'HIGH' when length_rule = 1 then 'MEDIUM' end as severity from ruled""",
        _RULE_SQL,
    ),
)
def o4_pairs(spark, sf):
    pair = monitor.paired_alert(F.col("level_rule") == 1, F.lit(1.0), F.col("length_rule") == 1, F.lit(0.75))
    return ruled(spark, sf).select("event_id", pair.alias("a")).select("event_id", "a.alert_type", "a.severity")


@check("o5_a12_load_or_fit")
def o5(spark, sf):
    path = scratch(spark)
    fit = lambda: monitor.fit_monitor(derived.spread(logs(spark, sf)), "syslog")
    first = model_store.load_or_fit(spark, path, fit)
    again = model_store.load_or_fit(spark, path, fit)
    rows = [monitor.score(logs(spark, sf), d, "syslog").withColumn("run", F.lit(r)) for r, d in (("fit", first), ("load", again))]
    return rows[0].unionByName(rows[1]).groupBy("run", "is_anomaly", "confidence").agg(F.count("*").alias("n"))


def _stream_lines(spark, sf, files=None):
    """The lines as a stream, from ``files`` files with a trigger each."""
    folder = scratch(spark)
    rows = lines(spark, sf).select("line")
    (rows.repartition(files) if files else rows).write.text(f"{folder}/in")
    return folder, readers.stream_log_dir(spark, f"{folder}/in", "*.txt", max_files=1 if files else None)


def _run(stream, folder):
    query = cleaning.write_stream(stream, f"{folder}/out", f"{folder}/state", available_now=True)
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{folder}/out")


# the stateless stream keeps repeats, so it is compared before deduplication
@check(
    "o6_stream_cleaning",
    clean_sql("select event_category, count(*) as n from cleaned_all group by 1").replace(
        "survivors as (\nselect * from parsed qualify row_number() over (\n  partition by md5(concat(hostname, '-', program, '-', message, '-', coalesce(severity_name, ''))) order by line_no) = 1)",
        "survivors as (select * from parsed)",
    ).replace("cleaned_all", "cleaned"),
)
def o6(spark, sf):
    folder, stream = _stream_lines(spark, sf)
    out = _run(cleaning.clean_stream(stream, OPTIONS), folder)
    return out.groupBy("event_category").agg(F.count("*").alias("n"))


@check("c3_stream_dedup", clean_sql("select count(*) as n, count(distinct message) as messages from survivors", "survivors"))
def c3(spark, sf):
    folder, stream = _stream_lines(spark, sf, files=3)
    # all lines arrive within a day, whatever times they carry: the stream keeps what the batch keeps
    out = _run(cleaning.clean_stream(stream, OPTIONS, dedup_watermark="1 day"), folder)
    return out.agg(F.count("*").alias("n"), F.count_distinct("message").alias("messages"))


@check(
    "o7_window_counts",
    derived_sql("device_logs", "select epoch_us(date_trunc('hour', ts)) as window_start, count(*) as n from device_logs group by 1"),
)
def o7(spark, sf):
    out = cleaning.window_counts(logs(spark, sf), "ts")
    return out.select(F.unix_micros("window_start").alias("window_start"), "n")


# --- A: round trips through files ----------------------------------------------------------


@check(
    "a2_a3_json_round_trip",
    clean_sql("select id, hostname, message, event_category, risk_score, source_ip, issues from cleaned"),
)
def a2(spark, sf):
    path = f"{scratch(spark)}/json"
    writers.write_json(cleaned(spark, sf), path)
    back = readers.read_cleaned_json(spark, path)
    issues = F.concat_ws(";", "data_quality_issues").alias("issues")
    return back.select("id", "hostname", "message", "event_category", "risk_score", "source_ip", issues)


@check("a6_outputs_by_file", clean_sql("select 'events.log' as source_file, count(*) as n from cleaned"))
def a6(spark, sf):
    path = f"{scratch(spark)}/by_file"
    writers.write_by_source_file(cleaned(spark, sf), path)
    return spark.read.parquet(path).groupBy("source_file").agg(F.count("*").alias("n"))


@check("a13_classification_results")
def a13(spark, sf):
    records = cleaned_once(spark, sf)
    fitted, names = _train(records, list(classify.estimators()), folds=3)
    path = f"{scratch(spark)}/results"
    writers.write_metrics_json(
        {
            "model_performance": classify.comparison(spark, fitted),
            "feature_importance": classify.all_importances(spark, fitted, names),
            "data_insights": profile.class_distribution(records, "event_category"),
        },
        path,
    )
    return readers.read_metrics_json(spark, path, ["model_performance", "feature_importance", "data_insights"])
