"""Streams against batches, alerts, stored models and files."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from netsieve.operators import classify, metrics
from netsieve.plans import anomaly
from netsieve.plans.clean import CleanOptions, clean, parse_table
from netsieve.sources import derived, model_store, readers, writers
from netsieve.streaming import cleaning, monitor

OPTIONS = CleanOptions(ref_year=derived.REF_YEAR)


def write_lines(spark, sf, folder):
    derived.log_lines(spark, sf).orderBy("line_seq").select("line").coalesce(1).write.text(str(folder))


def run(stream, folder):
    cleaning.write_stream(stream, f"{folder}/out", f"{folder}/state", available_now=True).awaitTermination()
    return stream.sparkSession.read.parquet(f"{folder}/out")


def test_stream_equals_batch(spark, sf, tmp_path):
    write_lines(spark, sf, tmp_path / "in")
    stream = readers.stream_log_dir(spark, str(tmp_path / "in"), "*.txt")
    got = run(cleaning.clean_stream(stream, OPTIONS), tmp_path)
    batch = clean(readers.read_log_dir(spark, str(tmp_path / "in"), "*.txt"), CleanOptions(ref_year=derived.REF_YEAR, remove_duplicates=False))
    cols = ["message", "hostname", "event_category", "source_ip", "risk_score", "normalized_time"]
    a, b = got.select(*cols), batch.select(*cols)
    assert a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_stream_dedup(spark, sf, tmp_path):
    write_lines(spark, sf, tmp_path / "in")
    stream = readers.stream_log_dir(spark, str(tmp_path / "in"), "*.txt")
    got = run(cleaning.clean_stream(stream, OPTIONS, dedup_watermark="3650 days"), tmp_path)
    batch = clean(readers.read_log_dir(spark, str(tmp_path / "in"), "*.txt"), OPTIONS)
    assert got.count() == batch.count()


def test_stream_window_counts(spark, sf, tmp_path):
    derived.device_logs(spark, sf).select("ts").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp").parquet(str(tmp_path / "in"))
    query = (
        cleaning.window_counts(stream, "ts").writeStream.outputMode("complete").format("memory").queryName("hours")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = cleaning.window_counts(derived.device_logs(spark, sf), "ts")
    assert spark.table("hours").exceptAll(batch).isEmpty() and spark.table("hours").count() == batch.count()


def test_monitor_stream_and_store(spark, sf, tmp_path):
    logs = derived.device_logs(spark, sf)
    detector = model_store.load_or_fit(spark, str(tmp_path / "m"), lambda: monitor.fit_monitor(logs, "syslog"))

    def never():
        raise AssertionError("the stored models must be used")

    stored = model_store.load_or_fit(spark, str(tmp_path / "m"), never)
    batch = monitor.score(logs, detector, "syslog")
    logs.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(logs.schema).parquet(str(tmp_path / "in"))
    got = run(monitor.score(stream, stored, "syslog"), tmp_path)
    cols = ["entry", "is_anomaly", "confidence", "error"]
    assert got.count() == batch.count() and got.select(*cols).exceptAll(batch.select(*cols)).isEmpty()
    assert got.where("is_anomaly").count() > 0


def test_errors_do_not_stop(spark, sf):
    detector = monitor.fit_monitor(derived.flows(spark, sf), "flow")
    row = (datetime(2024, 1, 1), "10.0.0.1", "nohost", 1, 2, "TCP", 0.0, 1, 64.0)
    fine = (datetime(2024, 1, 1), "10.0.0.1", "10.0.0.2", 1, 2, "GRE", 0.0, 1, 64.0)
    df = spark.createDataFrame(
        [row, fine],
        "ts timestamp, src_ip string, dst_ip string, src_port int, dst_port int, protocol string, duration double, packets int, bytes double",
    )
    bad, good = monitor.score(df, detector, "flow").orderBy(F.col("error").isNull()).collect()
    assert bad["error"] and bad["is_anomaly"] is None
    assert good["error"] is None and good["confidence"] is not None
    assert json.loads(good["entry"])["protocol"] == "GRE"


def test_alert_thresholds(spark):
    rows = [("syslog", True, 1.0), ("syslog", True, 0.5), ("flow", True, 0.6), ("flow", False, 1.0), ("flow", None, None)]
    df = spark.createDataFrame(rows, "data_type string, is_anomaly boolean, confidence double")
    df = df.withColumns({"individual_models": F.create_map(F.lit("m"), F.lit(1)), "entry": F.lit("{}")})
    got = {(r["alert_type"], r["severity"], r["confidence"]) for r in monitor.alerts(df).collect()}
    assert got == {("SYSLOG_ANOMALY", "HIGH", 1.0), ("FLOW_ANOMALY", "MEDIUM", 0.6)}


def test_sinks(spark, sf, tmp_path):
    lines = derived.log_lines(spark, sf)
    rows = clean(lines, OPTIONS).persist()
    writers.write_csv(rows, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert back.count() == rows.count() and len(back.columns) == 31
    writers.write_normalized_lines(rows, str(tmp_path / "log"))
    again = readers.read_log_dir(spark, str(tmp_path / "log"), "*.txt")
    formats = {r["format"] for r in parse_table(again, OPTIONS).select("format").distinct().collect()}
    assert formats <= {"rfc5424", "fallback"}
    writers.write_subsets(rows, str(tmp_path))
    auth = readers.read_cleaned_json(spark, str(tmp_path / "authentication_events"))
    assert auth.count() == rows.where("is_authentication").count()
    report = writers.cleaning_report(parse_table(lines, OPTIONS), rows)
    writers.write_report(report, str(tmp_path))
    texts = [r[0] for r in spark.read.text(str(tmp_path / "cleaning_summary")).collect()]
    assert any("device_type | - " in t for t in texts)
    n = {r["section"]: r["s"] for r in report.groupBy("section").agg(F.sum("n").alias("s")).collect()}
    assert n["device_type"] == n["event_category"] == n["severity_name"] == rows.count()


def test_missing_columns_become_null(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"id": "1", "message": "m"}]')
    row = readers.read_cleaned_json(spark, str(tmp_path), multiline=True).first()
    assert row["message"] == "m" and row["risk_score"] is None


def test_detector_finds_planted_flows(spark, sf, tmp_path):
    df, _ = anomaly.flow_vectors(derived.flows(spark, sf).repartition(4), ["true_label"])
    df = df.persist()
    detector = anomaly.fit_detector(df)
    scored = detector.detect(df).persist()
    assert scored.count() == df.count()
    table = metrics.binary_metrics(scored, "true_label", {n: f"{n}_anomaly" for n in detector.names})
    assert {r["model"] for r in table.collect()} == set(detector.names) == set(anomaly.ALL_MODELS)
    writers.write_anomaly_csv(scored, detector.names, str(tmp_path / "csv"))
    model_store.save_detector(spark, detector, str(tmp_path / "d"))
    assert model_store.load_detector(spark, str(tmp_path / "d")).names == detector.names


def test_train_and_compare(spark):
    from pyspark.ml.functions import array_to_vector

    rows = spark.range(300).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("label"),
        array_to_vector(F.array((F.col("id") % 3).cast("double"), F.rand(1))).alias("features"),
    )
    names = classify.estimators(trees=5, rounds=1, iterations=10)
    fitted, test = classify.train_and_compare(rows, "label", ["id"], names, folds=1)
    assert {m.name for m in fitted} == set(names) and fitted[0].accuracy == 1.0
    folded, _ = classify.train_and_compare(rows, "label", ["id"], {"Naive Bayes": names["Naive Bayes"]}, folds=3)
    assert 0.0 <= folded[0].cv_mean <= 1.0
    assert [m.accuracy for m in fitted] == sorted((m.accuracy for m in fitted), reverse=True)
    assert test.count() == 60
