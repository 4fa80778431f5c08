"""Headline timings; prints one JSON line.

Log lines are read from text files, as a user would read them; the files are derived
from the test tables before the clock starts. Every query runs twice and the second
time counts; the first times are listed under ``cold``.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from netsieve import fixed_values as V  # noqa: E402
from netsieve.functions import features, text  # noqa: E402
from netsieve.operators import encode, profile, sequence, textmining  # noqa: E402
from netsieve.operators.anomaly import components, density, iforest, ocsvm, thresholds  # noqa: E402
from netsieve.plans import anomaly  # noqa: E402
from netsieve.plans.clean import CleanOptions, clean, parse_table  # noqa: E402
from netsieve.session import build_session, ensure_checkpoint_dir  # noqa: E402
from netsieve.sources import derived, readers, writers  # noqa: E402

# 60,150 lines in 16.267577891 s, single process
BASELINE_LINES_PER_SECOND = 60150 / 16.267577891


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"{ensure_checkpoint_dir(spark)}/bench-{int(time.time() * 1000)}"
    derived.log_lines(spark, sf).repartitionByRange(int(cpus), "line_seq").sortWithinPartitions("line_seq").select(
        "line"
    ).write.text(f"{folder}/lines")
    derived.spread(derived.device_logs(spark, sf)).write.parquet(f"{folder}/logs")
    derived.spread(derived.flows(spark, sf)).write.parquet(f"{folder}/flows")
    options = CleanOptions(ref_year=derived.REF_YEAR)

    def lines():
        return readers.read_log_dir(spark, f"{folder}/lines", "*.txt")

    logs = lambda: spark.read.parquet(f"{folder}/logs")
    flows = lambda: spark.read.parquet(f"{folder}/flows")

    def sink(df):
        df.write.format("noop").mode("overwrite").save()

    sink(clean(lines(), options))
    clean(lines(), options).write.parquet(f"{folder}/cleaned")
    cleaned = lambda: spark.read.parquet(f"{folder}/cleaned")
    scaled_flows, _ = anomaly.flow_vectors(flows(), ["true_label"])
    scaler = encode.fit_population_scaler(scaled_flows)
    scaler.transform(scaled_flows).select("scaled", "true_label").write.parquet(f"{folder}/scaled_flows")
    scaled_logs, _ = anomaly.log_vectors(logs(), ["event_id"])
    encode.fit_population_scaler(scaled_logs).transform(scaled_logs).select("event_id", "scaled").write.parquet(f"{folder}/scaled_logs")
    sflows = lambda: spark.read.parquet(f"{folder}/scaled_flows")
    slogs = lambda: spark.read.parquet(f"{folder}/scaled_logs")

    def iso():
        sink(iforest.fit_predict(sflows(), "scaled")[1])

    def svm():
        sink(ocsvm.fit_one_class_svm(sflows(), "scaled").predict(sflows(), "scaled"))

    def pca():
        sink(components.pca_flags(sflows(), components.fit_pca(sflows(), "scaled"), "scaled", 0.05))

    def tfidf():
        sink(textmining.fit_tfidf(logs(), "message", max_terms=50, bigrams=True, min_df=5, max_df=0.8).transform(logs()))

    def flow_features():
        coded = encode.label_encode(flows(), "protocol", "code")
        sink(features.flow_feature_row(coded, F.col("code")))

    def log_features():
        sink(features.log_feature_row(logs(), features.monitor_level_code(F.col("level"))))

    def all_outputs():
        # as the published run: JSON, CSV, normalised lines, subsets and the report
        out = f"{folder}/outputs-{time.time_ns()}"
        parsed = parse_table(lines(), options)
        clean(lines(), options).write.parquet(f"{out}/cleaned")
        done = spark.read.parquet(f"{out}/cleaned")
        writers.write_json(done, f"{out}/json")
        writers.write_csv(done, f"{out}/csv")
        writers.write_normalized_lines(done, f"{out}/lines")
        writers.write_subsets(done, f"{out}/subsets")
        writers.cleaning_report(parsed, done).write.json(f"{out}/report")

    queries = {
        "clean_all_outputs": all_outputs,
        "clean_lines": lambda: sink(clean(lines(), options)),
        "category_risk": lambda: sink(
            clean(lines(), options).groupBy("event_category").agg(F.count("*"), F.avg("risk_score"))
        ),
        "cleaning_totals": lambda: sink(profile.cleaning_totals(parse_table(lines(), options))),
        "distributions": lambda: sink(profile.distribution(cleaned(), ["device_type", "event_category", "severity_name"])),
        "record_totals": lambda: sink(profile.record_totals(cleaned())),
        "top_source_ips": lambda: sink(profile.top_counts(cleaned(), "source_ip")),
        "log_features": log_features,
        "flow_features": flow_features,
        "processed_text": lambda: sink(logs().select(text.processed_message(F.col("message")))),
        "tfidf": tfidf,
        "stratified_split": lambda: sink(encode.stratified_split(logs(), "category", ["event_id"])),
        "percentile_flag": lambda: sink(thresholds.flag_above(flows(), "bytes", "flag", 0.95)),
        "event_index": lambda: sink(sequence.order_events(logs().select("event_id", "ts"), ["ts", "event_id"])),
        "sequences": lambda: sink(
            sequence.previous_rows(logs().select("event_id", "ts", "device"), "device", ["ts", "event_id"], "event_id")
        ),
        "isolation_forest": iso,
        "one_class_svm": svm,
        "pca_error": pca,
        "density_noise": lambda: sink(density.density_noise(slogs(), "scaled")),
    }
    cold, warm = {}, {}
    for name, run in queries.items():
        for times in (cold, warm):
            start = time.time()
            run()
            times[name] = round(time.time() - start, 3)
    n = lines().count()
    rate = n / warm["clean_lines"]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "lines": n,
                "clean_lines_per_second": round(rate),
                "baseline_lines_per_second": round(BASELINE_LINES_PER_SECOND),
                "times_baseline": round(rate / BASELINE_LINES_PER_SECOND, 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
