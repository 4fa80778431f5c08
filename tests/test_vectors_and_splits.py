"""The stored vectoriser, the split by radix selection, stems and accents by distinct values."""

import hashlib
import math
import random
import unicodedata

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from netsieve.functions import text
from netsieve.functions.stemming import stem
from netsieve.operators import encode, textmining
from netsieve.operators.vectorise import RecordVectorizer, RecordVectorizerModel
from netsieve.plans import anomaly
from netsieve.sources import derived, model_store


def logs(spark, rows):
    out = spark.createDataFrame(rows, "event_id long, level string, message string, at string, hour string")
    return out.withColumn("ts", F.col("at").cast("timestamp"))


def january(spark):
    said = ["link down on port", "link up on port", "login failed for user", "cpu high on core"]
    return logs(spark, [(i, ["INFO", "WARN", "ERROR"][i % 3], said[i % 4], f"2024-01-{i % 28 + 1:02d} 10:00:00", "h") for i in range(60)])


def test_stored_vectoriser_gives_unseen_rows_the_same_columns(spark, tmp_path):
    fitted = RecordVectorizer(kind="log").fit(january(spark))
    path = str(tmp_path / "vectors")
    PipelineModel([fitted]).write().save(path)
    back = PipelineModel.load(path).stages[0]
    assert isinstance(back, RecordVectorizerModel) and back.names == fitted.names
    february = logs(spark, [(1, "CRITICAL", "fan broken badly", "2024-02-03 11:00:00", "x"), (2, "INFO", "link down on port", None, None), (3, None, None, "2024-02-04 00:00:00", "y")])
    got = back.transform(february)
    assert got.columns == [*february.columns, "features"]
    rows = {r["event_id"]: r for r in got.collect()}
    assert all(len(r["features"]) == len(fitted.names) for r in rows.values())
    assert [rows[k]["hour"] for k in (1, 2, 3)] == ["x", None, "y"]
    code = fitted.names.index("level_encoded")
    # ERROR 0, INFO 1, WARN 2; beyond them 3, null 0
    assert [rows[k]["features"][code] for k in (1, 2, 3)] == [3.0, 1.0, 0.0]
    n = len(fitted.names) - len(fitted.getOrDefault("vocabulary"))
    terms = {k: r["features"].toArray()[n:] for k, r in rows.items()}
    assert terms[1].sum() == 0 and math.isclose((terms[2] ** 2).sum(), 1) and terms[3].sum() == 0
    assert [r["features"] for r in fitted.transform(february).orderBy("event_id").collect()] == [rows[k]["features"] for k in (1, 2, 3)]


def test_one_row_is_scored_like_among_many(spark):
    rows = january(spark)
    fitted = RecordVectorizer(kind="log").fit(rows)
    many = {r["event_id"]: r["features"] for r in fitted.transform(rows).collect()}
    one = fitted.transform(rows.where("event_id = 7")).first()["features"]
    assert one == many[7]


def test_detector_is_stored_with_its_vectoriser(spark, sf, tmp_path):
    rows = derived.flows(spark, sf).repartition(4)
    detector = anomaly.fit_record_detector(rows, "flow", models=("isolation_forest", "pca"))
    model_store.save_detector(spark, detector, str(tmp_path / "d"))
    back = model_store.load_detector(spark, str(tmp_path / "d"))
    some = rows.where("flow_id % 7 = 0").withColumn("protocol", F.when(F.col("flow_id") % 2 == 0, "NEW").otherwise(F.col("protocol")))
    kept = ["flow_id", "isolation_forest_anomaly"]
    assert sorted(back.detect(some).select(kept).collect()) == sorted(detector.detect(some).select(kept).collect())


def test_max_df_as_a_count_and_as_a_share(spark):
    rows = spark.createDataFrame([("aa bb",), ("aa cc",), ("aa bb dd",), ("aa ee",)], "message string")

    def held(**settings):
        return set(textmining.vocabulary(textmining.fit_tfidf(rows, "message", stop_words=[], **settings)))

    assert held(max_df=2) == {"bb", "cc", "dd", "ee"}
    assert held(max_df=1) == {"cc", "dd", "ee"}
    assert held(max_df=0.5) == {"bb", "cc", "dd", "ee"}
    assert held(max_df=1.0) == {"aa", "bb", "cc", "dd", "ee"}
    assert held(min_df=2, max_df=3) == {"bb"}


def brute_split(rows, test=0.2):
    out, labels = set(), {r[1] for r in rows}
    tiny = any(sum(r[1] == lab for r in rows) == 1 for lab in labels)
    for lab in [None] if tiny else labels:
        keyed = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i, own in rows if tiny or own == lab)
        out |= {i for _, i in keyed[: math.ceil(len(keyed) * test)]}
    return out


def test_split_equals_ranking_by_hash(spark):
    rng = random.Random(3)
    for rows in ([(i, rng.choice("aaaabbc")) for i in range(700)], [(i, "a") for i in range(9)], [(1, "a"), (2, "b"), (3, "b"), (4, "b")]):
        for digits in (1, 3):
            out = encode.stratified_split(spark.createDataFrame(rows, "i long, c string"), "c", ["i"], digits=digits)
            assert out.columns == ["i", "c", "is_test"]
            assert {r["i"] for r in out.where("is_test").collect()} == brute_split(rows)


def test_split_moves_no_rows(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("label"), F.repeat(F.lit("x"), 50).alias("wide"))
    plan = encode.stratified_split(df, "label", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange range" not in plan and "Sort " not in plan


def test_stems_and_accents_by_distinct_values(spark):
    rows = [(["running", "links"], "élan Ångström"), ([], "plain"), (None, None), (["links", "failed", "links"], "日本 é"), (["x"], "")]
    got = spark.createDataFrame(rows, "words array<string>, said string").coalesce(1).select(text.stemmed_text("words"), text.strip_accents("said")).collect()

    def bare(s):
        return None if s is None else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))

    assert [tuple(r) for r in got] == [(None if w is None else " ".join(stem(x) for x in w), bare(s)) for w, s in rows]
