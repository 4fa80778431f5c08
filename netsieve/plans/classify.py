"""Feature vectors and training plans of the supervised stages."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve import fixed_values as V
from netsieve.functions import features as feat
from netsieve.functions.text import processed_message, strip_accents
from netsieve.operators import encode, textmining

TIME = ["hour", "day_of_week", "is_weekend", "is_business_hours"]
MINING_NUMERIC = ["message_length", "word_count", "ip_count", "interface_count", "hour", "severity_numeric"]


def _one_hot_stages(columns: list[str]) -> list:
    """Sparse one-hot per column; a value unseen in training is all zeros."""
    # the index of unseen values is the last slot, and the last slot is dropped
    index = StringIndexer(
        inputCols=columns, outputCols=[f"_{c}_index" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    )
    hot = OneHotEncoder(inputCols=[f"_{c}_index" for c in columns], outputCols=[f"{c}_is" for c in columns], dropLast=True)
    return [index, hot]


def classifier_columns(df: DataFrame, exclude_rule_flags: bool = False) -> tuple[DataFrame, list[str], list[str]]:
    """Filled numeric and categorical columns that exist in ``df``, with time features.

    ``exclude_rule_flags`` leaves out the flags that restate the target category.
    """
    have = feat.present_columns(df)
    flags = [] if exclude_rule_flags else have["boolean"]
    df = df.withColumns(
        {
            **{c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in have["numeric"]},
            **{c: F.col(c).cast("int") for c in have["boolean"]},
            **{c: F.coalesce(F.col(c), F.lit("unknown")) for c in have["categorical"]},
        }
    )
    if "timestamp" in df.columns:
        df = feat.classifier_time_features(df)
    else:
        df = df.withColumns({"hour": F.lit(12), "day_of_week": F.lit(0), "is_weekend": F.lit(0), "is_business_hours": F.lit(1)})
    return df, have["numeric"] + flags + TIME, have["categorical"]


def fit_classifier_vectors(df: DataFrame, exclude_rule_flags: bool = False) -> PipelineModel:
    rows, numeric, categorical = classifier_columns(df, exclude_rule_flags)
    tfidf = textmining.fit_tfidf(rows.select(F.coalesce("message", F.lit("")).alias("message")), "message", max_terms=50)
    hot = Pipeline(stages=_one_hot_stages(categorical)).fit(rows)
    assemble = VectorAssembler(inputCols=numeric + [f"{c}_is" for c in categorical] + ["tfidf"], outputCol="features")
    return PipelineModel([tfidf, hot, assemble])


def classifier_vectors(df: DataFrame, keep: list[str], exclude_rule_flags: bool = False) -> DataFrame:
    """``keep`` columns and the classifier's feature vector of cleaned records.

    Fitting reads ``df`` several times: pass a stored or persisted table.
    """
    model = fit_classifier_vectors(df, exclude_rule_flags)
    rows, _, _ = classifier_columns(df, exclude_rule_flags)
    return model.transform(rows).select(*keep, "features")


def mining_columns(df: DataFrame, level: str = "level", ts: str = "ts") -> DataFrame:
    """Processed text and the six numeric columns of the text classifiers."""
    text = F.col("message")
    df = df.withColumn("processed_message", processed_message(text))
    return df.withColumns(
        {
            "plain_message": strip_accents(F.col("processed_message")),
            "message_length": F.length(text),
            "word_count": feat.word_count(F.col("processed_message")),
            "ip_count": feat.ip_count(text),
            "interface_count": feat.interface_count(text),
            "hour": F.hour(ts),
            "severity_numeric": F.coalesce(feat.mining_level_code(F.col(level)), F.lit(0)),
        }
    )


def fit_mining_vectors(rows: DataFrame) -> PipelineModel:
    tfidf = textmining.fit_tfidf(
        rows.select("plain_message"), "plain_message", max_terms=5000, bigrams=True, min_df=2, max_df=0.95
    )
    return PipelineModel([tfidf, VectorAssembler(inputCols=["tfidf", *MINING_NUMERIC], outputCol="features")])


def new_text_columns(df: DataFrame) -> DataFrame:
    """Columns for messages without a record: the numeric part is all zeros."""
    df = df.withColumn("plain_message", strip_accents(processed_message(F.col("message"))))
    return df.withColumns({c: F.lit(0) for c in MINING_NUMERIC})


def fit_event_vectors(df: DataFrame) -> PipelineModel:
    """Scaled vectors of labelled events: 14 numeric columns, three one-hot blocks, 100 terms."""
    rows = event_columns(df)
    categorical = ["event_type", "facility", "severity"]
    tfidf = textmining.fit_tfidf(rows.select("message"), "message", max_terms=100)
    hot = Pipeline(stages=_one_hot_stages(categorical)).fit(rows)
    assemble = VectorAssembler(
        inputCols=V.EVENT_FEATURES + [f"{c}_is" for c in categorical] + ["tfidf"], outputCol="raw_features"
    )
    wide = PipelineModel([tfidf, hot, assemble])
    scaler = encode.fit_population_scaler(wide.transform(rows), "raw_features", "features")
    return PipelineModel([wide, scaler])


def event_columns(df: DataFrame, ts: str = "ts") -> DataFrame:
    df = feat.with_event_features(df, ts)
    return df.withColumns({c: F.col(c).cast("double") for c in V.EVENT_FEATURES})
