"""Evaluation of labels against predictions, as aggregates.

Every function first folds rows to (label, prediction) or per-score counts on the
map side; the rest works on those few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsieve.operators.encode import category_values
from netsieve.operators.ordering import running_totals


def _ratio(part, whole):
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str, flags: dict[str, str]) -> DataFrame:
    """One row per model (``name: flag column``): precision, recall, F1, accuracy, detections.

    All models are counted in one pass; a division by zero gives 0.
    """
    y = F.col(label) == 1
    counts = []
    for name, flag in flags.items():
        p = F.col(flag) == 1
        counts.append(
            F.struct(
                F.lit(name).alias("model"),
                F.count_if(p & y).alias("tp"),
                F.count_if(p & ~y).alias("fp"),
                F.count_if(~p & y).alias("fn"),
                F.count_if(~p & ~y).alias("tn"),
            )
        )
    rows = df.agg(F.array(*counts).alias("m")).select(F.explode("m").alias("m")).select("m.*")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rows = rows.withColumns({"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn)})
    p, r = F.col("precision"), F.col("recall")
    return rows.select(
        "model",
        "precision",
        "recall",
        _ratio(2 * p * r, p + r).alias("f1_score"),
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        (tp + fp).alias("anomalies_detected"),
    )


def best_model(metrics: DataFrame, by: str = "f1_score") -> DataFrame:
    return metrics.orderBy(F.desc(by), "model").limit(1)


def prediction_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class precision, recall, F1 and support, then the macro and weighted means."""
    counts = prediction_counts(df, label, prediction)
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(
            F.col("label").cast("string").alias("class"), F.col("n").alias("support"),
            zero.alias("predicted"), hit.alias("tp"),
        ),
        F.struct(
            F.col("prediction").cast("string").alias("class"), zero.alias("support"),
            F.col("n").alias("predicted"), zero.alias("tp"),
        ),
    )
    per = counts.select(F.explode(sides).alias("s")).select("s.*").groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    per = per.withColumns(
        {"precision": _ratio(F.col("tp"), F.col("predicted")), "recall": _ratio(F.col("tp"), F.col("support"))}
    )
    p, r = F.col("precision"), F.col("recall")
    per = per.select("class", "precision", "recall", _ratio(2 * p * r, p + r).alias("f1_score"), "support")
    parts = ["precision", "recall", "f1_score"]
    macro = per.agg(
        F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in parts], F.sum("support").alias("support")
    )
    weighted = per.agg(
        F.lit("weighted avg").alias("class"),
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in parts],
        F.sum("support").alias("support"),
    )
    return per.unionByName(macro).unionByName(weighted)


def confusion_matrix(df: DataFrame, label: str, prediction: str, values: list | None = None) -> DataFrame:
    """One row per label, one ``pred_<value>`` column per predicted value.

    :func:`prediction_counts` is the same in long form, for any number of classes.
    """
    counts = prediction_counts(df, label, prediction)
    if values is None:
        values = category_values(counts, "prediction")
    wide = counts.groupBy("label").pivot("prediction", values).agg(F.sum("n"))
    return wide.select("label", *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(f"pred_{v}") for v in values])


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve by ranks, ties counted half.

    Rows fold to counts per distinct score; the running count of negatives is built
    per score range, never in one task.
    """
    y = F.col(label) == 1
    per = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")
    )
    ranked = running_totals(per, ["score"], {"neg_before": "neg"})
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    return ranked.agg(_ratio(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    same = F.col(label).cast("double") == F.col(prediction).cast("double")
    return df.agg(_ratio(F.count_if(same), F.count(F.lit(1))).alias("accuracy"))


def accuracy_at(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    return accuracy(df.withColumn("_pred", (F.col(score) > threshold).cast("int")), label, "_pred")
