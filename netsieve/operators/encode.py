"""Encoders, scalers, assembly and the stratified split."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netsieve.functions.features import lookup
from netsieve.operators.ordering import global_index
from netsieve.operators.skew import join_spread


def category_values(df: DataFrame, column: str) -> list:
    """Sorted distinct values, for results with a column per value."""
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def code_table(df: DataFrame, column: str) -> DataFrame:
    """``(column, code)`` with alphabetical codes from 0, for any number of values."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return global_index(values, [column], "code").select(column, F.col("code").cast("int").alias("code"))


def label_encode(df: DataFrame, column: str, out: str) -> DataFrame:
    """Alphabetical integer codes, by a join that spreads frequent values; null stays null."""
    codes = code_table(df, column).withColumnRenamed("code", out)
    return join_spread(df.drop(out), codes, [column]).select(*[c for c in df.columns if c != out], out)


def label_code(value: Column, values: list) -> Column:
    return lookup(value, {v: i for i, v in enumerate(values)}, None)


def one_hot_columns(column: str, prefix: str, values: list) -> list[Column]:
    """0/1 columns ``prefix_value``; null counts as ``unknown``, an unseen value is all zeros."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("unknown"))
    return [(value == v).cast("int").alias(f"{prefix}_{v}") for v in values]


def fit_one_hot(df: DataFrame, column: str) -> list:
    """Values seen in training, in column order; null is the value ``unknown``.

    A column per value suits values that a reader can list; for others see :func:`one_hot_sparse`.
    """
    filled = df.select(F.coalesce(F.col(column).cast("string"), F.lit("unknown")).alias("v"))
    return category_values(filled, "v")


def one_hot_sparse(df: DataFrame, column: str, codes: DataFrame, out: str) -> DataFrame:
    """Add ``out``, the codes of the cells that hold a 1, for any number of values.

    ``codes`` is a :func:`code_table` of the training rows; an unseen value and null have no cell.
    """
    coded = join_spread(df, codes.withColumnRenamed("code", "_code"), [column])
    cells = F.array_compact(F.array("_code"))
    return coded.withColumn(out, cells).select(*[c for c in df.columns if c != out], out)


def population_stats(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; one pass, one row to the driver."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def standardize_columns(df: DataFrame, columns: list[str], stats: dict | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column is only centred."""
    stats = stats or population_stats(df, columns)
    scaled = {}
    for c in columns:
        mean, dev = stats[c]
        centred = F.col(c) - F.lit(mean)
        scaled[c] = centred / F.lit(dev) if dev else centred
    return df.withColumns(scaled)


def assemble(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=out).transform(df)


def fit_population_scaler(df: DataFrame, input_col: str = "features", output_col: str = "scaled") -> PipelineModel:
    """Vector scaler with population deviation: the sample-based one times sqrt(n / (n - 1))."""
    n = df.count()
    width = len(df.select(input_col).first()[0])
    sample = StandardScaler(inputCol=input_col, outputCol=f"_{output_col}", withMean=True, withStd=True).fit(df)
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    return PipelineModel(
        [
            sample,
            ElementwiseProduct(
                scalingVec=Vectors.dense([factor] * width), inputCol=f"_{output_col}", outputCol=output_col
            ),
        ]
    )


def shift_non_negative(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: minus its minimum plus 1, only where a negative value exists."""
    low = df.agg(*[F.min(c).alias(c) for c in columns]).first()
    return df.withColumns({c: F.col(c) - F.lit(low[c]) + 1 for c in columns if low[c] is not None and low[c] < 0})


def drop_unlabelled(df: DataFrame, label: str) -> DataFrame:
    return df.na.drop(subset=[label])


def stratified_split(df: DataFrame, label: str, key: list[str], test: float = 0.2, seed: int = 42, digits: int = 3) -> DataFrame:
    """Add ``is_test``: within each label the share ``test`` with the smallest md5 of the key.

    The hash that ends a label's share is found by radix selection: a pass counts the rows of
    each label by the leading ``digits`` hex digits, the next one counts the following digits
    of those rows only that share the digits of the cut, until the cut falls between two
    groups. Then each row is a test row if its hash is not beyond the cut: rows are neither
    shuffled nor sorted, what moves is a count per label and group, and one row a label is
    broadcast. Rows with one key fall on the same side.

    If a label has a single row, nothing can be held out of it in proportion: then the whole table is
    split at once, whatever the labels. ``key`` must tell rows apart; drop rows without a
    label first.
    """
    text = F.concat_ws(":", *[F.col(f"`{c}`").cast("string") for c in key], F.lit(str(seed)))
    rows = df.select(F.col(f"`{label}`").alias("label"), F.md5(text).alias("hash"))
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.agg(F.min("n")).first()[0] == 1
    if whole:
        rows = rows.withColumn("label", F.lit(""))
        sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    # a row a label: how many rows are still to be taken behind the digits of the cut so far
    open_ = {r["label"]: ("", r["left"]) for r in sizes.select("label", F.ceil(F.col("n") * F.lit(test)).alias("left")).collect()}
    kind, cuts, at = sizes.schema["label"].dataType, {}, 0
    while open_:
        at += digits
        found = _cut_groups(rows, {k: v for k, v in open_.items()}, kind, at)
        open_ = {}
        for lab, group, n, left in found:
            # all rows of the group are taken, or all digits are known
            if n == left or at >= 32:
                cuts[lab] = group
            else:
                open_[lab] = (group, left)
    spark = df.sparkSession
    table = spark.createDataFrame([(k, v + "g") for k, v in cuts.items()], StructType().add("_label", kind).add("_cut", "string"))
    own = F.lit("") if whole else F.col(f"`{label}`")
    out = df.join(F.broadcast(table), own == F.col("_label"), "left")
    return out.withColumn("is_test", F.md5(text) < F.col("_cut")).drop("_label", "_cut")


def _cut_groups(rows: DataFrame, open_: dict, kind, digits: int) -> list:
    """Of each open label the group of leading digits that holds the cut, its rows, and how many of them are taken."""
    table = rows.sparkSession.createDataFrame([(k, *v) for k, v in open_.items()], StructType().add("label", kind).add("head", "string").add("left", "long"))
    inside = rows.join(F.broadcast(table), "label").where(F.col("hash").startswith(F.col("head")))
    groups = inside.groupBy("label", "left", F.substring("hash", 1, digits).alias("group")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("label").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = groups.select("label", "group", "n", (F.col("left") - before).alias("taken"))
    return [tuple(r) for r in taken.where("taken > 0 and taken <= n").collect()]


def stratified_folds(df: DataFrame, label: str, key: list[str], folds: int, seed: int = 42, buckets: int = 4096) -> DataFrame:
    """Add ``fold`` (0 to ``folds`` - 1): each label is dealt evenly, to one row, over the folds.

    Rows are numbered inside hash buckets of a label, and buckets go on counting where the
    ones before end, so no window runs over the rows of a whole label.
    """
    hashed = F.xxhash64(*[F.col(c) for c in key], F.lit(seed))
    rows = df.withColumn("_hash", hashed).withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    sizes = rows.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(label, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(label, "_bucket").orderBy("_hash", *key)
    number = F.col("_before") + F.row_number().over(inside) - 1
    dealt = rows.join(sizes, [label, "_bucket"]).withColumn("fold", F.pmod(number, F.lit(max(folds, 1))).cast("int"))
    return dealt.select(*df.columns, "fold")
