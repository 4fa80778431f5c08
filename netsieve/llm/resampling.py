"""Importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm import words
from netsieve.llm.columns import add_columns, position
from netsieve.llm.store import stored
from netsieve.operators.ordering import global_index

BUCKETS = 10_000
TARGETS = 20_000  # target texts that the target model learns from, in expectation
SMOOTHING = 1.0


def _features(column):
    """First row, number of texts, text numbers and buckets of words and pairs of words."""
    for row, data, offsets in words.slices(column):
        data = words.lower(data)
        starts, ends, first = words.split(data, offsets, words.ALNUM)
        hashes = words.hash_spans(data, starts, ends)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        pairs = words.mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])[text[:-1] == text[1:]]
        texts = np.concatenate([text, text[:-1][text[:-1] == text[1:]]])
        buckets = np.concatenate([hashes, pairs]) % np.uint64(BUCKETS)
        yield row, len(offsets) - 1, texts, buckets.astype(np.int64)


def fit_weights(docs: DataFrame, is_target: str, text_col: str = "text") -> np.ndarray:
    """Log ratio of target to raw share for each bucket.

    The raw model counts all texts of ``docs``, the target model those where the boolean column
    ``is_target`` holds. Only bucket counts leave a task.
    """
    rows = docs.select(text_col, F.coalesce(F.col(is_target), F.lit(False)))

    def count(batches):
        total = np.zeros((2, BUCKETS))
        for batch in batches:
            target = batch.column(1).to_numpy(zero_copy_only=False)
            for row, _, texts, buckets in _features(batch.column(0)):
                total[0] += np.bincount(buckets, minlength=BUCKETS)
                total[1] += np.bincount(buckets[target[row + texts]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(total[0]), pa.array(total[1])], ["bucket", "raw", "target"])

    sums = rows.mapInArrow(count, "bucket long, raw double, target double").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    counts = np.zeros((2, BUCKETS))
    for bucket, raw, target in sums.collect():  # BUCKETS rows
        counts[:, bucket] = raw, target
    shares = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(shares[1]) - np.log(shares[0])


def log_weights(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_grams`` and ``log_weight``, the sum of the log ratios of a text's n-grams."""
    at = position(docs, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def weigh(batch):
        n_grams, weight = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows)
        for row, n, texts, buckets in _features(batch.column(at)):
            n_grams[row : row + n] = np.bincount(texts, minlength=n)
            weight[row : row + n] = np.bincount(texts, weights=sent.value[buckets], minlength=n)
        return [pa.array(n_grams), pa.array(weight)]

    return add_columns(docs, weigh, "n_grams long, log_weight double")


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_grams, log_weight, gumbel_key, selected``.

    Target text is that of documents labelled with quality 1 and not toxic, about ``TARGETS``
    of them drawn by hash (a documented bound); raw text is all of ``docs``. Selected are the
    ``share`` of rows (rounded) with the largest log weight plus Gumbel noise, which draws
    without replacement in proportion to the weights; ``share`` defaults to that of target
    rows among the labelled ones. Noise follows from the id and ``seed`` and is the same in
    every run; ties go to the smaller id.

    Null and empty texts have weight 0. Null ids share one noise. Rows that repeat are ranked
    each. Documents with contradicting labels count as not target. Without labels nothing is
    selected; an empty table gives an empty result. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    per_doc = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
    good = per_doc.agg(F.min(((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")).alias("good"))
    good = stored(good, "labels")
    n_labelled, n_good = good.agg(F.count("*"), F.coalesce(F.sum("good"), F.lit(0))).first()
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(TARGETS / max(n_good, 1), 1.0) * (1 << 20))
    # about TARGETS ids, whatever the number of labels
    targets = F.broadcast(good.where((F.col("good") == 1) & drawn).select("doc_id", F.lit(True).alias("target")))
    weights = fit_weights(docs.join(targets, "doc_id", "left"), "target")
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) + 0.5) / float(1 << 53)
    scored = log_weights(docs, weights).drop("text").withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))
    scored = stored(scored, "scored")
    share = (n_good / n_labelled if n_labelled else 0.0) if share is None else share
    k = round(share * scored.count())
    ranked = global_index(scored.withColumn("falling", -F.col("gumbel_key")), ["falling", "doc_id"], "rank")
    return ranked.select("doc_id", "n_grams", "log_weight", "gumbel_key", (F.col("rank") < k).alias("selected"))
