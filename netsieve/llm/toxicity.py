"""Toxicity by class-conditional Kneser-Ney models that share their backoff counts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm import words
from netsieve.llm.columns import add_columns, position
from netsieve.llm.store import stored

SAMPLE = 20_000  # labelled texts a class that a model learns from, in expectation
CALIBRATION = 4  # one text in so many calibrates the score, the others are counted
BEGINNINGS = range(2, 11)  # bytes of the beginnings that a word backs off to
CHANCE = 3  # standard deviations by which a count has to exceed what chance explains
SPREAD = 0.5  # by how much of itself an expected count varies between kinds of text
ENTRIES = 1 << 20  # counts that a task holds before it passes them on


@dataclass
class ToxicityModel:
    """Everything that a score needs.

    ``expressions`` holds the sorted hashes of the words and beginnings of words that a class
    has beyond chance, ``ratios`` their log-likelihood ratios (toxic to ordinary).
    """

    expressions: np.ndarray
    ratios: np.ndarray
    slope: float = 0.0
    offset: float = 0.0
    usual: float = 0.0

    def evidence(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Mean log-likelihood ratio a word, and number of words, of each text of an Arrow column."""
        total, n_words = np.zeros(len(column)), np.zeros(len(column), dtype=np.int64)
        for row, n, texts, word, keys in _expressions(column):
            ratio = np.zeros(int(word.max(initial=-1)) + 1)
            for of, hashes in keys:  # the longest one held decides
                at = np.minimum(np.searchsorted(self.expressions, hashes), max(len(self.expressions) - 1, 0))
                held = np.flatnonzero(self.expressions[at] == hashes) if len(self.expressions) else np.zeros(0, dtype=np.int64)
                ratio[of[held]] = self.ratios[at[held]]
            total[row : row + n] = np.bincount(texts, weights=ratio[word], minlength=n)
            n_words[row : row + n] = np.bincount(texts, minlength=n)
        return total / np.maximum(n_words, 1), n_words

    def score(self, column) -> np.ndarray:
        mean, n_words = self.evidence(column)
        return np.where(n_words > 0, 1 / (1 + np.exp(-np.clip(self.offset + self.slope * mean, -500, 500))), self.usual)


def _expressions(column):
    """First row, number of texts, text and distinct word of each word, and the keys of the distinct words.

    Keys come as word numbers and hashes, beginnings from short to long, then whole words.
    """
    for row, data, offsets in words.slices(column):
        data = words.lower(data)
        starts, ends, first = words.split(data, offsets, words.ALNUM)
        whole, sample, word = np.unique(words.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        starts, ends = starts[sample], ends[sample]
        keys = []
        for size in BEGINNINGS:
            of = np.flatnonzero(ends - starts >= size)
            keys.append((of, words.hash_spans(data, starts[of], starts[of] + size)))
        keys.append((np.arange(len(whole)), words.mix(whole + words.seeds(1, salt=7))))
        yield row, len(offsets) - 1, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), word, keys


def _texts_with(column):
    """First row, number of texts, distinct keys, and each text with each of its keys once."""
    for row, n, texts, word, keys in _expressions(column):
        of, hashes = (np.concatenate([k[i] for k in keys]) for i in (0, 1))
        distinct, number = np.unique(hashes, return_inverse=True)
        order = np.argsort(of, kind="stable")
        of, number = of[order], number[order]
        n_words = int(word.max(initial=-1)) + 1
        lo, hi = np.searchsorted(of, np.arange(n_words)), np.searchsorted(of, np.arange(n_words), side="right")
        pair = np.unique(texts * max(n_words, 1) + word)
        texts, word = pair // max(n_words, 1), pair % max(n_words, 1)
        many = (hi - lo)[word]
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo[word], many)
        once = np.unique(np.repeat(texts, many) * max(len(distinct), 1) + number[at])
        yield row, n, distinct, once // max(len(distinct), 1), once % max(len(distinct), 1)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Learn from the texts of ``docs`` whose id has a label in ``labels``, and backoff from all.

    About ``SAMPLE`` labelled rows a class are drawn by the hash of their ids, a documented bound. Of
    several labels of an id the largest counts, null labels don't; equal texts count once. Words
    are runs of letters, digits and characters beyond ASCII, A to Z in lower case. An expression
    is a word or its beginning of 2 to 10 bytes.

    Counts are numbers of distinct contexts, as Kneser-Ney backoff has them: a text counts an
    expression once. Both classes back off to shared counts, those of all expressions in all of
    ``docs``. The discount of a count is the usual absolute one and what chance explains: the
    share of the class's texts that the shared counts let expect, and ``CHANCE`` standard
    deviations of it (``SPREAD`` widens them, since texts come in languages and kinds). The mass taken off
    goes to the shared counts. An expression that neither class has beyond chance is left out:
    a rare word backs off to its longest beginning that is held, one without to the shared
    counts, where both classes agree.

    The score is a logistic function of the mean log ratio a word, fitted on a quarter of the
    labelled texts that the counts leave out, weighted to the classes' real shares. Without a
    labelled text of both classes nothing can be compared: all scores are the share of toxic
    labels, 0 without any.
    """
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id is not null and toxic is not null")
    rows = stored(rows.groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic")), "labels")
    sizes = dict(rows.groupBy("toxic").count().collect())  # two rows
    if len(sizes) < 2:
        return ToxicityModel(np.zeros(0, dtype=np.uint64), np.zeros(0), offset=-500.0 if 1 not in sizes else 500.0, usual=float(next(iter(sizes), 0)))
    share = {k: min(SAMPLE / n, 1.0) for k, n in sizes.items()}
    drawn = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * (1 << 20))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    # about two times SAMPLE rows, whatever the tables' sizes
    sample = texts.join(F.broadcast(drawn), "id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    sample = stored(sample.select("text", "toxic", (F.pmod(F.xxhash64("text"), F.lit(CALIBRATION)) > 0).alias("counted")), "sample")
    expressions, ratios = _held(sample.where("counted"), texts.select("text"))
    return _calibrated(ToxicityModel(expressions, ratios), sample.where(~F.col("counted")), {k: 1 / share[k] for k in share})


def _held(sample: DataFrame, texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Expressions that a class has beyond chance, sorted, and their log ratios."""
    shared = stored(texts.mapInArrow(_count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "shared")
    n_texts = texts.count()
    own = stored(sample.select("text", "toxic").mapInArrow(_count_classes, "key long, n0 long, n1 long").groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "classes")
    columns = [F.count_if(F.col(f"n{k}") == x) for k in (0, 1) for x in (1, 2)] + [F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in (0, 1)]
    once0, twice0, once1, twice1, sum0, sum1 = own.agg(*columns).first()
    size = dict(sample.groupBy("toxic").count().collect())  # two rows
    rows = own.where("n0 > 1 or n1 > 1").join(shared, "key")
    facts = ((0, once0, twice0), (1, once1, twice1))
    for k, once, twice in facts:
        usual = float(np.clip(once / (once + 2 * twice), 0.1, 0.9)) if once + twice else 0.75
        expected = F.col("n") * (size.get(k, 0) / max(n_texts, 1))
        chance = expected + CHANCE * F.sqrt(expected + (SPREAD * expected) ** 2) + usual
        rows = rows.withColumn(f"e{k}", expected).withColumn(f"kept{k}", F.when(F.col(f"n{k}") > 1, F.greatest(F.col(f"n{k}") - chance, F.lit(0.0))).otherwise(0.0))
    held = rows.where("kept0 > 0 or kept1 > 0").toPandas()  # a part of the sample's expressions
    left = [1 - held[f"kept{k}"].sum() / max(total, 1) for k, total in ((0, sum0), (1, sum1))]
    p0, p1 = ((held[f"kept{k}"] + left[k] * held[f"e{k}"]).to_numpy() / max(size.get(k, 0), 1) for k in (0, 1))
    keys = held["key"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], (np.log(np.maximum(p1, 1e-12)) - np.log(np.maximum(p0, 1e-12)))[order]


def _count(batches):
    """Texts that have each expression."""
    some, size = [], 0
    for batch in batches:
        for _, _, distinct, _, keys in _texts_with(batch.column(0)):
            some.append((distinct, np.bincount(keys, minlength=len(distinct))))
            size += len(distinct)
            if size >= ENTRIES:
                some = [_added(some)]
                size = len(some[0][0])
                if size >= ENTRIES // 2:
                    yield _rows(*some[0])
                    some, size = [], 0
    if some:
        yield _rows(*_added(some))


def _added(parts):
    keys, often = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, weights=often, minlength=len(distinct)).astype(np.int64)


def _rows(keys, often):
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(often)], ["key", "n"])


def _count_classes(batches):
    """Texts of each class that have each expression."""
    for batch in batches:
        toxic = batch.column(1).to_numpy().astype(np.int64)
        for row, _, distinct, texts, keys in _texts_with(batch.column(0)):
            n1 = np.bincount(keys, weights=toxic[row + texts], minlength=len(distinct)).astype(np.int64)
            n0 = np.bincount(keys, minlength=len(distinct)) - n1
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(n0), pa.array(n1)], ["key", "n0", "n1"])


def _calibrated(model: ToxicityModel, sample: DataFrame, weights: dict) -> ToxicityModel:
    """Fit the logistic function of the mean log ratio on texts that were not counted."""
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        for batch in batches:
            mean, n_words = sent.value.evidence(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(mean), pa.array(n_words), batch.column(1)], ["mean", "n_words", "toxic"])

    found = sample.select("text", "toxic").mapInArrow(measure, "mean double, n_words long, toxic int").toPandas()  # bounded by the sample
    weight = found["toxic"].map(weights).to_numpy(dtype=float)
    toxic = found["toxic"].to_numpy(dtype=float)
    model.usual = float(np.average(toxic, weights=weight)) if len(found) else 0.0
    some = found["n_words"].to_numpy() > 0
    model.offset, model.slope = _logistic(found["mean"].to_numpy()[some], toxic[some], weight[some])
    return model


def _logistic(x, y, weight) -> tuple[float, float]:
    """Offset and slope by Newton's method, with a weak pull towards 0."""
    if not len(x) or not x.std():
        return 0.0, 0.0
    scale = x.std()
    design = np.stack([np.ones(len(x)), x / scale], axis=1)
    theta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -500, 500)))
        gradient = design.T @ (weight * (y - p)) - 1e-3 * theta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        theta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1] / scale)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` (1 from 0.5 on).

    Whole texts are scored. A null text, or one without a word, gets the share of toxic texts
    among the labelled ones as its score. Equal texts get equal scores; an empty table
    gives an empty result; columns named like a result give way. The model is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = position(docs, text_col)

    def score(batch):
        value = sent.value.score(batch.column(at))
        return [pa.array(value), pa.array((value >= 0.5).astype(np.int32))]

    return add_columns(docs, score, "score double, predicted int")
