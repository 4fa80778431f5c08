"""Language of texts by n-gram filters that hold a mask of languages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsieve.llm import words
from netsieve.llm.columns import add_columns, free_name, position
from netsieve.llm.store import stored

GRAMS = (3, 4, 5)  # bytes
SAMPLE = 4000  # labelled texts a language that a model learns from, in expectation
SHARE = 0.5  # an n-gram belongs to a language if it is at least this often as in the best one
LOAD = 16  # slots for each n-gram of the language with the most, at least
FEWEST = 1 << 16  # slots of the smallest filter
PROBES = 4
SLICE = 1 << 17  # bytes of texts at once: an n-gram takes some 70 bytes while it is looked up

# Bytes of words: letters in lower case and everything beyond ASCII.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_PROBE_SEEDS = words.seeds(PROBES, salt=5)


class LanguageModel:
    """Bit-sliced Bloom filters: slot ``i`` of ``masks`` holds a bit for each language.

    The mask of an n-gram is the AND of its ``PROBES`` slots, so one look-up tells all
    languages that contain it. ``false_rate`` is the share of slots that are set, to the
    power of ``PROBES``: the chance that a language claims an n-gram it does not have.
    """

    def __init__(self, languages: list[str], masks: np.ndarray, usual: int = 0):
        self.languages = languages
        self.masks = masks
        self.usual = usual  # the most frequent language decides where no n-gram is known
        bits = np.array([((masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))])
        self.false_rate = bits**PROBES

    @classmethod
    def build(cls, languages: list[str], grams: np.ndarray, owners: np.ndarray, usual: int = 0) -> LanguageModel:
        """``grams`` (64-bit hashes) with the number of the language that each belongs to.

        The number of slots is a power of two that follows the language with the most n-grams.
        """
        most = int(np.bincount(owners, minlength=1).max())
        masks = np.zeros((max(1 << (LOAD * most).bit_length(), FEWEST), max(-(-len(languages) // 64), 1)), dtype=np.uint64)
        for slot in _slots(grams, len(masks)):
            np.bitwise_or.at(masks, (slot, owners // 64), np.uint64(1) << (owners % 64).astype(np.uint64))
        return cls(languages, masks, usual)

    def predict(self, column) -> tuple[list[str], np.ndarray]:
        """Language and score of each text of an Arrow column."""
        if not self.languages:
            return ["und"] * len(column), np.zeros(len(column))
        lettered = _lettered(column)
        best, score, _ = self._count(column)
        names = [self.languages[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, np.clip(score, 0, 1), 0.0)

    def recognise(self, column, labels: list[str | None]) -> np.ndarray:
        """Whether a language is found in each text, or at least can't be denied.

        It is denied to texts without letters and to those whose n-grams are all unknown. Where
        the filters hold nothing to compare with (no n-gram at all, or none of the text's own
        label) and in texts too short for an n-gram, letters are enough.
        """
        lettered = _lettered(column)
        held = {x for x, rate in zip(self.languages, self.false_rate, strict=True) if rate > 0}
        if not held:
            return lettered
        _, score, total = self._count(column)
        unheld = np.array([x is not None and x not in held for x in labels], dtype=bool)
        return lettered & ((score > 0) | (total == 0) | unheld)

    def _count(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the best language, its score and the number of n-grams of each text."""
        best, score, grams_of = (np.zeros(len(column), dtype=t) for t in (np.int64, np.float64, np.int64))
        for row, data, offsets in words.slices(pc.utf8_lower(column), SLICE):
            n = len(offsets) - 1
            counts, total = np.zeros((n, len(self.languages))), np.zeros(n)
            for texts, grams in _grams(data, offsets):
                total += np.bincount(texts, minlength=n)
                mask = None
                for slot in _slots(grams, len(self.masks)):
                    mask = self.masks[slot] if mask is None else mask & self.masks[slot]
                for k in range(len(self.languages)):
                    claimed = (mask[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
                    counts[:, k] += np.bincount(texts, weights=claimed, minlength=n)
            # n-grams claimed by chance come off
            counts = np.maximum(counts - total[:, None] * self.false_rate, 0) / (1 - self.false_rate)
            best[row : row + n] = np.where(counts.any(axis=1), counts.argmax(axis=1), self.usual)
            score[row : row + n] = counts.max(axis=1) / np.maximum(counts.sum(axis=1), 1e-9)
            grams_of[row : row + n] = total
        return best, score, grams_of


def _lettered(column) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(column, r"\pL"), False).to_numpy(zero_copy_only=False)


def _slots(grams, n):
    """The probes of each n-gram among ``n`` slots, a power of two."""
    shift = np.uint64(65 - int(n).bit_length())
    for seed in _PROBE_SEEDS:
        yield (((grams ^ seed) * (seed | np.uint64(1))) >> shift).astype(np.int64)


def _grams(data, offsets):
    """Text numbers and hashes of the n-grams, for each length.

    Every byte that is no letter counts as a blank. N-grams do not run over the end of a
    text or over a blank inside, so the blanks around a word are part of its n-grams only.
    """
    letter = _LETTER[data]
    codes = np.where(letter, data, 0x20).astype(np.uint64)
    texts = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for size in GRAMS:
        n = len(codes) - size + 1
        if n <= 0:
            continue
        packed = np.full(n, size, dtype=np.uint64)
        inner = np.ones(n, dtype=bool)
        for k in range(size):
            packed = (packed << np.uint64(8)) | codes[k : k + n]
            if 0 < k < size - 1:
                inner &= letter[k : k + n]
        at = np.flatnonzero(inner & (texts[:n] == texts[size - 1 :]))
        yield texts[at], words.mix(packed[at])


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id") -> LanguageModel:
    """Learn from the rows of ``docs`` that have a language and a text.

    The model learns from about ``SAMPLE`` texts a language, drawn by the hash of
    ``key_col``: a documented bound on labelled rows, and the only one. All languages are
    learned, and every n-gram that the sample has twice belongs to each language where its
    share of all n-grams is at least ``SHARE`` of its largest share in any; the filter grows
    with them. Without labelled rows the model knows no language and answers ``und``. Of
    languages that are equally frequent the first by name decides where no n-gram is known.
    Repeated rows count as often as they occur, an empty table gives a model without languages.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(key_col)).alias("h"))
    rows = rows.where("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()  # a row a language
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return LanguageModel([], np.zeros((2, 1), dtype=np.uint64))
    number = {x: k for k, x in enumerate(languages)}
    known = [(r["lang"], number[r["lang"]], min(SAMPLE / r["n"], 1.0)) for r in sizes]
    known = F.broadcast(docs.sparkSession.createDataFrame(known, "lang string, code int, share double"))
    sample = rows.join(known, "lang").where(F.pmod("h", F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("text", "code")

    def count(batches):
        for batch in batches:
            codes = batch.column(1).to_numpy().astype(np.int64)
            for row, data, offsets in words.slices(pc.utf8_lower(batch.column(0)), SLICE):
                for texts, grams in _grams(data, offsets):
                    own = codes[row + texts]
                    for k in np.unique(own):
                        values, n = np.unique(grams[own == k], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(values.view(np.int64)), pa.array(np.full(len(values), k, np.int32)), pa.array(n)], ["gram", "code", "n"]
                        )

    counts = sample.mapInArrow(count, "gram long, code int, n long").groupBy("gram", "code").agg(F.sum("n").alias("n"))
    counts = stored(counts, "grams")
    totals = counts.groupBy("code").agg(F.sum("n").alias("total"))  # a row a language
    rates = counts.join(F.broadcast(totals), "code").withColumn("rate", F.col("n") / F.col("total"))
    best = F.max("rate").over(Window.partitionBy("gram"))  # at most a row a language
    owners = rates.withColumn("best", best).where((F.col("rate") >= SHARE * F.col("best")) & (F.col("n") > 1)).select("gram", "code").toPandas()
    grams = owners["gram"].to_numpy(dtype=np.int64).view(np.uint64)
    return LanguageModel.build(languages, grams, owners["code"].to_numpy(dtype=np.int64), number[sizes[0]["lang"]])


def predict_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    The n-grams of the whole text look up their languages; the language with the most, after
    taking off those claimed by chance, wins, and its share of all claims is the score. Ties
    go to the first language by name, a text without a known n-gram to the most frequent one. A null text, or one without letters, is ``und`` with
    score 0. Repeated rows get the same answer, an empty table gives an empty result, columns named
    like a result give way. The model (a bit per language for each of its slots) is broadcast.
    """
    spark: SparkSession = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.languages, model.masks, model.usual))
    at = position(docs, text_col)
    loaded: list[LanguageModel] = []

    def predict(batch):
        if not loaded:
            loaded.append(LanguageModel(*sent.value))
        names, score = loaded[0].predict(batch.column(at))
        return [pa.array(names, pa.string()), pa.array(score, pa.float64())]

    return add_columns(docs, predict, "lang_pred string, score double")


def drop_unrecognised(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows in whose text the model finds no language."""
    spark: SparkSession = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.languages, model.masks, model.usual))
    text, label, found = position(docs, text_col), position(docs, lang_col), free_name(docs, "found")
    loaded: list[LanguageModel] = []

    def recognise(batch):
        if not loaded:
            loaded.append(LanguageModel(*sent.value))
        return [pa.array(loaded[0].recognise(batch.column(text), batch.column(label).to_pylist()), pa.bool_())]

    return add_columns(docs, recognise, f"{found} boolean").where(found).select(*docs.columns)
