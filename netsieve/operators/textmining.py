"""TF-IDF vectors, sentiment by word list and related text operators."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    ElementwiseProduct,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.functions.text import sentiment_label


def term_stages(text: str, out: str, bigrams: bool = False, stop_words: list | None = None) -> tuple[list, str]:
    """Stages from a text to its words (and pairs of words), with nothing to fit, and the column of terms."""
    tokenizer = RegexTokenizer(
        inputCol=text, outputCol=f"_{out}_raw", pattern=r"\b\w\w+\b", gaps=False, toLowercase=True
    )
    stop = StopWordsRemover.loadDefaultStopWords("english") if stop_words is None else list(stop_words)
    remover = StopWordsRemover(inputCol=f"_{out}_raw", outputCol=f"_{out}_words", stopWords=stop)
    stages = [tokenizer, remover]
    terms = f"_{out}_words"
    if bigrams:
        stages.append(NGram(n=2, inputCol=terms, outputCol=f"_{out}_pairs"))
        stages.append(SQLTransformer(statement=f"select *, concat({terms}, _{out}_pairs) as _{out}_terms from __THIS__"))
        terms = f"_{out}_terms"
    return stages, terms


def fit_tfidf(
    df: DataFrame,
    text: str,
    out: str = "tfidf",
    max_terms: int = 50,
    bigrams: bool = False,
    min_df: float = 1.0,
    max_df: float = 1.0,
    stop_words: list | None = None,
) -> PipelineModel:
    """Vocabulary by total count, smoothed idf plus 1, unit length.

    ``min_df`` and ``max_df`` read as in the source: an integer is a row count, a fraction up
    to 1.0 a share of rows (``min_df`` takes its counts as floats too). A fitted model holds
    the terms that at least ``min_df`` and at most ``max_df`` rows have.
    """
    stages, terms = term_stages(text, out, bigrams, stop_words)
    staged = df
    for s in stages:
        staged = s.transform(staged)
    staged = staged.select(terms)
    counter = CountVectorizer(
        inputCol=terms, outputCol=f"_{out}_tf", vocabSize=max_terms, minDF=min_df,
        # for this setting one is a row count, so a share of all rows has to be spelt as no upper limit
        maxDF=max_df if isinstance(max_df, int) or max_df < 1.0 else 2**62,
    ).fit(staged)
    idf = IDF(inputCol=f"_{out}_tf", outputCol=f"_{out}_idf").fit(counter.transform(staged))
    weights = Vectors.dense(np.asarray(idf.idf.toArray()) + 1.0)
    weigh = ElementwiseProduct(scalingVec=weights, inputCol=f"_{out}_tf", outputCol=f"_{out}_weighted")
    unit = Normalizer(inputCol=f"_{out}_weighted", outputCol=out, p=2.0)
    return PipelineModel([*stages, counter, weigh, unit])


def vocabulary(model: PipelineModel) -> list[str]:
    return next(s.vocabulary for s in model.stages if hasattr(s, "vocabulary"))


def term_weights(model: PipelineModel) -> list[float]:
    return next(s.getScalingVec() for s in model.stages if isinstance(s, ElementwiseProduct)).toArray().tolist()


def polarity(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Add ``sentiment_score``, the mean polarity of the listed words of a row (0 without
    any), and ``sentiment``. ``lexicon`` has ``word, polarity``; ``key`` is unique."""
    words = df.select(key, F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"[a-z']+"), F.lit(0))).alias("word"))
    hits = words.join(lexicon, "word")
    # all words of a row sit in one task, so the partial sums already fold to one per row
    scores = hits.groupBy(key).agg(F.avg("polarity").alias("sentiment_score"))
    out = df.join(scores, key, "left")
    out = out.withColumn("sentiment_score", F.round(F.coalesce("sentiment_score", F.lit(0.0)), 6))
    return out.withColumn("sentiment", sentiment_label(F.col("sentiment_score")))


def sentiment_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))


def extreme_negative(df: DataFrame, k: int = 5, order: str = "desc") -> DataFrame:
    """The k "largest" scores among negative rows, ties kept.

    ``desc`` is the source's reading (least negative first), ``asc`` gives the most
    negative rows. The k-th score becomes a filter, so ties of any number stay
    spread over the cluster.
    """
    negative = df.where(F.col("sentiment") == "negative")
    by = F.desc("sentiment_score") if order == "desc" else F.asc("sentiment_score")
    top = [r[0] for r in negative.select("sentiment_score").orderBy(by).limit(k).collect()]
    if not top:
        return negative
    edge = top[-1]
    return negative.where(F.col("sentiment_score") >= edge if order == "desc" else F.col("sentiment_score") <= edge)
