"""Vectors of log and flow records: fitted once, stored, and applied to rows not seen before."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsieve import fixed_values as V
from netsieve.functions import features as feat
from netsieve.operators import textmining

KINDS = {"log": ("level", "level_encoded"), "flow": ("protocol", "protocol_encoded")}


class _VectorParams(Params):
    kind = Param(Params._dummy(), "kind", "log or flow", TypeConverters.toString)
    tsCol = Param(Params._dummy(), "tsCol", "time of a record", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "the vector", TypeConverters.toString)

    def __init__(self, **given):
        super().__init__()
        self._setDefault(kind="log", tsCol="ts", outputCol="features")
        self._set(**given)

    @property
    def coded(self) -> str:
        return KINDS[self.getOrDefault("kind")][0]


class RecordVectorizer(Estimator, _VectorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the codes of level (logs) or protocol (flows), and of logs the terms of the message with their weights.

    ``maxTerms`` terms (words and pairs) are kept that at least ``minDF`` rows and at most the share
    ``maxDF`` of them have. Codes follow the alphabet; the driver gets the distinct values
    and the terms, not rows.
    """

    maxTerms = Param(Params._dummy(), "maxTerms", "terms kept", TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "rows that have a term", TypeConverters.toFloat)
    maxDF = Param(Params._dummy(), "maxDF", "share of rows that have a term", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, kind="log", tsCol="ts", outputCol="features", maxTerms=50, minDF=5.0, maxDF=0.8):
        super().__init__(**self._input_kwargs)
        self._setDefault(maxTerms=50, minDF=5.0, maxDF=0.8)

    def _fit(self, dataset: DataFrame) -> RecordVectorizerModel:
        column = F.col(self.coded)
        codes = sorted(r[0] for r in dataset.where(column.isNotNull()).select(self.coded).distinct().collect())
        vocabulary, weights = [], []
        if self.getOrDefault("kind") == "log":
            text = dataset.select(F.coalesce("message", F.lit("")).alias("message"))
            terms = textmining.fit_tfidf(
                text, "message", max_terms=self.getOrDefault("maxTerms"), bigrams=True, min_df=self.getOrDefault("minDF"), max_df=self.getOrDefault("maxDF")
            )
            vocabulary = textmining.vocabulary(terms)
            weights = textmining.term_weights(terms)
        own = {p: self.getOrDefault(p) for p in ("kind", "tsCol", "outputCol")}
        return RecordVectorizerModel(codes=codes, vocabulary=vocabulary, weights=weights, **own)


class RecordVectorizerModel(Model, _VectorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the vector to any rows: the same columns in the same order, whatever the rows hold.

    A value without a code gets the number of codes, null gets 0; words beyond the vocabulary
    have no place. All its state is parameters, so it is stored by itself or in a pipeline.
    """

    codes = Param(Params._dummy(), "codes", "values by code", TypeConverters.toListString)
    vocabulary = Param(Params._dummy(), "vocabulary", "terms by place", TypeConverters.toListString)
    weights = Param(Params._dummy(), "weights", "inverse frequencies by place", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, kind="log", tsCol="ts", outputCol="features", codes=None, vocabulary=None, weights=None):
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        super().__init__(**given)
        self._setDefault(codes=[], vocabulary=[], weights=[])

    @property
    def names(self) -> list[str]:
        """Names of the vector's columns."""
        if self.getOrDefault("kind") == "flow":
            return list(V.FLOW_FEATURES)
        return list(V.LOG_FEATURES) + [f"tfidf_{i}" for i in range(len(self.getOrDefault("vocabulary")))]

    def code(self, value: Column) -> Column:
        codes = self.getOrDefault("codes")
        if not codes:
            return F.when(value.isNotNull(), F.lit(0))
        return F.when(value.isNotNull(), feat.lookup(value, {v: i for i, v in enumerate(codes)}, len(codes)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, ts = self.getOrDefault("outputCol"), self.getOrDefault("tsCol")
        own = [c for c in dataset.columns if c != out]
        # the rows' own columns keep their values, even where a feature has the same name
        kept = {f"_own_{i}": F.col(f"`{c}`") for i, c in enumerate(own)}
        rows, code = dataset.withColumns(kept), self.code(F.col(self.coded))
        if self.getOrDefault("kind") == "flow":
            parts, rows = V.FLOW_FEATURES, feat.flow_feature_row(rows, code, ts, keep=list(kept))
        else:
            rows = feat.log_feature_row(rows, code, ts, keep=[*kept, F.coalesce("message", F.lit("")).alias("_message")])
            parts = [*V.LOG_FEATURES, *(["_terms"] if self.getOrDefault("vocabulary") else [])]
            rows = self._with_terms(rows)
        rows = VectorAssembler(inputCols=list(parts), outputCol="_vector").transform(rows)
        return rows.select(*[F.col(k).alias(c) for k, c in zip(kept, own, strict=True)], F.col("_vector").alias(out))

    def _with_terms(self, rows: DataFrame) -> DataFrame:
        vocabulary = self.getOrDefault("vocabulary")
        if not vocabulary:
            return rows
        stages, terms = textmining.term_stages("_message", "_terms", bigrams=True)
        count = CountVectorizerModel.from_vocabulary(vocabulary, inputCol=terms, outputCol="_terms_tf")
        weigh = ElementwiseProduct(scalingVec=Vectors.dense(self.getOrDefault("weights")), inputCol="_terms_tf", outputCol="_terms_weighted")
        for stage in [*stages, count, weigh, Normalizer(inputCol="_terms_weighted", outputCol="_terms", p=2.0)]:
            rows = stage.transform(rows)
        return rows
