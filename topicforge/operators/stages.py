"""Text to topic as stages of one Spark ML ``Pipeline``.

``topic_pipeline()`` is the whole way from a text column to a cluster::

    TermCounts    text -> terms, tfs          T1-T12, P3, F2 (blank rows go)
    Stored        written once, lineage cut
    TfidfWeights  terms, tfs -> idxs, vals    F3-F8
    LsaFeatures   idxs, vals -> lsa           F9, F10
    Stored
    Normalizer    lsa -> features             Spark's own, unit length
    TopicKMeans   features -> cluster         C1, C2

Fitted, it is a ``PipelineModel`` that ``save`` writes and ``PipelineModel.load``
reads as one object; ``transform`` then labels any table with ``doc_id`` and the
text column and keeps its other columns.  Models are stored as Parquet tables
beside the usual stage metadata.

Rows need a ``doc_id``.  A table that already has a column a stage would add is
refused.
"""

from __future__ import annotations

import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicforge.operators import kmeans as km
from topicforge.operators import lsa
from topicforge.operators import tfidf as tf
from topicforge.session import checkpoint_dir


def _refuse(df: DataFrame, *added: str) -> None:
    taken = {c.lower() for c in df.columns} & {c.lower() for c in added}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are in the table already")


def _others(df: DataFrame, *used: str) -> tuple[str, ...]:
    return tuple(c for c in df.columns if c not in used)


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, kind)


class TermCounts(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Cleaned, tokenised and counted text; rows without a token are dropped."""

    inputCol = _param("inputCol", "text column", TypeConverters.toString)
    stopWords = _param("stopWords", "words to leave out", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCol: str = "text", stopWords: list[str] | None = None):
        super().__init__()
        self._setDefault(inputCol="text", stopWords=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        _refuse(df, "tokens", "terms", "tfs")
        return tf.count_texts(df, self.getOrDefault(self.inputCol), self.getOrDefault(self.stopWords) or None)


class Stored(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The rows as they are, written to the checkpoint folder: the stages behind
    it read them from there however often they need them."""

    def _transform(self, df: DataFrame) -> DataFrame:
        checkpoint_dir(df.sparkSession)
        return df.checkpoint()


class _TableWriter(MLWriter):
    """Stage metadata, and the model's tables in the folder ``data``."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage._save_tables(self.sparkSession, os.path.join(path, "data"))


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls._of_tables(self.sparkSession, os.path.join(path, "data"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class _TableModel(Model, MLReadable, MLWritable):
    """A model that is stored as tables."""

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class TfidfWeights(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Vocabulary and idf of counted documents."""

    minDf = _param("minDf", "least number of documents with a term", TypeConverters.toInt)
    maxDf = _param("maxDf", "greatest share of documents with a term", TypeConverters.toFloat)
    maxFeatures = _param("maxFeatures", "most terms, by count", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, minDf: int = 5, maxDf: float = 0.8, maxFeatures: int = 5000):
        super().__init__()
        self._setDefault(minDf=5, maxDf=0.8, maxFeatures=5000)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> TfidfWeightsModel:
        checkpoint_dir(df.sparkSession)
        p = tf.VocabParams(*(self.getOrDefault(x) for x in (self.minDf, self.maxDf, self.maxFeatures)))
        n_docs = df.count()
        vocabulary = tf.fit_vocabulary(tf.term_rows(df), n_docs, p).checkpoint()
        return TfidfWeightsModel(tf.TfidfModel(vocabulary, n_docs, p))


class TfidfWeightsModel(_TableModel):
    def __init__(self, fitted: tf.TfidfModel):
        super().__init__()
        self.fitted = fitted

    def _transform(self, df: DataFrame) -> DataFrame:
        _refuse(df, "idx", "term", "weight", "idxs", "vals")
        return tf.weigh(df, self.fitted.vocabulary, packed=True, carry=_others(df, "doc_id", "terms", "tfs"))

    def _save_tables(self, spark: SparkSession, path: str) -> None:
        self.fitted.save(path)

    @classmethod
    def _of_tables(cls, spark: SparkSession, path: str) -> TfidfWeightsModel:
        return cls(tf.TfidfModel.load(spark, path))


class LsaFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Truncated SVD of weighed documents."""

    k = _param("k", "number of components", TypeConverters.toInt)
    seed = _param("seed", "seed of the start basis", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, k: int = 300, seed: int = 42):
        super().__init__()
        self._setDefault(k=300, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> LsaFeaturesModel:
        n_terms = df.agg(F.max(F.array_max("idxs"))).first()[0]
        if n_terms is None:
            raise ValueError("no document has a term of the vocabulary")
        return LsaFeaturesModel(lsa.fit_lsa(df, n_terms + 1, df.count(), self.getOrDefault(self.k),
                                            self.getOrDefault(self.seed)))


class LsaFeaturesModel(_TableModel):
    def __init__(self, fitted: lsa.LsaModel):
        super().__init__()
        self.fitted = fitted

    def _transform(self, df: DataFrame) -> DataFrame:
        _refuse(df, "features", "lsa")
        out = lsa.project(df, None, self.fitted, normalise=False, carry=_others(df, "doc_id", "idxs", "vals"))
        return out.withColumn("lsa", array_to_vector("features")).drop("features")

    def _save_tables(self, spark: SparkSession, path: str) -> None:
        lsa.save_lsa(spark, self.fitted, path)

    @classmethod
    def _of_tables(cls, spark: SparkSession, path: str) -> LsaFeaturesModel:
        return cls(lsa.load_lsa(spark, path))


class TopicKMeans(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Spark's K-Means with the relative tolerance of ``kmeans.py``; the model
    is Spark's ``KMeansModel``."""

    k = _param("k", "number of clusters", TypeConverters.toInt)
    seed = _param("seed", "seed of the start points", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, k: int = 34, seed: int = 42):
        super().__init__()
        self._setDefault(k=34, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        k, n = self.getOrDefault(self.k), df.count()
        if not 1 <= k <= n:
            raise ValueError(f"k={k} with {n} points")
        return KMeans(k=k, seed=self.getOrDefault(self.seed), maxIter=300, tol=km.center_tolerance(df, "features"),
                      featuresCol="features", predictionCol="cluster").fit(df)


def topic_pipeline(text_col: str = "text", stopwords: list[str] | None = None, vocab: tf.VocabParams = tf.VocabParams(),
                   n_components: int = 300, n_topics: int = 34, seed: int = 42) -> Pipeline:
    """All stages from text to cluster."""
    return Pipeline(stages=[
        TermCounts(inputCol=text_col, stopWords=stopwords), Stored(),
        TfidfWeights(minDf=vocab.min_df, maxDf=vocab.max_df, maxFeatures=vocab.max_features),
        LsaFeatures(k=n_components, seed=seed), Stored(),
        Normalizer(p=2.0, inputCol="lsa", outputCol="features"),
        TopicKMeans(k=n_topics, seed=seed)])
