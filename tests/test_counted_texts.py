"""Counting plain texts, the written Gram matrix, and what the LSA stage cleans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicforge.functions import text as tx
from topicforge.operators import lsa
from topicforge.operators import tfidf as tf
from topicforge.operators.common import keep_where

TEXTS = [None, "", " \t", "a b c", "Bài THỂ thao thể-thao x9y9zz", "xem https://a.vn/b tin và www.c.vn tin", "me@x.vn và a.com rồi",
         "ß ÀÉÎ çà iİ ΣΑΣ ééé", "một_hai ba;;ba  ba", "http:/x ://y z.comx"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, f"s{i % 2}", t) for i, t in enumerate(TEXTS)], "doc_id long, source string, text string")


@pytest.mark.parametrize("stopwords", [None, ["tin", "thể"]])
def test_counted_texts_are_the_counted_tokens(spark, docs, stopwords):
    rows = lambda df: sorted((r.doc_id, r.source, r.terms, r.tfs) for r in df.collect())
    want = rows(tf.count_terms(tf.document_tokens(docs, stopwords=stopwords, keep=["source"])))
    assert want and rows(tf.document_counts(docs, stopwords=stopwords, keep=["source"])) == want
    assert rows(tf.count_texts(docs, "text", stopwords)) == want


def test_processed_texts_are_the_native_ones(spark, docs):
    native = docs.select("doc_id", tx.processed_content(F.col("text")).alias("processed_content"))
    want = sorted(map(tuple, keep_where(native, tx.not_blank(F.col("processed_content"))).collect()))
    assert want and sorted(map(tuple, tf.processed_texts(docs).collect())) == want


@pytest.mark.parametrize("n_terms", [3, 64, 150])
def test_written_gram_matrix(spark, n_terms, monkeypatch):
    monkeypatch.setattr(lsa, "_GRAM_PAIRS", 50)
    monkeypatch.setattr(lsa, "_GRAM_ROWS", 7)
    rng = np.random.default_rng(n_terms)
    a = rng.random((40, n_terms)) * (rng.random((40, n_terms)) < 0.3)
    rows = [(i, np.flatnonzero(r).tolist()[::-1], r[np.flatnonzero(r)].tolist()[::-1]) for i, r in enumerate(a)]
    df = spark.createDataFrame(rows, "doc_id long, idxs array<int>, vals array<double>").repartition(5)
    q = rng.standard_normal((n_terms, 2))
    for tasks in (1, 3):
        assert np.allclose(lsa._gram_times(lsa._gram_blocks(df, n_terms, tasks), q), a.T @ (a @ q))


def test_both_ways_to_the_components(spark, monkeypatch):
    rng = np.random.default_rng(1)
    a = rng.random((60, 12)) * (rng.random((60, 12)) < 0.5)
    rows = [(i, np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for i, r in enumerate(a)]
    df = spark.createDataFrame(rows, "doc_id long, idxs array<int>, vals array<double>")
    formed = lsa.fit_lsa(df, 12, 60, 4)
    monkeypatch.setattr(lsa, "_GRAM_CELLS", 0)
    passes = lsa.fit_lsa(df, 12, 60, 4)
    assert np.allclose(formed.singular_values, passes.singular_values)
    assert np.allclose(formed.components, passes.components)


def test_lsa_stage_reads_written_weights(spark, small_tables):
    from topicforge.plans import catalog
    ids, _, weights, _ = catalog.lsa_stage(spark, small_tables)
    for df in (ids, weights):     # neither the texts nor the counts are evaluated again
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "://" not in plan.replace("file://", "") and "MapInArrow" not in plan
