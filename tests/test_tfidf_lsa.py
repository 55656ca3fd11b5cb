"""TF-IDF vocabulary edges and weights vs a numpy statement of the formulas;
LSA singular values and projections vs numpy's exact SVD."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicforge.operators import lsa
from topicforge.operators import tfidf as tf


def _docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def py_tfidf(docs, min_df, max_df, max_features):
    toks = [[w for w in d.split() if len(w) > 1] for d in docs]
    toks = [t for t in toks if t]
    n = len(toks)
    df = Counter(w for t in toks for w in set(t))
    tot = Counter(w for t in toks for w in t)
    elig = [w for w in df if min_df <= df[w] <= max_df * n]
    elig.sort(key=lambda w: (-tot[w], w))
    vocab = sorted(elig[:max_features])
    idf = {w: math.log((1 + n) / (1 + df[w])) + 1 for w in vocab}
    rows = []
    for t in toks:
        c = Counter(w for w in t if w in idf)
        w = {k: v * idf[k] for k, v in c.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        rows.append({k: v / norm for k, v in w.items()} if norm else {})
    return vocab, rows


def test_vocabulary_edges_and_weights(spark):
    # "aa" in all 10 docs (> 0.8 n): pruned; "bb" in exactly 8 (= 0.8 n): kept;
    # "cc" in exactly 5 (= min_df): kept; "dd" in 4: pruned; "ee"/"ff" tie.
    texts = []
    for i in range(10):
        w = ["aa"]
        if i < 8: w.append("bb")
        if i < 5: w += ["cc", "cc"]
        if i < 4: w.append("dd")
        if i < 6: w += ["ee", "ff"]
        if i == 9: w = ["zz"] * 3  # no vocabulary term: zero row
        texts.append(" ".join(w))
    docs = _docs(spark, texts)
    toks = tf.document_tokens(docs)
    model, weights = tf.fit_tfidf(toks, tf.VocabParams(5, 0.8, 3))
    vocab = [r.term for r in model.vocabulary.orderBy("idx").collect()]
    want_vocab, want_rows = py_tfidf(texts, 5, 0.8, 3)
    assert vocab == want_vocab == ["bb", "cc", "ee"]   # ee beats ff on the term tie-break
    got = {}
    for r in weights.collect():
        got.setdefault(r.doc_id, {})[r.term] = r.weight
    for i, row in enumerate(want_rows):
        assert got.get(i, {}) == pytest.approx(row)


def test_transform_unseen(spark):
    docs = _docs(spark, ["aa bb", "aa cc", "bb cc", "aa bb cc"])
    model, _ = tf.fit_tfidf(tf.document_tokens(docs), tf.VocabParams(1, 1.0, None))
    new = tf.document_tokens(_docs(spark, ["aa qq", "qq"]))
    out = model.transform(new).collect()
    assert [(r.doc_id, r.term, r.weight) for r in out] == [(0, "aa", 1.0)]


def test_lsa_matches_exact_svd(spark):
    rng = np.random.default_rng(0)
    n_docs, n_terms, k = 60, 40, 5
    a = rng.random((n_docs, n_terms)) * (rng.random((n_docs, n_terms)) < 0.3)
    a[:, :3] += rng.random((n_docs, 1)) * 3  # a few strong directions
    a[7] = 0.0                                # an empty document
    rows = [(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))]
    weights = spark.createDataFrame(rows, "doc_id long, idx int, weight double")
    model = lsa.fit_lsa(weights, n_terms, n_docs, k, seed=42, n_iter=8)
    sv = np.linalg.svd(a, compute_uv=False)[:k]
    assert model.singular_values == pytest.approx(sv, rel=1e-6)
    # projection spans the same space: A V V^T equals the rank-k part of A
    # (up to the subspace accuracy the spectral gap of random data allows)
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    ak = (u[:, :k] * s[:k]) @ vt[:k]
    assert a @ model.components @ model.components.T == pytest.approx(ak, abs=2e-3)
    docs = spark.range(n_docs).select(F.col("id").alias("doc_id"))
    feats = {r.doc_id: np.array(r.features) for r in lsa.project(weights, docs, model).collect()}
    assert len(feats) == n_docs
    assert np.allclose(feats[7], 0.0)
    norms = [np.linalg.norm(v) for i, v in feats.items() if i != 7]
    assert norms == pytest.approx([1.0] * (n_docs - 1))


def test_lsa_save_load_and_processed_reread(spark, tmp_path):
    from topicforge.sources.tables import read_processed, write_table
    rng = np.random.default_rng(1)
    a = rng.random((12, 6))
    rows = [(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))]
    w = spark.createDataFrame(rows, "doc_id long, idx int, weight double")
    m = lsa.fit_lsa(w, 6, 12, 3)
    lsa.save_lsa(spark, m, str(tmp_path / "lsa"))
    back = lsa.load_lsa(spark, str(tmp_path / "lsa"))
    assert np.allclose(back.components, m.components) and np.allclose(back.singular_values, m.singular_values)
    proc = spark.createDataFrame([(1, "a b"), (2, "  "), (3, None)], "doc_id long, processed_content string")
    write_table(proc, str(tmp_path / "proc"))
    assert [r.doc_id for r in read_processed(spark, str(tmp_path / "proc")).collect()] == [1]


def test_kmeans_load_or_train(spark, tmp_path):
    from topicforge.operators import kmeans as km
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, [float(x) for x in rng.random(3)]) for i in range(30)],
                               "doc_id long, features array<double>")
    m1, loaded1 = km.load_or_train(df, 3, str(tmp_path))
    m2, loaded2 = km.load_or_train(df, 3, str(tmp_path))
    assert (loaded1, loaded2) == (False, True)
    assert np.allclose(np.array(m1.clusterCenters()), np.array(m2.clusterCenters()))
    other = df.withColumn("features", F.transform("features", lambda x: x * 2))
    _, loaded3 = km.load_or_train(other, 3, str(tmp_path))
    assert loaded3 is False          # features changed: the stored model is not reused
    assert km.model_summary(m1) == {"n_centroids": 3, "dims": 3}


def test_model_tables_without_arrow(spark):
    """Driver-side model tables must build in sessions with Arrow off."""
    m = lsa.LsaModel(np.arange(6, dtype=float).reshape(3, 2), np.array([2.0, 1.0]), 3)
    old = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        rows = lsa.components_table(spark, m).orderBy("idx").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", old)
    assert [r.loading for r in rows] == [[0.0, 1.0], [2.0, 3.0], [4.0, 5.0]]


def test_explained_variance_matches_projection(spark):
    rng = np.random.default_rng(3)
    n_docs, n_terms = 40, 12
    a = rng.random((n_docs, n_terms)) * (rng.random((n_docs, n_terms)) < 0.5)
    a[5] = 0.0
    rows = [(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))]
    w = spark.createDataFrame(rows, "doc_id long, idx int, weight double")
    docs = spark.range(n_docs).select(F.col("id").alias("doc_id"))
    m = lsa.fit_lsa(w, n_terms, n_docs, 4, n_iter=8)
    got = lsa.explained_variance(w, docs, m).orderBy("component").collect()
    proj = a @ m.components
    want = proj.var(axis=0)
    assert [r.explained_variance for r in got] == pytest.approx(want, rel=1e-9, abs=1e-12)
    assert [r.explained_variance_ratio for r in got] == pytest.approx(want / a.var(axis=0).sum(), rel=1e-9)


def test_gram_passes_send_less_than_the_matrix(spark):
    """The tasks of a pass follow the non-zeros, not the splits."""
    rows = [(i, [j % 40 for j in range(i % 7, i % 7 + 6)], [1.0] * 6) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, idxs array<int>, vals array<double>").repartition(16)
    assert lsa.gram_tasks(df, 40, 200) == 1
    assert lsa.gram_tasks(df, 40, 20) == 3
    assert lsa.gram_tasks(df, 2, 2) == spark.sparkContext.defaultParallelism
    assert lsa.gram_tasks(df.limit(0), 2, 2) == 1
    q = np.random.default_rng(0).normal(size=(40, 8))
    a = np.zeros((400, 40))
    for i, idxs, vals in rows:
        a[i, idxs] = vals
    for n in (1, 3):
        assert np.allclose(lsa._gram_pass(df, q, n), a.T @ (a @ q))
