"""Plan-shape regressions: the optimisations the README claims stay in place."""

import re

from pyspark.sql import functions as F

from topicforge.functions import text as tx
from topicforge.operators import tfidf as tf
from topicforge.operators.common import dense_index
from topicforge.operators.phrases import PhraseParams, apply_phrases
from topicforge.sources.tables import spread


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _docs(spark):
    rows = [(i, f"Tin {i} https://x.vn/{i} bài số {i} về thể thao") for i in range(50)]
    return spread(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "doc_id")


def test_cleaning_chain_evaluated_once(spark):
    toks = tf.document_tokens(_docs(spark))
    plan = _plan(tf.term_counts(toks))
    # the http-link pattern is the first regex of the chain: exactly one copy
    assert plan.count("https?://") == 1, plan
    assert not re.search(r"Filter[^\n]*https\?://", plan)


def test_per_document_steps_need_no_shuffle(spark):
    rows = [(i, f"Tin {i} bài số {i} về thể thao") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)   # more splits than cores
    toks = tf.document_tokens(docs)
    vocab = spark.createDataFrame([("tin", 0, 1.0), ("thao", 1, 2.0)], "term string, idx int, idf double")
    for packed in (False, True):
        assert "hashpartitioning" not in _plan(tf.weigh(tf.count_terms(toks), vocab, packed))
    phrases = spark.createDataFrame([("tin", "bài")], "a string, b string")
    assert "hashpartitioning" not in _plan(apply_phrases(toks, phrases))


def test_small_and_large_tables_give_the_same(spark, monkeypatch):
    toks = tf.document_tokens(_docs(spark))
    model, counted = tf.fit_counted(toks, tf.VocabParams(min_df=1, max_df=1.0))
    by_key = lambda df: sorted((r.doc_id, r.idx, r.term, round(r.weight, 9)) for r in df.collect())
    packed = lambda df: sorted((r.doc_id, sorted(zip(r.idxs, [round(v, 9) for v in r.vals]))) for r in df.collect())
    sent = by_key(tf.weigh(counted, model.vocabulary)), packed(tf.weigh(counted, model.vocabulary, True))
    monkeypatch.setattr(tf, "BROADCAST_ROW_LIMIT", 1)
    assert sent == (by_key(tf.weigh(counted, model.vocabulary)), packed(tf.weigh(counted, model.vocabulary, True)))
    phrases = spark.createDataFrame([("tin", "bài"), ("bài", "số"), ("thể", "thao")], "a string, b string")
    joined = lambda n: sorted((r.doc_id, r.tokens) for r in
                              apply_phrases(toks, phrases, PhraseParams(broadcast_rows=n)).collect())
    assert joined(100) == joined(0)


def test_dense_index_numbers_every_row(spark):
    n = 1_200_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("k"))
    got = dense_index(rows, [F.asc("k")], "i").agg(F.count("*"), F.sum((F.col("i") == F.col("k")).cast("int")),
                                                   F.countDistinct("i")).first()
    assert tuple(got) == (n, n, n)
    few = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    assert sorted(map(tuple, dense_index(few, [F.asc("k")], "i").collect())) == \
        sorted(map(tuple, dense_index(few, [F.asc("k")], "i", bound=1000).collect())) == [(i, i) for i in range(1000)]


def test_nearest_centroid_is_one_projection(spark):
    from topicforge.operators import vectors as vx
    df = spark.createDataFrame([(0, [1.0, 0.0])], "id long, v array<double>")
    plan = _plan(vx.assign_nearest(df, "v", [[0.0, 0.0], [2.0, 0.0]]))
    assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan


def test_topic_terms_clean_once_and_join_no_documents(spark, small_tables):
    from topicforge.plans import catalog
    plan = _plan(catalog.registry()["topic_terms"](spark, small_tables))
    assert "https?://" not in plan               # the cleaning lies behind the written counts
    assert not re.search(r"(Join|hashpartitioning)[^\n]*doc_id", plan)
