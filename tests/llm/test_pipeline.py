"""The pipeline, stage by stage."""

import pytest

import __spark_entry__ as E
from topicforge.llm import toxicity

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == set(before)
            break
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns and after.items() <= before.items()
        assert len(after) >= (0.7 if name == "near_dedup" else 0.85) * len(before)
        if name == "toxicity":
            assert len(after) < len(before)
        before = after
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_dedup", "packing"]


def test_run_and_registration(spark, small):
    assert E.queries()["pipeline"] is corpus_pipeline.run
    rows = corpus_pipeline.run(spark, small).collect()
    assert rows and rows[0].__fields__ == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_odd_documents_go_through(spark, small):
    rows = [(1, None, "en", "s", 0, "x"), (2, "", None, None, None, None), (None, "the and attion of the", "en", "s", 5, "x"),
            (3, "the and attion of the thing", "en", "s", 5, "x"), (3, "the and attion of the thing", "en", "s", 5, "x"),
            (4, "the and " * 60000, "en", "s", 5, "x")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")
    for data in (frame, frame.limit(0)):
        docs = data
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, small)
            if name != "packing":
                assert out.columns == frame.columns
                docs = spark.createDataFrame(out.collect(), frame.schema)
            else:
                out.count()
    assert toxicity.THRESHOLD == 0.7
