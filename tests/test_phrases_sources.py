"""Phrase joining (T9b) vs a Python loop; article CSV and stopword sources."""

import os

import pytest
from pyspark.sql import functions as F

from topicforge.operators import phrases as phr
from topicforge.sources import articles as ar


def py_apply(tokens, pairs):
    out, i = [], 0
    while i < len(tokens):
        if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in pairs:
            out.append(tokens[i] + "_" + tokens[i + 1])
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return out


def test_apply_phrases_greedy(spark):
    docs = [["a", "b", "c", "d"], ["b", "c", "b", "c", "x"], ["a", "b", "a", "b", "c"], ["z"]]
    pairs = {("a", "b"), ("b", "c"), ("c", "d")}
    toks = spark.createDataFrame(list(enumerate(docs)), "doc_id long, tokens array<string>")
    ph = spark.createDataFrame(sorted(pairs), "a string, b string")
    got = dict((r.doc_id, r.tokens) for r in phr.apply_phrases(toks, ph).collect())
    assert [got[i] for i in range(len(docs))] == [py_apply(d, pairs) for d in docs]


def _write(path, text, bom=True):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        f.write(text)


def test_read_articles(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    _write(d / "a.csv", 'url,title,description,content\n'
           'u1,T1,D1,"line one\nline ""two"""\n'
           'u2,T2,,c2\n')
    _write(d / "b.csv", "url,title,content\nu3,T3,c3\n", bom=False)
    _write(d / "c.csv", "url,title,description\nu4,T4,D4\n")      # no content column: skipped
    _write(d / "notes.txt", "ignored")
    df = ar.read_articles(spark, str(d))
    rows = sorted((r.url, r.title, r.content) for r in df.collect())
    assert rows == [("u1", "T1", 'line one\nline "two"'), ("u2", "T2", "c2"), ("u3", "T3", "c3")]
    counts = {os.path.basename(r.source_file): r.n_rows for r in ar.source_counts(df).collect()}
    assert counts == {"a.csv": 2, "b.csv": 1}


def test_read_articles_empty_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ar.read_articles(spark, str(tmp_path))


def test_headers_of_any_length_and_order(spark, tmp_path):
    wide = ",".join(f"column_{i:06d}" for i in range(9_000))          # a header of 120 KB
    _write(tmp_path / "a.csv", f"content,title,url\nc1,T1,u1\n")
    _write(tmp_path / "b.csv", f' url , title ,"content"\r\nu2,T2,"x\n\ny"\r\nu3\r\n', bom=False)
    _write(tmp_path / "c.csv", f"{wide},url,title\n{',' * 9_001}\n")  # no content
    _write(tmp_path / "d.csv", "")
    _write(tmp_path / "e.csv", "url,title,content")                  # a header alone
    (tmp_path / "more").mkdir()
    _write(tmp_path / "more" / "f.csv", "url,title,content\nu9,T9,c9\n")   # not in the folder itself
    found = {os.path.basename(r.path): r.cols for r in ar.article_headers(spark, str(tmp_path)).collect()}
    assert found == {"a.csv": ["content", "title", "url"], "b.csv": ["url", "title", "content"],
                     "e.csv": ["url", "title", "content"]}
    rows = {(r.url, r.title, r.content) for r in ar.read_articles(spark, str(tmp_path), False).collect()}
    assert rows == {("u1", "T1", "c1"), ("u2", "T2", "x\n\ny"), ("u3", None, None)}
    _write(tmp_path / "c.csv", f"{wide},content,url,title\n{',' * 9_000}c4,u4,T4\n")
    assert "c.csv" in {os.path.basename(r.path) for r in ar.article_headers(spark, str(tmp_path)).collect()}


def test_stopwords(spark, tmp_path):
    p = tmp_path / "sw.txt"
    p.write_text("  và \nthì\n\n và\n", encoding="utf-8")
    assert ar.read_stopwords(spark, str(p)) == ["thì", "và"]
    assert ar.read_stopwords(spark, str(tmp_path / "missing.txt")) == []


def test_stopwords_after_phrases(spark):
    assert phr.phrase_stopwords(["bởi vì", " và ", ""]) == ["bởi_vì", "và"]
    toks = spark.createDataFrame([(1, ["bởi_vì", "trời", "và", "mưa", "x"])], "doc_id long, tokens array<string>")
    out = phr.drop_stopwords(toks, ["bởi vì", "và"]).first()
    assert out.tokens == ["trời", "mưa"]
