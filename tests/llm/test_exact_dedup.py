"""Exact duplicates against a dictionary of normalised texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from topicforge.llm import exact_dedup, queries


def brute(rows):
    """Sorted ``(id, keep_id, size, kept, sha)``; rows are ``(id, text)``."""
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", text or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), n == 0, sha) for n, i in enumerate(ids)]
    return sorted(out, key=str)


def made():
    r = random.Random(4)
    texts = ["", None, " ", "\t\n", "a b", "a  b", "a\tb", "a b", "a\x1cb", "ab", "A b", "x" * 300_000, "x" * 300_000 + " "]
    texts += [" ".join(r.choices("ab", k=r.randrange(1, 6))).replace(" ", r.choice([" ", "\r\n", "\x0b "])) for _ in range(200)]
    rows = list(zip(r.sample(range(1000), len(texts)), texts))
    return rows + [rows[4], rows[4], (None, "a b"), (None, "only here"), (None, "only here")]


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("most", [exact_dedup.BROADCAST_HASHES, 0])
def test_groups(spark, most):
    rows = made()
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, keep_id string")
    assert result(exact_dedup.exact_groups(frame.repartition(7), broadcast_hashes=most)) == brute(rows)
    assert exact_dedup.exact_groups(frame.limit(0)).count() == 0


@pytest.mark.parametrize("most", [exact_dedup.BROADCAST_HASHES, 0])
def test_colliding_hashes_are_told_apart_by_bytes(spark, most):
    rows = made()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    weak = lambda text: F.length(text).cast("string").cast("binary")
    assert result(exact_dedup.exact_groups(frame, hash_of=weak, broadcast_hashes=most)) == brute(rows)


def test_keep_one_keeps_rows_with_clashing_columns(spark):
    rows = [(2, "a b", "p"), (1, "a  b", "q"), (1, "a  b", "q"), (3, None, None), (4, "", "r"), (None, "z", "s"), (None, "z", "s")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, _kept_id string").withColumn("_hash", F.lit(1)).withColumn("d", F.lit(2))
    got = exact_dedup.keep_one(frame)
    assert got.columns == frame.columns
    assert result(got) == sorted([(1, "a  b", "q", 1, 2), (3, None, None, 1, 2), (None, "z", "s", 1, 2)], key=str)


def test_copies_collapse_before_they_move(spark):
    frame = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(
        F.col("id").cast("string")).alias("text"))
    got = exact_dedup.exact_groups(frame).groupBy("group_size").agg(F.count("*"), F.sum(F.col("kept").cast("int"))).collect()
    assert sorted(map(tuple, got)) == [(1, 1333, 1333), (667, 667, 1)]


def test_query(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert result(queries.op11_content_hash(spark, small)) == brute(rows)
