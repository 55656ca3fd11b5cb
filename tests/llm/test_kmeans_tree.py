"""Best-bin-first search against brute force."""

import numpy as np
from pyspark.sql import functions as F

from topicforge.llm import kmeans_tree, queries


def brute(table, k=10):
    """query -> [(id, distance)], over (id, vector) rows."""
    ids = np.array([i for i, _ in table])
    x = np.array([v for _, v in table], float)
    out = {}
    for i, v in table:
        if i % 100 == 0:
            d = np.sqrt(((x - np.asarray(v, float)) ** 2).sum(1))
            out[i] = sorted({(float(s), int(j)) for s, j in zip(d, ids) if j != i})[:k]
    return out


def check(rows, table, least):
    want, got = brute(table), {}
    for r in rows:
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert got.keys() == want.keys()
    hit = total = 0
    vectors = {}
    for i, v in table:
        vectors.setdefault(i, []).append(np.asarray(v, float))
    for q, best in want.items():
        answer = sorted(got[q])
        assert [a for a, _, _ in answer] == list(range(1, len(best) + 1))
        assert [(s, v) for _, s, v in answer] == sorted((s, v) for _, s, v in answer)
        assert len({v for _, _, v in answer}) == len(answer) and q not in {v for _, _, v in answer}
        for _, s, v in answer:
            assert any(abs(np.sqrt(((a - b) ** 2).sum()) - s) < 1e-12 for a in vectors[q] for b in vectors[v])
        hit += len({v for _, _, v in answer} & {v for _, v in best})
        total += len(best)
    assert hit >= least * total


def test_query_recall(spark):
    path = "/root/testdata/sf0.1"
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    check(queries.op4_best_bin_first(spark, path).collect(), table, 0.9)


def test_large_group_of_equal_vectors_and_small_leaves(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF", 32)
    monkeypatch.setattr(kmeans_tree, "PART", 16)
    r = np.random.default_rng(2)
    table = [(i, r.normal(size=8).astype(np.float32).tolist()) for i in range(900)]
    same = r.normal(size=8).astype(np.float32).tolist()
    table += [(900 + i, same) for i in range(400)]
    frame = spark.createDataFrame(table, "vec_id bigint, embedding array<float>")
    check(kmeans_tree.search(frame, F.col("vec_id") % 100 == 0).collect(), table, 0.9)


def test_edge_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (100, None, 1), (200, [0.0, 0.0], 1), (300, [float("nan"), 1.0], 1),
            (400, [None, 1.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (500, [1.0, 2.0, 3.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int")
    got = [tuple(r) for r in kmeans_tree.search(frame, F.col("vec_id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 0.0), (0, 2, 1, 2 ** 0.5)]
    assert kmeans_tree.search(frame.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_each_dimension_and_every_size_takes_part(spark):
    r = np.random.default_rng(5)
    table = [(i, r.normal(size=4).tolist()) for i in range(1, 301)]              # queries 100, 200, 300
    other = [(100 * i, r.normal(size=3).tolist()) for i in range(4, 12)]         # all rows ask
    frame = spark.createDataFrame(table + other, "vec_id bigint, embedding array<double>")
    got = kmeans_tree.search(frame, F.col("vec_id") % 100 == 0).collect()
    check([x for x in got if x.query_id < 400], table, 1.0)
    check([x for x in got if x.query_id >= 400], other, 1.0)
    odd = [(100, [1e200, 1e200]), (1, [3e200, 1e200]), (2, [1e200, -1e200]), (200, [1e-200, 0.0]), (3, [4e-200, 0.0])]
    frame = spark.createDataFrame(odd, "vec_id bigint, embedding array<double>")
    got = {(x.query_id, x.vec_id): x.score for x in kmeans_tree.search(frame, F.col("vec_id") % 100 == 0).collect()}
    assert len(got) == 8
    for pair, want in {(100, 1): 2e200, (100, 2): 2e200, (200, 3): 3e-200}.items():
        assert abs(got[pair] / want - 1) < 1e-12
