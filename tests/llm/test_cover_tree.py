"""Cover-tree links against all pairs by brute force."""

import numpy as np
import pytest

from topicforge.llm import cover_tree, queries


def brute(ids, vectors, threshold=0.95):
    """n_links and component of every row."""
    ok = [v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    x = np.array([v if o else [1.0] * 64 for v, o in zip(vectors, ok)], float)[:, :64] if len(vectors) else np.zeros((0, 1))
    norm = np.sqrt((x * x).sum(1))
    link = (x @ x.T) / np.outer(norm, norm) >= threshold
    link &= np.outer(ok, ok)
    np.fill_diagonal(link, False)
    component = np.array(ids)
    while True:
        new = np.array([min([component[i], *component[link[i]]]) for i in range(len(ids))])
        if (new == component).all():
            return link.sum(1), component
        component = new


def compare(rows, ids, vectors):
    links, component = brute(ids, vectors)
    assert {r[0]: (r[1], r[2], r[3]) for r in rows} == {
        i: (int(n), int(c), i == c) for i, n, c in zip(ids, links, component)}


def made(seed, n=600, d=64):
    """Loose points, tight groups, chains around the threshold, equal rows."""
    r = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v)
    out = [r.normal(size=d) for _ in range(n // 3)]
    for spread in (0.02, 0.03, 0.045, 0.06):
        centre = unit(r.normal(size=d))
        out += [centre + spread * r.normal(size=d) for _ in range(n // 8)]
    out += [out[0]] * 20 + [2 * out[1]] * 3
    walk = unit(r.normal(size=d))
    for _ in range(30):
        walk = unit(walk + 0.035 * r.normal(size=d))
        out.append(walk)
    return [v.astype(np.float32).astype(float).tolist() for v in out]


@pytest.mark.parametrize("block,pivots", [(4096, 1024), (64, 1024), (64, 1)])
def test_against_all_pairs(spark, monkeypatch, block, pivots):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    monkeypatch.setattr(cover_tree, "MOST_PIVOTS", pivots)
    vectors = made(3)
    ids = list(range(7, 7 + len(vectors)))
    frame = spark.createDataFrame(list(zip(ids, vectors)), "vec_id bigint, embedding array<double>")
    compare(cover_tree.link_near(frame).collect(), ids, vectors)


def test_edge_rows(spark):
    a = [1.0] + [0.0] * 63
    rows = [(1, a, 5), (2, a, 5), (3, None, 5), (4, [0.0] * 64, 5), (5, [None] + a[1:], 5), (6, [float("nan")] + a[1:], 5),
            (7, [float("inf")] + a[1:], 5), (8, [2 * x for x in a], 5), (9, [1.0, 2.0], 5), (None, a, 5), (1, a, 5), (10, [], 5)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n_links int")
    got = sorted(cover_tree.link_near(frame).collect(), key=lambda r: (r[0] or 0, r[2] or 0))
    assert [tuple(r) for r in got] == [
        (None, 0, None, False), (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), *((i, 0, i, True) for i in (3, 4, 5, 6, 7)),
        (8, 3, 1, False), (9, 0, 9, True), (10, 0, 10, True)]
    assert cover_tree.link_near(frame.limit(0)).count() == 0


def test_query(spark, small):
    rows = queries.op6_cover_tree(spark, small).collect()
    table = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    compare(rows, [r.vec_id for r in table], [r.embedding for r in table])


def test_each_dimension_and_every_size_takes_part(spark):
    rows = [(1, [1.0, 0.0, 0.0, 0.0]), (2, [1.0, 0.01, 0.0, 0.0]), (3, [0.0, 0.0, 1.0, 0.0]), (100, [1.0, 2.0]), (101, [1.0, 2.0001]),
            (102, [2.0, -1.0]), (200, [1e-200, 0.0, 0.0, 0.0]), (201, [2e-200, 0.0, 0.0, 0.0]), (300, [1e200, 0.0, 0.0, 1e200]),
            (301, [2e200, 0.0, 0.0, 2e200]), (302, [5e-324, 0.0, 0.0, 5e-324]), (400, [3.0]), (401, [-3.0]), (402, [1e308])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.link_near(frame).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 200: (3, 1), 201: (3, 1), 3: (0, 3), 100: (1, 100), 101: (1, 100), 102: (0, 102),
                   300: (2, 300), 301: (2, 300), 302: (2, 300), 400: (1, 400), 401: (0, 401), 402: (1, 400)}
