"""Vectors: nearest centroid, silhouette, DBSCAN, components, K-Means,
checked against brute-force numpy/Python statements of the semantics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicforge.operators import dbscan as db
from topicforge.operators import silhouette as sil
from topicforge.operators import vectors as vx
from topicforge.operators.components import connected_components


def brute_dbscan(x, eps, min_samples):
    """Index-order DBSCAN: clusters numbered by discovery from the lowest
    core index; a border point keeps the first cluster that reaches it."""
    n = len(x)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    nb = [np.flatnonzero(d[i] <= eps) for i in range(n)]
    core = np.array([len(v) >= min_samples for v in nb])
    lab = np.full(n, -1)
    c = 0
    for i in range(n):
        if not core[i] or lab[i] != -1:
            continue
        stack = [i]
        lab[i] = c
        while stack:
            j = stack.pop()
            for k in nb[j]:
                if lab[k] == -1:
                    lab[k] = c
                    if core[k]:
                        stack.append(k)
        c += 1
    return lab


def brute_silhouette(x, lab):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(s))


def _points(spark, x, lab=None):
    rows = [(i, [float(v) for v in x[i]], int(lab[i]) if lab is not None else 0) for i in range(len(x))]
    return spark.createDataFrame(rows, "vec_id long, vec array<double>, cluster int")


def _blobs(seed=0, n=90):
    rng = np.random.default_rng(seed)
    centers = np.array([[0, 0], [3, 0], [0, 3]])
    x = np.concatenate([c + rng.normal(scale=0.5, size=(n // 3, 2)) for c in centers])
    noise = rng.uniform(-2, 5, size=(10, 2))
    return np.concatenate([x, noise])


@pytest.mark.parametrize("block_rows", [1000, 17])
def test_dbscan_matches_brute_force(spark, block_rows):
    x = _blobs()
    for eps, ms in [(0.4, 5), (0.6, 4), (0.05, 2)]:
        want = brute_dbscan(x, eps, ms)
        got = db.dbscan(_points(spark, x).drop("cluster"), eps, ms, block_rows=block_rows)
        got = dict((r.vec_id, r.cluster) for r in got.collect())
        assert [got[i] for i in range(len(x))] == list(want), (eps, ms)


def test_dbscan_exact_min_samples_and_all_noise(spark):
    x = np.array([[0.0, 0], [0.1, 0], [0.2, 0], [5, 5], [9, 9]])
    got = db.dbscan(_points(spark, x).drop("cluster"), 0.25, 3).orderBy("vec_id").collect()
    assert [r.cluster for r in got] == list(brute_dbscan(x, 0.25, 3))
    got = db.dbscan(_points(spark, x).drop("cluster"), 0.01, 2).collect()
    assert {r.cluster for r in got} == {-1}


def _clustered(n, k, dims, seed):
    rng = np.random.default_rng(seed)
    centers = rng.uniform(-20, 20, size=(k, dims))
    return centers[np.arange(n) % k] + rng.normal(scale=0.3, size=(n, dims))


def test_dbscan_cells_skip_far_pairs(spark):
    from topicforge.operators.cells import place
    x = _clustered(1200, 12, 3, 5)
    got = db.dbscan(_points(spark, x).drop("cluster"), 0.4, 5, block_rows=40)
    got = dict((r.vec_id, r.cluster) for r in got.collect())
    assert [got[i] for i in range(len(x))] == list(brute_dbscan(x, 0.4, 5))
    pts = _points(spark, x).select(F.col("vec_id").alias("pid"), "vec")
    half = len(x) * (len(x) - 1) // 2
    cells = place(pts, 0.4, 40)
    assert cells.compared_pairs() < half / 5
    assert cells.pairs(cells.placed).count() == cells.shuffled_rows() < len(x) * 30 / 5
    # nothing to skip: every pair meets exactly once
    wide = place(pts, 1e3, 40)
    assert wide.compared_pairs() == half
    met = wide.pairs(wide.placed.select("pid", "cell", "visits")).groupBy("bi", "bj", "blk").count().collect()
    sides = {}
    for r in met:
        sides.setdefault((r.bi, r.bj), []).append(r["count"])
    assert half == sum(v[0] * (v[0] - 1) // 2 if bi == bj else v[0] * v[1] if len(v) == 2 else 0
                       for (bi, bj), v in sides.items())


def test_dbscan_cells_lose_no_close_pair(spark):
    from topicforge.operators.cells import place
    x = np.concatenate([_clustered(300, 6, 2, 7), np.random.default_rng(8).uniform(-20, 20, (200, 2))])
    cells = place(_points(spark, x).select(F.col("vec_id").alias("pid"), "vec"), 1.5, 25)
    met = set()
    at = cells.pairs(cells.placed.select("pid", "cell", "visits")).toPandas()
    for (bi, bj), rows in at.groupby(["bi", "bj"]):
        left, right = rows[rows.blk == bi].pid, rows[rows.blk == bj].pid
        new = {(min(a, b), max(a, b)) for a in left for b in right if a != b}
        assert not met & new                     # a pair meets once
        met |= new
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    close = {(int(i), int(j)) for i, j in zip(*np.nonzero(d <= 1.5)) if i < j}
    assert close <= met and len(met) < len(x) * (len(x) - 1) // 4


def test_dbscan_copies_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 1.0]) for i in range(50)] + [(60, [1.1, 1.0]), (61, [9.0, 9.0]), (62, [9.0, 9.0]),
            (70, None), (71, [nan, 1.0]), (72, [inf, 1.0]), (73, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    got = {r.vec_id: (r.cluster, r.is_core) for r in db.dbscan(df, 0.2, 3, block_rows=8).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == (0, True) for i in [*range(50), 60])
    assert all(got[i] == (-1, False) for i in (61, 62, 70, 71, 72, 73))
    assert db.dbscan(df.limit(0), 0.2, 3).collect() == []


@pytest.mark.parametrize("block_rows", [1000, 23])
def test_silhouette_matches_brute_force(spark, block_rows):
    x = _blobs(1)
    lab = np.array([0] * 30 + [1] * 30 + [2] * 30 + [3] * 9 + [4])  # includes a singleton
    got = sil.silhouette_score(_points(spark, x, lab), block_rows=block_rows).first()
    assert got.n_points == len(x)
    assert got.silhouette == pytest.approx(brute_silhouette(x, lab), abs=1e-9)


def test_silhouette_sums_leave_a_task_once(spark):
    """One row for each point and cluster, however many blocks there are."""
    from topicforge.operators import pairs as pr
    x = _blobs(1)
    pts = _points(spark, x, np.arange(len(x)) % 3).withColumnRenamed("vec_id", "pid")
    for nb in (1, 9, 2 * pr.RIGHT_BLOCKS):
        sums = pr.meet(pr.blocks(pts, "pid", nb), nb, sil._cluster_sums, sil._SUMS_SCHEMA).toPandas()
        assert len(sums) <= len(x) * 3 * -(-nb // pr.RIGHT_BLOCKS)
        d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
        got = sums.groupby(["pid", "other"]).dsum.sum()
        for i in range(len(x)):
            for c in range(3):
                assert got[i, c] == pytest.approx(d[i, c::3].sum(), abs=1e-6)


def test_silhouette_refuses_null_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 0), (1, None, 1), (2, [3.0, 4.0], 1)],
                               "vec_id long, vec array<double>, cluster int")
    with pytest.raises(Exception, match="null or of several dimensions"):
        sil.silhouette_score(df).collect()


def test_lloyd_pass_matches_brute_force(spark):
    """Counts, costs and sums of two models over more rows than one slice."""
    from topicforge.operators import evaluate as ev
    x = np.random.default_rng(11).normal(size=(2 * ev._ROWS + 37, 5))
    models = [(0, x[:4].copy()), (3, x[4:11].copy())]
    got = ev._pass(_points(spark, x).select("vec").coalesce(2), models)
    for m, c in models:
        d = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        lab = d.argmin(1)
        for j in range(len(c)):
            n, cost, total = got[m, j]
            assert n == (lab == j).sum()
            assert cost == pytest.approx(d[lab == j, j].sum(), abs=1e-9)
            assert total == pytest.approx(x[lab == j].sum(0), abs=1e-9)


def test_silhouette_one_cluster_raises(spark):
    x = _blobs(2)
    with pytest.raises(ValueError):
        sil.silhouette_score(_points(spark, x, np.zeros(len(x), dtype=int)))


def test_nearest_centroid_ties_lowest(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, [2.0, 0.0])], "id long, v array<double>")
    centers = [[0.0, 0.0], [2.0, 0.0]]
    out = vx.assign_nearest(df, "v", centers).orderBy("id").collect()
    assert [r.cluster for r in out] == [0, 0, 1]
    assert [r.dist2 for r in out] == [1.0, 0.0, 0.0]


def test_components_chain(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 19)] + [(25, 30), (30, 35)], "src long, dst long")
    verts = spark.range(n).select(F.col("id"))
    comp = dict((r.id, r.comp) for r in connected_components(verts, edges).collect())
    assert all(comp[i] == 0 for i in range(20))
    assert comp[35] == 25 and comp[30] == 25 and comp[39] == 39


def test_kmeans_invariants(spark):
    from topicforge.operators import kmeans as km
    x = _blobs(3)
    df = _points(spark, x).select(F.col("vec_id").alias("doc_id"), F.col("vec").alias("features"))
    model = km.fit_kmeans(df, 3, "features", seed=42)
    centers = np.array(model.clusterCenters())
    labels = km.predict(model, df, "features").orderBy("doc_id").collect()
    d2 = ((x[:, None, :] - centers[None]) ** 2).sum(-1)
    assert [r.cluster for r in labels] == list(d2.argmin(1))
    assert model.summary.trainingCost == pytest.approx(d2.min(1).sum(), rel=1e-9)
    with pytest.raises(ValueError):
        km.fit_kmeans(df, len(x) + 1, "features")


def test_k_sweep_against_brute_force(spark):
    from topicforge.operators import evaluate as ev
    x = _blobs(4)
    pts = _points(spark, x).drop("cluster")
    starts = {k: [ev.spread_centers(x, k, s) for s in (1, 2)] for k in (2, 3, 4)}
    sweep = ev.k_sweep(pts, 2, 4, 1, id_col="vec_id", vec_col="vec", block_rows=37,
                       starts=starts).orderBy("k").collect()
    assert [r.k for r in sweep] == [2, 3, 4]

    def settled(c):
        while True:
            d = ((x[:, None, :] - c[None]) ** 2).sum(-1)
            lab = d.argmin(1)
            new = np.array([x[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(len(c))])
            if np.allclose(new, c, atol=1e-12):
                return d.min(1).sum(), lab
            c = new

    for r in sweep:
        inertia, lab = min((settled(c) for c in starts[r.k]), key=lambda f: f[0])
        assert r.inertia == pytest.approx(inertia, rel=1e-3)   # the sweep stops at its tolerance
        assert r.silhouette == pytest.approx(brute_silhouette(x, lab), abs=2e-2)
    seeded = ev.k_sweep(pts, 2, 4, 1, n_init=3, id_col="vec_id", vec_col="vec").collect()
    assert all(s.inertia <= 1.5 * r.inertia for s, r in zip(sorted(seeded), sweep))
    with pytest.raises(ValueError):
        ev.k_sweep(pts, 2, len(x) + 1, 1, id_col="vec_id", vec_col="vec")


def test_equal_points_and_empty_weights(spark):
    same = _points(spark, np.ones((6, 3)), np.array([0, 0, 0, 1, 1, 1]))
    assert sil.silhouette_score(same).first().silhouette == 0.0
    from topicforge.operators import topics as tp
    zero = spark.createDataFrame([(0, 0, "a", 0.0), (0, 1, "b", 0.0)], "cluster int, idx int, term string, weight double")
    assert [(r.term, r.rel_weight) for r in tp.top_terms(zero, 2).orderBy("rank").collect()] == [("a", None), ("b", None)]


def test_best_k(spark):
    from topicforge.operators import evaluate as ev
    sweep = spark.createDataFrame([(2, 9.0, 0.3), (3, 8.0, 0.5), (4, 7.0, 0.5)],
                                  "k int, inertia double, silhouette double")
    assert tuple(ev.best_k(sweep).first()) == (3, 8.0, 0.5)


def test_sampled_silhouette_paths(spark):
    from topicforge.operators import evaluate as ev
    x = _blobs(6)
    lab = np.array([0] * 30 + [1] * 30 + [2] * 40)
    pts = _points(spark, x, lab)
    sample = sil.sample_points(pts, "vec_id", 40, seed=42)
    ids = sorted(r.vec_id for r in sample.collect())
    assert len(ids) == 40 and ids == sorted(r.vec_id for r in sil.sample_points(pts, "vec_id", 40).collect())
    got = sil.silhouette_score(sample).first().silhouette
    assert got == pytest.approx(brute_silhouette(x[ids], lab[ids]), abs=1e-9)
    sw = ev.k_sweep(pts.drop("cluster"), 3, 3, 1, n_init=1, id_col="vec_id", vec_col="vec",
                    silhouette_sample=40).first()
    assert -1.0 <= sw.silhouette <= 1.0 and sw.k == 3


def test_dbscan_passes_shuffle_no_vector_twice(spark):
    from topicforge.operators.cells import place
    x = np.random.default_rng(3).normal(size=(600, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)                     # no cell can be skipped
    cells = place(_points(spark, x).select(F.col("vec_id").alias("pid"), "vec", F.lit(1).alias("n")), 0.8, 20)
    packed = db._packed(cells, cells.placed)
    passes = [(db._neighbour_counts, "pid long, cnt long"), (db._local_forest, "src long, dst long")]
    for task, schema in passes:
        out = db._meet(packed, 0.8, task, schema)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "Exchange" not in plan
        assert out.count() <= 2 * len(x) * db.LEAST_RUNS              # 30 blocks: was a row a point and pair
    got = dict((r.vec_id, r.cluster) for r in db.dbscan(_points(spark, x).drop("cluster"), 0.8, 4, block_rows=20).collect())
    assert [got[i] for i in range(len(x))] == list(brute_dbscan(x, 0.8, 4))


def test_models_worked_on_alone_move_as_in_passes(spark, monkeypatch):
    """Duplicate points, empty centroids, ties, a limit of steps and one of shifts."""
    from topicforge.operators import evaluate as ev
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.standard_normal((300, 6)), rng.standard_normal((200, 6)) * 0.1 + 3, np.zeros((20, 6)), np.ones((20, 6))])
    pts = spark.createDataFrame([(v.tolist(),) for v in x], "vec array<double>").repartition(3).checkpoint()
    starts = [x[:k].copy() for k in (1, 2, 5, 9, 20)] + [np.array([[0.0] * 6, [0.0] * 6, [50.0] * 6])]
    for steps, tol in ((0, 0.0), (1, 0.0), (3, 0.0), (300, 0.0), (300, 0.05)):
        alone = ev.lloyd(pts, starts, steps, tol)
        monkeypatch.setattr(ev, "LOCAL_BYTES", 0)
        passes = ev.lloyd(pts, starts, steps, tol)
        monkeypatch.undo()
        for (a, i), (b, j) in zip(alone, passes):
            assert np.allclose(a, b, rtol=0, atol=1e-12) and i == pytest.approx(j, rel=1e-12)


def test_sweep_of_small_points_is_not_a_job_per_step(spark, monkeypatch):
    from topicforge.operators import evaluate as ev
    monkeypatch.setattr(ev, "_pass", lambda *a: pytest.fail("one pass a step"))
    rng = np.random.default_rng(3)
    pts = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((60, 4)))], "doc_id long, features array<double>")
    rows = ev.k_sweep(pts, 2, 5).orderBy("k").collect()
    assert [r.k for r in rows] == [2, 3, 4, 5] and all(r.inertia > s.inertia for r, s in zip(rows, rows[1:]))
