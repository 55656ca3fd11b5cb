"""Bounds of the silhouette against the exact score and brute force."""

import numpy as np
import pytest

from topicforge.operators import silhouette as sil
from topicforge.operators import silhouette_bounds as sb


def _points(spark, x, lab, cell=None):
    cell = [None] * len(x) if cell is None else [int(c) for c in cell]
    rows = [(i, [float(v) for v in x[i]], int(lab[i]), cell[i]) for i in range(len(x))]
    return spark.createDataFrame(rows, "vec_id long, vec array<double>, cluster int, cell int")


def _exact(x, lab):
    """(a, b, s) of each point from all differences."""
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    for i in range(len(x)):
        own = lab == lab[i]
        b = min(d[i, lab == c].mean() for c in set(lab.tolist()) if c != lab[i])
        if own.sum() == 1:
            yield None, b, 0.0
        else:
            a = d[i, own].sum() / (own.sum() - 1)
            yield a, b, (b - a) / max(a, b) if max(a, b) > 0 else 0.0


def _both(points, **kw):
    rows = sorted(points.collect())
    x, lab = np.array([r.vec for r in rows]), np.array([r.cluster for r in rows])
    found = {r.vec_id: r for r in sb.silhouette_bounds(points, **kw).collect()}
    assert sorted(found) == [r.vec_id for r in rows]
    for r, (a, b, s) in zip(rows, _exact(x, lab)):
        f = found[r.vec_id]
        assert f.cluster == r.cluster
        assert f.s_low - 1e-9 <= s <= f.s_high + 1e-9
        assert f.b_low - 1e-9 <= b <= f.b_high + 1e-9
        if a is None:
            assert f.a_low is None and f.s_low == f.s_high == 0.0
        else:
            assert f.a_low - 1e-9 <= a <= f.a_high + 1e-9
    width = float(np.mean([f.s_high - f.s_low for f in found.values()]))
    return width, found


def _blobs(n, dims, k, spread, seed=0):
    rng = np.random.default_rng(seed)
    lab = rng.integers(0, k, n)
    lab[:k] = np.arange(k)
    return rng.normal(size=(k, dims))[lab] * 3 + rng.normal(size=(n, dims)) * spread, lab


@pytest.mark.parametrize("dims, spread, widest", [(1, 0.5, 0.6), (2, 0.5, 0.4), (16, 1.0, 0.15), (64, 1.0, 0.06)])
def test_every_point_lies_between_its_bounds(spark, dims, spread, widest):
    x, lab = _blobs(150, dims, 4, spread)
    width, _ = _both(_points(spark, x, lab))
    assert width < widest


def test_without_covariances_wider_but_right(spark):
    x, lab = _blobs(120, 8, 3, 1.0, seed=1)
    full, _ = _both(_points(spark, x, lab))
    plain, _ = _both(_points(spark, x, lab), covariance_cells=0)
    assert full < plain


def test_cells_narrow_the_interval(spark):
    x, lab = _blobs(160, 2, 3, 1.0, seed=2)
    width, _ = _both(_points(spark, x, lab))
    cell = np.floor(x[:, 0]) * 100 + np.floor(x[:, 1])
    narrow, _ = _both(_points(spark, x, lab, cell), cell_col="cell")
    assert narrow < width / 2
    one_each, _ = _both(_points(spark, x, lab, np.arange(len(x))), cell_col="cell")
    assert one_each < 1e-7


def test_single_points_repeats_and_far_from_zero(spark):
    x = np.array([[0.0, 0], [0, 0], [0, 0], [1, 0], [1, 0], [5, 5], [5, 5]]) + 1e6
    lab = np.array([0, 0, 0, 1, 1, 2, 3])       # equal points in one cluster, across two, and alone
    width, found = _both(_points(spark, x, lab))
    assert found[0].s_low == found[0].s_high == 1.0
    assert found[5].s_low == found[5].s_high == 0.0
    assert width < 1e-9


def test_score_holds_the_exact_score_by_cluster(spark):
    x, lab = _blobs(200, 32, 5, 2.0, seed=3)
    points = _points(spark, x, lab)
    exact = {r.cluster: r.silhouette for r in sil.per_cluster(sil.silhouette_samples(points.drop("cell"))).collect()}
    rows = sb.score_bounds(sb.silhouette_bounds(points), "cluster").collect()
    assert {r.cluster for r in rows} == set(exact)
    for r in rows:
        assert r.silhouette_low <= exact[r.cluster] <= r.silhouette_high
        assert r.n_points == int((lab == r.cluster).sum())


def test_one_cluster_or_only_single_points_raise(spark):
    x, _ = _blobs(6, 2, 2, 1.0)
    for lab in (np.zeros(6), np.arange(6)):
        with pytest.raises(ValueError):
            sb.silhouette_bounds(_points(spark, x, lab))


def test_no_points_raise(spark):
    with pytest.raises(ValueError):
        sb.silhouette_bounds(spark.createDataFrame([], "vec_id long, vec array<double>, cluster int"))


def test_no_pair_join_and_no_shuffle_of_points(spark):
    x, lab = _blobs(40, 3, 3, 1.0)
    plan = sb.silhouette_bounds(_points(spark, x, lab))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
