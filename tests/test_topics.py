"""Topic interpretation: group centroids, top-k with ties, back-projection."""

import numpy as np
import pytest

from topicforge.operators import topics as tp


def test_group_centroids_and_top_terms(spark):
    weights = spark.createDataFrame(
        [(1, 0, "an", 0.6), (1, 1, "ba", 0.8), (2, 0, "an", 1.0), (3, 2, "ca", 1.0)],
        "doc_id long, idx int, term string, weight double")
    # doc 4 has no vocabulary term: it still counts in its group's mean
    members = spark.createDataFrame([(1, "g"), (2, "g"), (3, "h"), (4, "h")], "doc_id long, cluster string")
    cents = {(r.cluster, r.term): r.weight for r in tp.group_centroids(weights, members).collect()}
    assert cents == pytest.approx({("g", "an"): 0.8, ("g", "ba"): 0.4, ("h", "ca"): 0.5})
    tied = spark.createDataFrame([("g", 0, "zz", 1.0), ("g", 1, "aa", 1.0), ("g", 2, "mm", 0.5)],
                                 "cluster string, idx int, term string, weight double")
    top = tp.top_terms(tied, 2).orderBy("rank").collect()
    assert [(r.rank, r.term, r.rel_weight) for r in top] == [(1, "aa", 1.0), (2, "zz", 1.0)]
    kw = tp.keyword_lists(tp.top_terms(tied, 3)).first()
    assert kw.keywords == "aa, zz, mm"


def test_back_project_matches_numpy(spark):
    rng = np.random.default_rng(5)
    comps = rng.normal(size=(7, 3))            # terms x dims
    centers = rng.normal(size=(4, 3))          # k x dims
    ctab = spark.createDataFrame([(i, [float(x) for x in comps[i]]) for i in range(7)],
                                 "idx int, loading array<double>")
    vocab = spark.createDataFrame([(f"t{i}", i) for i in range(7)], "term string, idx int")
    got = tp.back_project(ctab, centers, vocab).collect()
    want = centers @ comps.T
    assert len(got) == 28
    for r in got:
        assert r.weight == pytest.approx(want[r.cluster, r.idx])
        assert r.term == f"t{r.idx}"
    head = tp.vocabulary_head(vocab, 3).orderBy("rank").collect()
    assert [(r.rank, r.term) for r in head] == [(1, "t0"), (2, "t1"), (3, "t2")]
