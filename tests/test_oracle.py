"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names, multiset of rows), and rows-only queries run."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck
from topicforge.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

# the optional queries have tests of their own
_ALL = catalog.registry()
_SQL = {k: v for k, v in E.oracle_sql().items() if k in _ALL}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(_SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, _ALL[name], _SQL[name], SF)
    assert res["cols_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res.get("values_match"), res


@pytest.fixture(scope="module")
def kept_docs(spark):
    return sorted(r.doc_id for r in _ALL["clean_text"](spark, SF).select("doc_id").collect())


def _rows(spark, name):
    return _ALL[name](spark, SF).collect()


def test_every_query_is_checked():
    assert set(_ALL) - set(_SQL) == {"lsa_spectrum", "lsa_vectors", "kmeans_labels", "labelled_docs", "kmeans_sizes",
                                     "topic_terms_lsa", "k_sweep", "best_k", "k_sweep_lsa", "best_k_lsa",
                                     "dbscan_lsa_labels", "dbscan_lsa_summary", "word_segments"}


def test_lsa_queries(spark, kept_docs):
    vectors = _rows(spark, "lsa_vectors")
    assert sorted(r.doc_id for r in vectors) == kept_docs
    assert all(abs(sum(x * x for x in r.features) - 1) < 1e-9 or not any(r.features) for r in vectors)
    spectrum = sorted(_rows(spark, "lsa_spectrum"))
    values = [r.singular_value for r in spectrum]
    assert [r.component for r in spectrum] == list(range(len(vectors[0].features)))
    assert values == sorted(values, reverse=True)
    assert 0 < sum(r.explained_variance_ratio for r in spectrum) <= 1 + 1e-4   # rounded values


def test_kmeans_queries(spark, kept_docs):
    labels = _rows(spark, "kmeans_labels")
    assert sorted(r.doc_id for r in labels) == kept_docs and {r.cluster for r in labels} <= set(range(34))
    sizes = {r.cluster: r.n_points for r in _rows(spark, "kmeans_sizes")}
    assert sizes == {c: sum(r.cluster == c for r in labels) for c in {r.cluster for r in labels}}
    by_id = {r.doc_id: r.cluster for r in labels}
    assert {r.doc_id: r.cluster for r in _rows(spark, "labelled_docs")} == by_id
    terms = _rows(spark, "topic_terms_lsa")
    assert all(sorted(r["rank"] for r in terms if r.cluster == c) == list(range(1, 16)) for c in {r.cluster for r in terms})


def test_word_segments(spark):
    plain = {r.doc_id: r.processed_content for r in _rows(spark, "clean_text")}
    cut = {r.doc_id: r.processed_content for r in _rows(spark, "word_segments")}
    kept = lambda text: [t for t in text.split(" ") if len(t) >= 2]
    assert {i: c.replace("_", " ").split(" ") for i, c in cut.items()} == {i: kept(t) for i, t in plain.items()}


def test_sweeps(spark):
    for sweep, best in (("k_sweep", "best_k"), ("k_sweep_lsa", "best_k_lsa")):
        rows = sorted(_rows(spark, sweep))
        assert [r.k for r in rows] == list(range(5, 51))
        assert rows[-1].inertia < rows[0].inertia and all(-1 <= r.silhouette <= 1 for r in rows)
        (top,) = _rows(spark, best)
        assert top.silhouette == max(r.silhouette for r in rows)


def test_dbscan_on_lsa(spark, kept_docs):
    labels = _rows(spark, "dbscan_lsa_labels")
    (summary,) = _rows(spark, "dbscan_lsa_summary")
    assert sorted(r.doc_id for r in labels) == kept_docs
    assert summary.n_noise == sum(r.cluster == -1 for r in labels)
    assert summary.n_clusters == len({r.cluster for r in labels} - {-1})


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["source", "rank", "term", "weight"]
