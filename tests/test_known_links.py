"""The bucketed table of stored links."""

import re

from topicforge.operators import ingest as ig
from topicforge.sources.known_links import KnownLinks


def _links(spark, n, first=0):
    rows = [(i, "big" if i % 3 else "small", "" if i % 2 else "news", f"https://a/{i % 50}") for i in range(first, n)]
    return spark.createDataFrame(rows, "page_id long, site_key string, category string, link string")


def test_excludes_like_the_store_over_several_appends(spark, tmp_path):
    links, seen = _links(spark, 200), []
    for first in (0, 30, 30):
        old = _links(spark, first + 20, first)
        KnownLinks(spark, str(tmp_path / "k"), 4).append(old)
        seen.append(old)
    stored = seen[0].union(seen[1]).withColumnRenamed("link", "url")
    want = sorted(ig.exclude_known(links, stored).select(*links.columns).collect())
    known = KnownLinks(spark, str(tmp_path / "k"), 99)
    assert known.buckets == 4
    assert known.exclude(links).columns == links.columns
    assert 0 < len(want) < 200 and sorted(known.exclude(links).collect()) == want


def test_empty_table_nulls_and_repeats(spark, tmp_path):
    known = KnownLinks(spark, str(tmp_path / "k"), 4)
    rows = [(1, "s", None, "x"), (2, None, None, None), (3, "s", "c", "x"), (3, "s", "c", "x"), (4, "s", "c", "y")]
    links = spark.createDataFrame(rows, "page_id long, site_key string, category string, link string")
    assert known.exclude(links).count() == 5
    known.append(links.where("page_id < 4"))
    assert sorted(r.page_id for r in known.exclude(links).collect()) == [1, 2, 4]
    known.append(links.limit(0))
    assert known.table().count() == 1


def test_a_new_session_finds_the_table_under_its_path(spark, tmp_path):
    known = KnownLinks(spark, str(tmp_path / "k"), 4)
    known.append(_links(spark, 40))
    spark.sql(f"DROP TABLE {known.name}")           # the session's catalogue forgets; the files stay
    again = KnownLinks(spark, str(tmp_path / "k"))
    want = ig.exclude_known(_links(spark, 60), _links(spark, 40).withColumnRenamed("link", "url"))
    assert again.buckets == 4
    assert sorted(r.page_id for r in again.exclude(_links(spark, 60)).collect()) == sorted(r.page_id for r in want.collect())


def test_store_side_is_not_shuffled(spark, tmp_path):
    KnownLinks(spark, str(tmp_path / "k"), 16).append(_links(spark, 500))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = KnownLinks(spark, str(tmp_path / "k")).exclude(_links(spark, 900))
        plan = left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "LeftAnti" in plan and "SelectedBucketsCount: 16 out of 16" in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1      # the new links
    store = plan[plan.index("FileScan"):]
    assert "Exchange" not in store
