"""Page ingest chain (W1-W10) on invented pages."""

from pyspark.sql import functions as F

from topicforge.functions.text import MISSING_TITLE
from topicforge.operators import ingest as ig
from topicforge.sources.articles import read_stored_articles, write_articles

SITES = [("news", "News", ["h3.title a", "h2.title a"],
          ("h1.headline", "p.sapo", "div.body p"), None)]


def _category_page(n):
    links = "".join(f'<h3 class="title"><a href="/a{i}.html">x</a></h3>' for i in range(n))
    return f"<html><body>{links}<h2 class='title'><a href='/a0.html'>dup</a></h2></body></html>"


def _article(i, with_content=True):
    body = f"<div class='body'><p>Đoạn {i}</p><p><b>hai</b> ba</p></div>" if with_content else ""
    return f"<html><h1 class='headline'> Tin {i} </h1>{body}</html>"


def test_ingest_chain(spark, tmp_path):
    cats = spark.createDataFrame([(1, "https://www.news.vn/the-thao/", _category_page(60)),
                                  (2, "https://other.org/x", _category_page(3))],
                                 "page_id long, url string, html string")
    fetched = spark.createDataFrame(
        [(100 + i, f"https://www.news.vn/a{i}.html", _article(i, with_content=(i != 7))) for i in range(60)],
        "page_id long, url string, html string")
    root = str(tmp_path / "store")
    # a previous run stored articles a0..a4 for (news, the-thao)
    prev = spark.createDataFrame(
        [(f"https://www.news.vn/a{i}.html", "t", "", "c", "news", "the-thao") for i in range(5)],
        "url string, title string, description string, content string, site_key string, category string")
    write_articles(prev, root)
    stored = read_stored_articles(spark, root)

    routed = ig.route(cats, SITES)
    assert [(r.page_id, r.site_key, r.category) for r in routed.collect()] == [(1, "news", "the-thao")]
    links = ig.first_links(ig.extract_links(routed, SITES))
    assert links.count() == 60                       # the h2 duplicate of a0 is dropped
    fresh = ig.exclude_known(links, stored)
    assert fresh.count() == 55
    capped = ig.cap_links(fresh, 50).orderBy("rank").collect()
    assert [r.link for r in capped] == [f"https://www.news.vn/a{i}.html" for i in range(5, 55)]

    new = ig.ingest(cats, fetched, stored, SITES, limit=50)
    rows = {r.url: r for r in new.collect()}
    assert len(rows) == 49                           # a7 has no content
    r = rows["https://www.news.vn/a5.html"]
    assert (r.title, r.description, r.content, r.site_key, r.category) == (
        "Tin 5", "", "Đoạn 5\nhaiba", "news", "the-thao")
    write_articles(new, root)
    assert read_stored_articles(spark, root).count() == 54
    again = ig.ingest(cats, fetched, read_stored_articles(spark, root), SITES, limit=50)
    assert again.count() == 5                        # a55..a59 are next in line
    none = ig.extract_articles(ig.route(fetched.limit(1).selectExpr(
        "page_id", "url", "'<html></html>' AS html"), SITES), SITES)
    assert none.count() == 0
    assert MISSING_TITLE == "Không tìm thấy"


def test_first_links_in_task_equals_window(spark):
    cats = spark.createDataFrame([(1, "https://www.news.vn/a/", _category_page(7)),
                                  (2, "https://www.news.vn/b/", _category_page(3))],
                                 "page_id long, url string, html string")
    routed = ig.route(cats, SITES)
    by_window = ig.first_links(ig.extract_links(routed, SITES))
    in_task = ig.extract_links(routed, SITES, first_only=True)
    cols = ["page_id", "link", "selector_ix", "pos"]
    assert sorted(by_window.select(cols).collect()) == sorted(in_task.select(cols).collect())


def test_bad_page_yields_no_links(spark):
    bad = '<h3 class="title"><a href="http://[bad-ipv6/x">x</a></h3>'
    cats = spark.createDataFrame([(1, "https://www.news.vn/a/", bad),
                                  (2, "https://www.news.vn/b/", _category_page(2))],
                                 "page_id long, url string, html string")
    links = ig.extract_links(ig.route(cats, SITES), SITES).collect()
    assert {r.page_id for r in links} == {2} and len(links) == 3


def _page(links):
    return "".join(f'<h3 class="title"><a href="{x}">x</a></h3>' for x in links)


def test_cap_counts_after_what_earlier_pages_took(spark):
    cats = spark.createDataFrame(
        [(1, "https://www.news.vn/a/", _page(["/1", "/2", "/3", "/4"])),
         (2, "https://www.news.vn/a", _page(["/2", "/4", "/5", "/6", "/7"])),
         (3, "https://www.news.vn/b/", _page(["/1", "/2"]))], "page_id long, url string, html string")
    links = ig.extract_links(ig.route(cats, SITES), SITES, first_only=True)
    got = sorted((r.page_id, r["rank"], r.link[-2:]) for r in ig.cap_links(links, 3).collect())
    assert got == [(1, 1, "/1"), (1, 2, "/2"), (1, 3, "/3"), (2, 1, "/4"), (2, 2, "/5"), (2, 3, "/6"),
                   (3, 1, "/1"), (3, 2, "/2")]


def test_stored_categories_stay_text(spark, tmp_path):
    root = str(tmp_path / "store")
    cats = spark.createDataFrame([(1, "https://www.news.vn/007/", _page(["/a1.html"])),
                                  (2, "https://www.news.vn/.html", _page(["/a2.html"]))],
                                 "page_id long, url string, html string")
    fetched = spark.createDataFrame([(9, "https://www.news.vn/a1.html", _article(1)),
                                     (10, "https://www.news.vn/a1.html", _article(1)),
                                     (11, "https://www.news.vn/a2.html", _article(2))],
                                    "page_id long, url string, html string")
    # a first run without articles leaves a store that can be read again
    write_articles(ig.ingest(cats, fetched.limit(0), None, SITES), root)
    assert read_stored_articles(spark, root) is None or read_stored_articles(spark, root).count() == 0
    new = ig.ingest(cats, fetched, read_stored_articles(spark, root), SITES)
    assert sorted((r.category, r.url[-7:]) for r in new.collect()) == [("", "a2.html"), ("007", "a1.html")]
    write_articles(new, root)
    stored = read_stored_articles(spark, root)
    assert sorted(r.category for r in stored.collect()) == ["", "007"]
    assert ig.ingest(cats, fetched, stored, SITES).count() == 0
    routed = ig.route(cats, SITES)
    links = ig.extract_links(routed, SITES)
    assert ig.exclude_known(links, stored, routed).count() == 0
    for most in (0, 10):                              # either way of reading the store
        assert ig.stored_for(stored, routed, max_literal=most).count() == 2


def test_rejects_are_counted(spark):
    pages = spark.createDataFrame([(1, "https://www.news.vn/a", _article(1)), (2, "https://www.news.vn/b", ""),
                                   (3, "https://www.news.vn/c", None)], "page_id long, url string, html string")
    routed = ig.route(pages, SITES)
    assert [tuple(r) for r in ig.article_rejects(routed, SITES).collect()] == [("no_content", 2)]
    bad = spark.createDataFrame([(1, "https://www.news.vn/a", '<h3 class="title"><a href="http://[x/">x</a></h3>')],
                                "page_id long, url string, html string")
    assert [tuple(r) for r in ig.link_rejects(ig.route(bad, SITES), SITES).collect()] == [("parse_error", 1)]


def test_cap_matches_a_walk_page_after_page(spark):
    import random
    r = random.Random(8)
    rows, want = [], set()
    for key, cat, limit in (("s", "a", 3), ("s", "b", 3), ("t", "a", 3)):
        taken = set()
        for page in r.sample(range(1000), 40):
            rows += [(page, key, cat, f"l{r.randrange(60)}", r.randrange(2), pos) for pos in range(r.randrange(9))]
        for page in sorted({x[0] for x in rows if x[1:3] == (key, cat)}):
            rank = 0
            for _, _, _, link, _, _ in sorted((x for x in rows if x[:3] == (page, key, cat)), key=lambda x: x[4:]):
                if rank < limit and link not in taken:
                    rank += 1
                    taken.add(link)
                    want.add((page, key, cat, link, rank))
    frame = spark.createDataFrame(rows, "page_id long, site_key string, category string, link string, selector_ix int, pos int")
    got = ig.cap_links(frame, 3)
    assert {(x.page_id, x.site_key, x.category, x.link, x.rank) for x in got.collect()} == want
    assert ig.cap_links(frame.limit(0), 3).count() == 0
    assert "PythonUDF" not in got._jdf.queryExecution().toString()


def test_few_pages_are_python_objects():
    """However many pages an Arrow batch has, a task turns few into objects."""
    import pyarrow as pa
    from topicforge.operators import ingest

    class Pages:
        def select(self, *_):
            return self

        def mapInArrow(self, fn, _):
            return fn

    n = 10 * ingest.SLICE_PAGES + 3
    run = ingest._page_rows(Pages(), lambda pid, *_: iter([(pid, None), (pid, "x")][:pid % 3]), "page_id long, error string")
    batch = pa.RecordBatch.from_pylist([{"page_id": i, "url": "u", "html": None, "site_key": "k", "category": None}
                                        for i in range(n)])
    out = list(run([batch]))
    assert len(out) == 11 and max(b.num_rows for b in out) <= 2 * ingest.SLICE_PAGES
    want = [(i, v) for i in range(n) for v in [None, "x"][:i % 3]]
    assert [(r["page_id"], r["error"]) for b in out for r in b.to_pylist()] == want


def test_a_run_writes_one_file_a_folder(spark, tmp_path):
    """Articles of a category that come from many tasks share a file."""
    rows = [(f"u{i}", "t", "d", "c", "s", f"k{i % 5}") for i in range(60)]
    df = spark.createDataFrame(rows, "url string, title string, description string, content string, "
                                     "site_key string, category string").repartition(7)
    root = str(tmp_path / "articles")
    for run in (1, 2):
        write_articles(df, root)
        files = list((tmp_path / "articles").rglob("*.parquet"))
        assert len(files) == 5 * run
    assert read_stored_articles(spark, root).count() == 120


def test_many_categories_share_folders(spark, tmp_path, monkeypatch):
    """A run of many categories adds few folders, beside a store of own ones, and
    a later run opens only folders that can hold its categories."""
    from topicforge.sources import articles
    schema = "url string, title string, description string, content string, site_key string, category string"
    few = spark.createDataFrame([(f"u{i}", "t", "d", "c", "s", k) for i, k in enumerate(["", "007", "k3", None])], schema)
    many = spark.createDataFrame([(f"v{i}", "t", None, "c", "s", f"k{i}" if i else "") for i in range(200)], schema).repartition(7)
    root = str(tmp_path / "articles")
    write_articles(few, root)
    monkeypatch.setattr(articles, "MOST_FOLDERS", 20)
    write_articles(many, root)
    files = list((tmp_path / "articles").rglob("*.parquet"))
    assert len(files) <= 4 + articles.SHARED_FOLDERS
    stored = read_stored_articles(spark, root)
    want = [tuple(r) for df in (few, many) for r in df.select("url", "site_key", "category").collect()]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in stored.select("url", "site_key", "category").collect())
    for most in (0, 10):
        keys = spark.createDataFrame([("s", "k3"), ("s", ""), ("s", "none")], "site_key string, category string")
        got = ig.stored_for(stored, keys, max_literal=most)
        assert sorted(r.url for r in got.collect()) == ["u0", "u2", "v0", "v3"]
    opened = got.select(F.input_file_name().alias("f")).distinct().count()
    assert opened <= 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [concat_ws" in plan
