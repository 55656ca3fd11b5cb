"""HTML helpers (W1, W2, W8) and URL column functions."""

from pyspark.sql import functions as F

from topicforge.functions import html as hx
from topicforge.functions import urls as ux
from topicforge.functions.text import MISSING_TITLE


def test_links_order_dedup_and_resolution():
    page = ('<h3 class="t"><a href="/a">A</a></h3><h3 class="t"><a>no href</a></h3>'
            '<h2 class="t"><a href="b.html">B</a></h2><h3 class="t"><a href="//cdn.x/c">C</a></h3>'
            '<h2 class="t"><a href="/a">A again</a></h2>')
    root = hx.parse(page)
    got = hx.article_links(root, "https://site.vn/cat/page", ["h3.t a", "h2.t a"])
    assert got == [(0, 0, "/a", "https://site.vn/a"), (0, 1, "//cdn.x/c", "https://cdn.x/c"),
                   (1, 0, "b.html", "https://site.vn/cat/b.html"), (1, 1, "/a", "https://site.vn/a")]


def test_article_fields_edge_cases():
    page = ("<html><head><script>var t='</p>';</script><style>p{}</style></head><body>"
            "<div class='body'><p>one <b>two</b> three<p></p><p>four<br>five</div>"
            "<p class='description'>desc</p></body></html>")
    root = hx.parse(page)
    title, desc, content = hx.article_fields(root, "h1.none", "p.description", "div.body p", MISSING_TITLE)
    assert title == MISSING_TITLE
    assert desc == "desc"
    assert content == "onetwothreefourfive\n\nfourfive"   # an open <p> holds the next ones


def test_text_nodes_run_to_the_next_tag():
    def text(page):
        return hx.select_one(hx.parse(page), "p").text()
    assert text("<p>giá < 5 triệu</p>") == "giá < 5 triệu"
    assert text("<p>a &amp; b &lt; c</p>") == "a & b < c"
    assert text("<p>a <!-- note --> b</p>") == "ab"
    assert text("<p>a </b> b") == "ab"               # a stray end tag ends a text node too
    assert text("<p>tail") == "tail"


def test_very_deep_pages():
    deep = "<div>" * 5000 + "<p>x</p>" + "<b>" * 50000 + "y"
    root = hx.parse(deep)
    assert [n.text() for n in hx.select(root, "p")] == ["x"]
    assert root.text() == "xy"


def test_selector_grammar():
    root = hx.parse('<div id="main"><p>x</p></div><div class="a b"><section><p>y</p></section></div>')
    assert [n.text() for n in hx.select(root, "div#main p, div.b p")] == ["x", "y"]
    assert [n.text() for n in hx.select(root, "div.a.b section p")] == ["y"]
    assert hx.select_one(root, "span") is None


def test_category_and_site(spark):
    rows = [("https://vnexpress.net/",), ("https://vnexpress.net/a/b.htm",),
            ("https://tuoitre.vn/a.b/c.html",), ("https://x.vn/a.b/c",),
            ("https://unknown.org/x",), ("https://tuoitre.vnexpress.net/x",)]
    df = spark.createDataFrame(rows, "url string")
    keys = ["vnexpress", "znews", "tuoitre"]
    out = df.select(ux.category(F.col("url")).alias("c"), ux.site_key(F.col("url"), keys).alias("k")).collect()
    assert [r.c for r in out] == ["trang-chu", "a_b", "a", "a.b_c", "x", "x"]
    assert [r.k for r in out] == ["vnexpress", "vnexpress", "tuoitre", None, None, "vnexpress"]


def test_site_dimension(spark):
    from topicforge.sources.sites import NEWS_SITES, site_table
    rows = site_table(spark).orderBy("ord").collect()
    assert [r.site_key for r in rows] == [s[0] for s in NEWS_SITES] and len(rows) == 7
    assert rows[0].base_url is None and rows[1].base_url == "https://znews.vn"
    assert rows[6].article_selectors.content.count(",") == 2
