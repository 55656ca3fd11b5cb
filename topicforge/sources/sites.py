"""Site-configuration dimension.

One row per supported news site: the key looked up in a page's host, the
selectors for article links on a category page and for the title,
description and content of an article page.  The dimension is tiny and
fixed, so the lookup (W4) is compiled into a ``CASE WHEN`` chain in config
order instead of a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SITE_SCHEMA = T.StructType([
    T.StructField("site_key", T.StringType(), False),
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("link_selector", T.ArrayType(T.StringType()), False),
    T.StructField("article_selectors", T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("content", T.StringType()),
    ]), False),
    T.StructField("base_url", T.StringType(), True),
])

# ---------------------------------------------------------------------------
# The reference's site configuration, in its order
# (key, name, link selectors, title / description / content selectors, base url).
NEWS_SITES = [
    ("vnexpress", "VnExpress", ["h3.title-news a"],
     ("h1.title-detail", "p.description", "article.fck_detail p.Normal"), None),
    ("znews", "ZNews", ["article.article-item .article-title a"],
     ("h1.the-article-title", "p.the-article-summary", "div.the-article-body p"), "https://znews.vn"),
    ("thanhnien", "Thanh Niên", ["a.story__title", "a.box-category-link-title"],
     ("h1.detail-title", "h2.detail-sapo", "div.detail-cmain p"), "https://thanhnien.vn"),
    ("tuoitre", "Tuổi Trẻ", ["h3.box-title-text a"],
     ("h1.detail-title", "h2.detail-sapo", "div.detail-cmain p"), "https://tuoitre.vn"),
    ("dantri", "Dân trí", ["h3.article-title a", "h2.article-title a"],
     ("h1.title-page", "h2.singular-sapo", "div.singular-content p"), "https://dantri.com.vn"),
    ("tienphong", "Tiền Phong", ["article.story h2 a"],
     ("h1.article__title", "div.article__sapo", "div.article__body p"), "https://tienphong.vn"),
    ("vietnamnet", "VietnamNet", ["h3.vnn-title a", "h4.vnn-title a"],
     ("h1.content-title", "div.content-detail-sapo h2",
      "div.maincontent-detail p, div.main-content-body p, div#maincontent p"), "https://vietnamnet.vn"),
]
# ---------------------------------------------------------------------------

# A configuration for the driver's ``pages`` table (hosts under example.*),
# written in the same shape.  "blog" comes first so a host such as
# blog.x.example.net matches two keys and the first in order must win.
EXAMPLE_SITES = [
    ("blog", "Blog pages", ["nav a"], ("article h1", "div.ad", "article p"), None),
    ("example.com", "Example COM", ["nav li a"], ("article h1", "p.description", "article p"), None),
    ("example.net", "Example NET", ["nav a", "footer a"], ("h1", "div.ad", "article p"), None),
    ("example.org", "Example ORG", ["ul a"], ("article h1", "div.ad", "p"), None),
]


def site_rows(sites=None) -> list[tuple]:
    sites = NEWS_SITES if sites is None else sites
    return [(k, i, name, list(links), arts, base)
            for i, (k, name, links, arts, base) in enumerate(sites)]


def site_table(spark: SparkSession, sites=None) -> DataFrame:
    """S11 as a DataFrame with ``ord`` = config order."""
    return spark.createDataFrame(site_rows(sites), SITE_SCHEMA)
