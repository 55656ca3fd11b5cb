"""Article ingest from tables of fetched pages.

The crawl itself (HTTP, threads, pauses) is not rebuilt: ingest starts from
a table ``(page_id, url, html)`` of pages already fetched.  Everything after
the fetch is a Spark job:

  route (W4 site, W5 category) -> links (W1 + W2, Python parser per task)
  -> first occurrence per page (W3) -> drop known links (W6, anti-join)
  -> first 50 per category page that no earlier page of the category takes (W7)
  -> join fetched article pages by URL -> fields (W8)
  -> drop empty content (W9) -> append per (site, category) (W10/S6)

Pages that can't be parsed and articles without content are counted by reason
(``link_rejects``, ``article_rejects``).

Catalyst will not move filters across ``mapInArrow``, so the cheap steps
(anti-join, cap) are ordered before article extraction by hand.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicforge.functions import html as hx
from topicforge.functions import urls as ux
from topicforge.functions.text import MISSING_TITLE
from topicforge.operators.common import slices
from topicforge.session import checkpoint_dir
from topicforge.sources.articles import own_folder, shared_folder
from topicforge.sources.sites import NEWS_SITES

LINK_SCHEMA = ("page_id long, site_key string, category string, selector_ix int, pos int, "
               "href string, link string")
ARTICLE_SCHEMA = ("page_id long, url string, site_key string, category string, title string, "
                  "description string, content string")
#: Pages that a task holds as Python objects at a time.
SLICE_PAGES = 16
#: Reasons for which a page yields nothing.
PARSE_ERROR, NO_CONTENT = "parse_error", "no_content"


def _site_maps(sites):
    links = {k: list(ls) for k, _, ls, _, _ in sites}
    arts = {k: a for k, _, _, a, _ in sites}
    return links, arts


def route(pages: DataFrame, sites=NEWS_SITES, url_col: str = "url") -> DataFrame:
    """Add ``site_key`` (first key contained in the host, config
    order) and ``category``; pages of unsupported sites are dropped."""
    keys = [s[0] for s in sites]
    return (pages.withColumn("site_key", ux.site_key(F.col(url_col), keys))
            .where(F.col("site_key").isNotNull())
            .withColumn("category", ux.category(F.col(url_col))))


def extract_links(routed: DataFrame, sites=NEWS_SITES, first_only: bool = False) -> DataFrame:
    """Every article link of every routed category page.

    With ``first_only`` each link is kept once per page, at its first
    (selector, position) (W3) inside the task that parsed the page: all of a
    page's links come from one call, so this needs no shuffle (the window
    form, ``first_links``, needs one because Spark cannot know the Python
    stage's output is still grouped by page)."""
    return _links(routed, sites, first_only).where("error is null").drop("error")


def link_rejects(routed: DataFrame, sites=NEWS_SITES) -> DataFrame:
    """Category pages that yield no links, counted by reason."""
    return (_links(routed, sites, True).where("error is not null")
            .groupBy(F.col("error").alias("reason")).agg(F.count(F.lit(1)).alias("n_pages")))


def _page_rows(routed: DataFrame, fields, schema: str) -> DataFrame:
    """``fields(page_id, url, html, site_key, category)`` of each page: rows of
    ``schema``.  Few pages at a time are Python objects."""
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[f.split()[1]] for f in schema.split(", ")]

    def part(batches):
        for batch in slices(batches, SLICE_PAGES):
            rows = [row for page in zip(*(c.to_pylist() for c in batch.columns)) for row in fields(*page)]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return routed.select("page_id", "url", "html", "site_key", "category").mapInArrow(part, schema)


def _links(routed: DataFrame, sites, first_only: bool) -> DataFrame:
    link_sel, _ = _site_maps(sites)

    def fields(pid, url, html, key, cat):
        try:
            found = hx.article_links(hx.parse(html), url, link_sel.get(key, []))
        except (ValueError, AssertionError):  # a bad URL or markup declaration
            yield pid, key, cat, -1, -1, None, None, PARSE_ERROR
            return
        seen = set()
        for si, pos, href, link in found:
            if first_only:
                if link in seen:
                    continue
                seen.add(link)
            yield pid, key, cat, si, pos, href, link, None

    return _page_rows(routed, fields, LINK_SCHEMA + ", error string")


def first_links(links: DataFrame) -> DataFrame:
    """Each link once per page, at its first (selector, position)."""
    w = Window.partitionBy("page_id", "link").orderBy("selector_ix", "pos")
    return links.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def stored_for(stored: DataFrame, keys: DataFrame, max_literal: int = 10_000) -> DataFrame:
    """The stored rows of the (site_key, category) pairs named in ``keys``
    only.  Up to ``max_literal`` pairs (counted first) become one hash-set
    ``IN`` on the store's partition columns, which Spark evaluates against
    the folder names: folders that hold none of them are never opened.  A
    larger pair list falls back to a semi-join."""
    pairs = keys.select("site_key", "category").distinct()
    got = pairs.withColumn("own", own_folder(F.col("category"))).withColumn(
        "shared", shared_folder(F.col("category"))).limit(max_literal + 1).collect()
    if len(got) > max_literal:
        return stored.join(pairs, ["site_key", "category"], "left_semi")
    sep = "\u0001"
    wanted = sorted({f"{r.site_key}{sep}{r.category}" for r in got})
    if "folder" in stored.columns:
        folders = sorted({f"{r.site_key}{sep}{f}" for r in got for f in (r.own, r.shared)})
        stored = stored.where(F.concat_ws(sep, "site_key", "folder").isin(folders))
    return stored.where(F.concat_ws(sep, "site_key", "category").isin(wanted))


def exclude_known(links: DataFrame, stored: DataFrame | None,
                  keys: DataFrame | None = None) -> DataFrame:
    """Drop links already stored for the same (site, category).  Only the
    partitions of the categories being crawled are read from the store;
    ``keys`` (e.g. the routed category pages) names them without running the
    link extraction a second time."""
    if stored is None:
        return links
    known = stored_for(stored, links if keys is None else keys)
    known = known.select("site_key", "category", F.col("url").alias("link"))
    return links.join(known, ["site_key", "category", "link"], "left_anti")


def cap_links(links: DataFrame, limit: int = 50) -> DataFrame:
    """For each category page the first ``limit`` links, in link order,
    that no earlier page (by ``page_id``) of the same (site, category) took:
    a run stores each page's articles before it turns to the next.  The cap is
    the reference's per-run crawl budget, applied after the exclusion.

    Whether a page takes a link depends on the pages before it, yet no
    category is worked off in one task: in rounds, each link is offered to its
    earliest page that hasn't refused it, each page keeps its first ``limit``
    offers, and the refused ones move on.  A refusal is final, since a page's
    offers only get better; when none is left, every page holds the first
    ``limit`` links that all earlier pages refused.  A round is a partial
    minimum by link and a window over the offers of one page."""
    checkpoint_dir(links.sparkSession)
    link, page = ["site_key", "category", "link"], ["site_key", "category", "page_id"]
    once = Window.partitionBy(*page, "link").orderBy("selector_ix", "pos")
    left = links.withColumn("_r", F.row_number().over(once)).where("_r = 1").drop("_r").checkpoint()
    order = Window.partitionBy(*page).orderBy("selector_ix", "pos", "link")
    while True:
        first = left.groupBy(*link).agg(F.min("page_id").alias("page_id"))
        offers = left.join(first, [*link, "page_id"]).select(*left.columns).withColumn(
            "rank", F.row_number().over(order)).checkpoint()
        refused = offers.where(F.col("rank") > limit).select(*link, "page_id")
        if refused.isEmpty():
            return offers
        left = left.join(refused, [*link, "page_id"], "left_anti").select(*left.columns).checkpoint()


def extract_articles(article_pages: DataFrame, sites=NEWS_SITES,
                     missing_title: str = MISSING_TITLE, separator: str = "") -> DataFrame:
    """Title, description and content of routed article pages; pages
    whose content is empty (or cannot be parsed) yield no row."""
    return (_articles(article_pages, sites, missing_title, separator)
            .where("error is null").drop("error"))


def article_rejects(article_pages: DataFrame, sites=NEWS_SITES) -> DataFrame:
    """Article pages that yield no row, counted by reason."""
    return (_articles(article_pages, sites, MISSING_TITLE, "").where("error is not null")
            .groupBy(F.col("error").alias("reason")).agg(F.count(F.lit(1)).alias("n_pages")))


def _articles(article_pages: DataFrame, sites, missing_title: str, separator: str) -> DataFrame:
    _, art_sel = _site_maps(sites)

    def fields(pid, url, html, key, cat):
        t_sel, d_sel, c_sel = art_sel[key]
        try:
            title, desc, content = hx.article_fields(hx.parse(html), t_sel, d_sel, c_sel, missing_title, separator)
        except (ValueError, AssertionError):  # a bad markup declaration
            yield pid, url, key, cat, None, None, None, PARSE_ERROR
            return
        yield pid, url, key, cat, title, desc, content, None if content else NO_CONTENT

    return _page_rows(article_pages, fields, ARTICLE_SCHEMA + ", error string")


def ingest(category_pages: DataFrame, fetched: DataFrame, stored: DataFrame | None,
           sites=NEWS_SITES, limit: int = 50) -> DataFrame:
    """New article rows ``(url, title, description, content,
    site_key, category)`` ready for the append sink (``write_articles``).

    ``fetched`` is the table of fetched article pages ``(page_id, url,
    html)``; the capped links are equi-joined to it on the URL, of which the
    fetch with the smallest ``page_id`` counts.  Each article is routed to the
    (site, category) of the category page that linked it, once.
    """
    routed = route(category_pages, sites)
    links = cap_links(exclude_known(extract_links(routed, sites, first_only=True), stored, routed), limit)
    todo = links.select("link", "site_key", "category").distinct()
    first = Window.partitionBy("site_key", "category", "url").orderBy("page_id")
    pages = (fetched.select("page_id", F.col("url").alias("link"), "html")
             .join(todo, "link").withColumnRenamed("link", "url")
             .withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r"))
    arts = extract_articles(pages, sites)
    return arts.select("url", "title", "description", "content", "site_key", "category")
