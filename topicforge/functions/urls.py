"""URL parts as column expressions.

The network location is the text between ``scheme://`` and the first
``/``, ``?`` or ``#`` (it keeps user info and port, as a parsed URL's netloc
does).  The path stops at ``?``/``#``; parameters after a ``;`` in the last
segment are not part of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: category name used for a site's front page (empty path).
FRONT_PAGE = "trang-chu"

RE_NETLOC = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
RE_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, RE_NETLOC, 1)


def path(url: Column) -> Column:
    p = F.regexp_extract(url, RE_PATH, 1)
    return F.regexp_replace(p, r";[^/]*$", "")


def category(url: Column) -> Column:
    """Path without surrounding slashes, inner slashes as ``_``, empty as
    the front-page name; a name ending in .htm/.html is cut at its first dot."""
    c = F.regexp_replace(F.regexp_replace(path(url), r"^/+|/+$", ""), "/", "_")
    c = F.when(c == "", F.lit(FRONT_PAGE)).otherwise(c)
    return F.when(c.endswith(".htm") | c.endswith(".html"),
                  F.substring_index(c, ".", 1)).otherwise(c)


def site_key(url: Column, keys: list[str]) -> Column:
    """First configured key (config order) contained in the URL's
    network location; null when none matches."""
    host = netloc(url)
    expr = None
    for k in keys:
        expr = (F.when(host.contains(k), F.lit(k)) if expr is None
                else expr.when(host.contains(k), F.lit(k)))
    return expr if expr is not None else F.lit(None).cast("string")
