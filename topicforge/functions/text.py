"""Text cleaning and tokenising as native column expressions.

Everything here returns a ``Column``; nothing leaves the JVM, so the whole
cleaning chain runs inside one whole-stage-codegen span.

Step order (URLs, domains and e-mails are removed *before* lower-casing):

  T1  null -> ''            T6  lower-case
  T2  drop http(s) links    T7  keep only a-z, Vietnamese letters, whitespace
  T3  drop www. links       T8  collapse whitespace, trim
  T4  drop bare domains     T10 split on spaces
  T5  drop e-mail-like runs T11 drop stopwords, T12 drop 1-char tokens, T13 join
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# Top-level domains removed by T4, in the reference's order:
TLDS = ("com vn net org edu gov info biz asia mobi name pro tel xxx xyz me tv "
        "cc ws io ai gl us uk ca au de fr jp cn ru br in eu").split()
# Letters kept by T7 besides a-z (lower-case Vietnamese letters, NFC):
VIET_LETTERS = ("àáạảãâầấậẩẫăằắặẳẵèéẹẻẽêềếệểễìíịỉĩòóọỏõôồốộổỗơờớợởỡ"
                "ùúụủũưừứựửữỳýỵỷỹđ")
# Placeholder title when an article page has no title tag:
MISSING_TITLE = "Không tìm thấy"
# ---------------------------------------------------------------------------

# Python's ``\s`` (str.isspace) written out so Java and RE2 agree with it:
# \t..\r, the four ASCII separators 0x1c-0x1f, NEL and every Unicode separator.
WS = r"\t-\r\x1c-\x1f\x85\p{Z}"
# Python's ``\w`` (str.isalnum or underscore):
WORD = r"\p{L}\p{N}_"

_TLD_ALT = "|".join(TLDS)

RE_HTTP = rf"https?://[^{WS}]+"
RE_WWW = rf"www\.[^{WS}]+"
# Java has look-arounds; the RE2 form used by the SQL oracle is in plans/oracle.py.
# Both patterns can only match from the start of a run of non-spaces; saying
# so keeps them linear on very long runs.
RE_DOMAIN = rf"(?<![^{WS}])[^{WS}]+\.(?:{_TLD_ALT})(?![{WORD}])"
RE_EMAIL = rf"(?<![^{WS}])[^{WS}]+@[^{WS}]+"
# Nothing that T2-T5 remove is without one of these.
RE_LINK = rf"://|www\.|@|\.(?:{_TLD_ALT})(?![{WORD}])"
# a-z and VIET_LETTERS as ranges: a class tries its members one by one, for each
# character of the text.  Upper-case letters between them are gone after T6.
RE_NOT_KEPT = "[^a-zà-ãè-êìíò-õùúýăđĩũơưạ-ỹ]+"
# T7, T8, T10 and T12 at once, on text after T6: runs of two kept letters or more.
RE_TOKEN = RE_NOT_KEPT.replace("[^", "[").replace("]+", "]{2,}")
RE_SPACES = rf"[{WS}]+"


def strip_links(c: Column) -> Column:
    """Null to '', then remove links, www links, bare domains and
    e-mail-like runs (case-sensitive, before lower-casing).  A text without any
    mark of them is left as it is: one search instead of four replacements."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    stripped = c
    for pat in (RE_HTTP, RE_WWW, RE_DOMAIN, RE_EMAIL):
        stripped = F.regexp_replace(stripped, pat, "")
    return F.when(F.rlike(c, F.lit(RE_LINK)), stripped).otherwise(c)


def normalise(c: Column) -> Column:
    """Lower-case, turn each run of characters that are not kept
    letters (whitespace included) into one space, and trim."""
    return F.trim(F.regexp_replace(F.lower(c), RE_NOT_KEPT, " "))


def clean_text(c: Column) -> Column:
    """T1-T8 as one expression: the cleaned, space-separated string."""
    return normalise(strip_links(c))


def tokens(cleaned: Column) -> Column:
    """Whitespace tokens of an already cleaned string."""
    return F.split(cleaned, " ")


def filter_tokens(toks: Column, stopwords: list[str] | None = None,
                  min_len: int = 2) -> Column:
    """Drop stopwords and tokens shorter than ``min_len`` characters.

    Stopwords are matched exactly (case-sensitive).  The literal list becomes
    a hash-set ``InSet`` check inside codegen; no join or shuffle is needed.
    """
    def keep(x):
        cond = F.length(x) >= min_len
        if stopwords:
            cond = cond & ~x.isin(list(stopwords))
        return cond
    return F.filter(toks, keep)


def processed_tokens(c: Column, stopwords: list[str] | None = None) -> Column:
    """Raw text column to the array of kept tokens."""
    return filter_tokens(tokens(clean_text(c)), stopwords)


def processed_content(c: Column, stopwords: list[str] | None = None) -> Column:
    """Raw text column to the processed, space-joined string."""
    return F.array_join(processed_tokens(c, stopwords), " ")


def not_blank(c: Column) -> Column:
    """True when ``c`` is non-null and has a non-whitespace character."""
    return c.isNotNull() & (F.length(F.regexp_replace(c, RE_SPACES, "")) > 0)
