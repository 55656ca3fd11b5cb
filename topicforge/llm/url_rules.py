"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a line of text:

* ``org/`` or ``example.org/es/`` (host rule): fits the host and all its
  subdomains if the URL's path starts with the rule's path;
* ``||ads-track.`` (pattern, host start): fits where the host or one of its
  subdomains starts so; ``*`` stands for any characters;
* anything else (pattern): fits where it occurs in host, path and the rest.

Every rule becomes a regular expression.  Its *literal tokens* are the runs of
letters and digits that must occur whole in any URL that it fits; the rule is
filed under the rarest of them, as counted over the whole table of URLs.  A
URL looks up each of its own tokens, and only the rules found there (and those
without a literal token) run their expression.  Of the host rules that fit the
longest wins; without one, the longest pattern decides; without that, the
default.

The rules are a list of bounded length (``MOST_RULES``), broadcast to the
tasks; URLs are judged where they are read, with no shuffle.  The token counts
are a partial aggregate over the rules' tokens only.

Defined results: null URLs and URLs without ``://`` have an empty host and
path and get the default verdict; patterns see ASCII letters in lower case;
repeated rows repeat; ids may be null; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicforge.llm.common import slices

MOST_RULES = 200_000

#: Host rules, as (verdict, host and path).
HOST_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
#: Patterns of hosts and paths that a corpus should not take.
PATTERNS = [
    ("block", "||ads-track."),
    ("block", "||adult-x."),
    ("block", "||casino-win."),
    ("block", "||cheap-pills."),
    ("block", "||free-bets."),
    ("block", "||spam-farm."),
    ("block", "||doubleclick.net/"),
    ("block", "/wp-login.php"),
    ("block", "/cgi-bin/"),
    ("block", "?sessionid="),
    ("block", "/affiliate/*/click"),
]

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_TOKEN = re.compile("[a-z0-9]+")
_SPLIT = re.compile(r"([^/?#]*)([^?#]*)", re.S)


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str
    host_rule: bool
    regex: str

    @property
    def tokens(self) -> set[str]:
        """Runs of letters and digits that must occur whole."""
        body, host_start = self.text.translate(_UPPER), self.host_rule
        if body.startswith("||"):
            body, host_start = body[2:], True
        whole = set()
        for m in _TOKEN.finditer(body):
            left = m.start() > 0 and body[m.start() - 1] != "*" or m.start() == 0 and host_start
            right = m.end() < len(body) and body[m.end()] != "*"
            if left and right:
                whole.add(m.group())
        return whole


def host_rule(verdict: str, text: str) -> Rule:
    return Rule(text, verdict, True, r"(?:[^/?#]*\.)?" + re.escape(text))


def pattern_rule(verdict: str, text: str) -> Rule:
    body = text.translate(_UPPER)
    start = r"(?:[^/?#]*\.)?" if body.startswith("||") else r".*?"
    parts = body.removeprefix("||").split("*")
    return Rule(text, verdict, False, start + ".*?".join(map(re.escape, parts)))


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [pattern_rule(*r) for r in PATTERNS]


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host (ASCII lower case), path, and what follows the path."""
    if url is None or "://" not in url:
        return "", "", ""
    rest = url[url.index("://") + 3:]
    host, path = _SPLIT.match(rest).groups()
    return host.translate(_UPPER), path, rest[len(host) + len(path):]


def token_counts(urls: Column, frame: DataFrame, wanted: set[str]) -> dict[str, int]:
    """In how many URLs each wanted token occurs."""
    if not wanted:
        return {}
    spark = frame.sparkSession
    few = spark.createDataFrame([(t,) for t in sorted(wanted)], "token string")
    tokens = frame.select(F.explode(F.array_distinct(F.split(F.lower(urls), "[^a-z0-9]+"))).alias("token"))
    return {r["token"]: r["n"] for r in tokens.join(F.broadcast(few), "token").groupBy("token")
            .agg(F.count("*").alias("n")).collect()}


class Index:
    """Rules by their rarest literal token."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.by_token: dict[str, list] = defaultdict(list)
        self.rest: list = []
        for r in rules:
            entry = (r, re.compile(r.regex, re.S))
            tokens = r.tokens
            if tokens:
                self.by_token[min(tokens, key=lambda t: (counts.get(t, 0), t))].append(entry)
            else:
                self.rest.append(entry)

    def judge(self, url: str | None, default: str) -> tuple[str, str, str | None, str | None, str]:
        host, path, tail = split_url(url)
        seen = host + path + tail
        lower = seen.translate(_UPPER)
        candidates = [*self.rest]
        for token in set(_TOKEN.findall(lower)):
            candidates += self.by_token.get(token, ())
        fits = [r for r, regex in candidates if regex.match(host + path if r.host_rule else lower)]
        best = lambda rules: max(rules, key=lambda r: (len(r.text), r.text), default=None)
        host_best = best([r for r in fits if r.host_rule])
        pattern = best([r for r in fits if not r.host_rule])
        verdict = (host_best or pattern).verdict if host_best or pattern else default
        return host, path, host_best and host_best.text, pattern and pattern.text, verdict


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: list[Rule] | None = None, default: str = "allow") -> DataFrame:
    """``(<id>, host, path, rule, verdict, pattern)`` for every row."""
    rules = default_rules() if rules is None else rules
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; the index is broadcast and holds {MOST_RULES} at most")
    wanted = set().union(*(r.tokens for r in rules)) if rules else set()
    counts = token_counts(F.col(url_col), pages, wanted)
    sent = pages.sparkSession.sparkContext.broadcast((rules, counts))
    kind = pages.schema[id_col].dataType.simpleString()

    def judge(batches):
        index = Index(*sent.value)
        for part in slices(batches, 4096):
            got = [index.judge(u, default) for u in part.column(1).to_pylist()]
            host, path, rule, pattern, verdict = map(list, zip(*got))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x, pa.string()) for x in (host, path, rule, verdict, pattern))],
                [id_col, "host", "path", "rule", "verdict", "pattern"])

    return pages.select(id_col, url_col).mapInArrow(
        judge, f"`{id_col}` {kind}, host string, path string, rule string, verdict string, pattern string")
