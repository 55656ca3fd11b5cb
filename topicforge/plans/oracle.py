"""DuckDB SQL oracles for the named queries in ``plans/catalog.py``.

The driver registers the driver tables as views and runs these strings next
to the Spark queries.  DuckDB's RE2 has no look-arounds, so the bare-domain
rule (T4) is written as ``chunk . tld (non-word | end)`` -> ``\\1``: a match,
if one exists in a whitespace-delimited chunk, always starts at the chunk's
start, so the look-behind is implied.
"""

from __future__ import annotations

R = 6

# ---------------------------------------------------------------------------
# Fixed values, written out here so that a wrong constant in the checked code
# shows: whitespace and word characters, top-level domains, kept letters.
WS = r"\t-\r\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
TLDS = ("com vn net org edu gov info biz asia mobi name pro tel xxx xyz me tv "
        "cc ws io ai gl us uk ca au de fr jp cn ru br in eu").split()
LETTERS = ("àáạảãâầấậẩẫăằắặẳẵèéẹẻẽêềếệểễìíịỉĩòóọỏõôồốộổỗơờớợởỡ"
           "ùúụủũưừứựửữỳýỵỷỹđ")
NETLOC = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
EXAMPLE_KEYS = ("blog", "example.com", "example.net", "example.org")
# ---------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_DOMAIN_RE2 = rf"[^{WS}]+\.(?:{'|'.join(TLDS)})([^{WORD}]|$)"


def clean_sql(col: str) -> str:
    """T1-T8 as a DuckDB expression."""
    e = f"coalesce(CAST({col} AS VARCHAR), '')"
    e = f"regexp_replace({e}, {_q(f'https?://[^{WS}]+')}, '', 'g')"
    e = f"regexp_replace({e}, {_q(rf'www[.][^{WS}]+')}, '', 'g')"
    e = f"regexp_replace({e}, {_q(_DOMAIN_RE2)}, '\\1', 'g')"
    e = f"regexp_replace({e}, {_q(f'[^{WS}]+@[^{WS}]+')}, '', 'g')"
    e = f"lower({e})"
    e = f"regexp_replace({e}, {_q(f'[^a-z{LETTERS}{WS}]')}, ' ', 'g')"
    e = f"regexp_replace({e}, {_q(f'[{WS}]+')}, ' ', 'g')"
    return f"trim({e})"


def tokens_sql(col: str) -> str:
    """Kept tokens as a DuckDB list."""
    return f"list_filter(string_split({clean_sql(col)}, ' '), lambda x: length(x) >= 2)"


def _corpus(src: str = "documents", id_col: str = "doc_id", extra: str = ", source") -> str:
    """CTEs ``toks`` (doc_id, tokens), ``counts`` (doc_id, term, tf), ``nd`` (n)."""
    return f"""
toks AS (
  SELECT {id_col} AS doc_id{extra}, {tokens_sql('text')} AS tokens FROM {src}
),
toks_kept AS (SELECT * FROM toks WHERE len(tokens) > 0),
counts AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(tokens) AS term FROM toks_kept) GROUP BY doc_id, term
),
nd AS (SELECT count(*) AS n FROM toks_kept)"""


_VOCAB = """
stats AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM counts GROUP BY term
),
eligible AS (
  SELECT s.* FROM stats s, nd WHERE s.df >= 5 AND s.df <= 0.8 * nd.n
),
capped AS (SELECT * FROM eligible ORDER BY tf DESC, term ASC LIMIT 5000),
vocab AS (
  SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, tf,
         ln((1.0 + nd.n) / (1.0 + df)) + 1.0 AS idf
  FROM capped, nd
)"""

_WEIGHTS = """
raw AS (
  SELECT c.doc_id, v.idx, v.term, c.tf * v.idf AS w FROM counts c JOIN vocab v USING (term)
),
weights AS (
  SELECT doc_id, idx, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw
)"""


def _topic_sql(n: int, with_rel: bool) -> str:
    rel = f", round(weight / max(weight) OVER (PARTITION BY source), {R}) AS rel_weight" if with_rel else ""
    return f"""
WITH {_corpus()},{_VOCAB},{_WEIGHTS},
sizes AS (SELECT source, count(*) AS n FROM toks_kept GROUP BY source),
sums AS (
  SELECT t.source, w.idx, w.term, sum(w.weight) AS s
  FROM weights w JOIN toks_kept t USING (doc_id) GROUP BY t.source, w.idx, w.term
),
cents AS (
  SELECT sums.source, idx, term, round(s / sizes.n, 10) AS weight
  FROM sums JOIN sizes USING (source)
),
ranked AS (
  SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY weight DESC, term ASC) AS INTEGER) AS rank,
         term, weight FROM cents
)
SELECT source, rank, term, round(weight, {R}) AS weight{rel}
FROM ranked WHERE rank <= {n}
"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["source_counts"] = "SELECT source, count(*) AS n_docs FROM documents GROUP BY source"
    q["clean_text"] = f"""
SELECT doc_id, processed_content FROM (
  SELECT doc_id, array_to_string({tokens_sql('text')}, ' ') AS processed_content FROM documents
) WHERE length(regexp_replace(processed_content, {_q(f'[{WS}]+')}, '', 'g')) > 0
"""
    q["term_stats"] = f"""
WITH {_corpus(extra='')}
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM counts GROUP BY term
"""
    q["vocabulary"] = f"""
WITH {_corpus()},{_VOCAB}
SELECT term, idx, df, tf, round(idf, {R}) AS idf FROM vocab
"""
    q["vocab_head"] = f"""
WITH {_corpus()},{_VOCAB}
SELECT CAST(row_number() OVER (ORDER BY term) AS INTEGER) AS rank, term,
       (SELECT count(*) FROM vocab) AS vocab_size
FROM (SELECT term FROM vocab ORDER BY term LIMIT 50)
"""
    q["tfidf_weights"] = f"""
WITH {_corpus()},{_VOCAB},{_WEIGHTS}
SELECT doc_id, idx, term, round(weight, {R}) AS weight FROM weights
"""
    bench = _corpus("benchmark", "item_id", "").replace("toks", "btoks").replace(
        "counts", "bcounts").replace("nd AS", "bnd AS")
    q["tfidf_transform"] = f"""
WITH {_corpus()},{_VOCAB},{bench},
braw AS (
  SELECT c.doc_id, v.idx, v.term, c.tf * v.idf AS w FROM bcounts c JOIN vocab v USING (term)
)
SELECT doc_id AS item_id, idx, term,
       round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), {R}) AS weight
FROM braw
"""
    q["model_summary"] = f"""
WITH {_corpus()},{_VOCAB}
SELECT CAST(least(34, (SELECT n FROM nd)) AS INTEGER) AS n_centroids,
       CAST(least(300, (SELECT n FROM nd) - 1, (SELECT count(*) FROM vocab) - 1) AS INTEGER) AS dims
"""
    q["matrix_shape"] = f"""
WITH {_corpus()},{_VOCAB},{_WEIGHTS}
SELECT (SELECT n FROM nd) AS n_rows, count(DISTINCT idx) AS n_cols_used, count(*) AS nnz
FROM weights
"""
    q["topic_terms"] = _topic_sql(15, False)
    q["topic_weights"] = _topic_sql(30, True)
    q.update(vector_oracles())
    q.update(page_oracles())
    q.update(misc_oracles())
    return q


_EMB = """
e AS (SELECT vec_id, label AS cluster, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ex AS (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
cent AS (
  SELECT cluster, list(m ORDER BY i) AS c
  FROM (SELECT cluster, i, avg(x) AS m FROM ex GROUP BY cluster, i) GROUP BY cluster
),
dist AS (
  SELECT e.vec_id, cent.cluster, list_distance(e.v, cent.c) AS d FROM e, cent
),
assign AS (
  SELECT vec_id, cluster, d * d AS dist2 FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS rn FROM dist
  ) WHERE rn = 1
)"""

_SIL = """
e AS (SELECT vec_id, label AS cluster, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
sz AS (SELECT cluster, count(*) AS n FROM e GROUP BY cluster),
pd AS (
  SELECT a.vec_id, a.cluster AS own, b.cluster AS other, sum(list_distance(a.v, b.v)) AS s
  FROM e a, e b WHERE a.vec_id <> b.vec_id GROUP BY a.vec_id, a.cluster, b.cluster
),
pp AS (
  SELECT vec_id, own AS cluster,
         max(CASE WHEN other = own THEN s / (n - 1) END) AS a,
         min(CASE WHEN other <> own THEN s / n END) AS b,
         max(CASE WHEN other = own THEN n END) AS n_own
  FROM pd JOIN sz ON sz.cluster = pd.other GROUP BY vec_id, own
),
ss AS (
  SELECT vec_id, cluster,
         CASE WHEN n_own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0 END AS s
  FROM pp
)"""


#: Silhouette CTEs over ``label3(vec_id, cluster, v)``.
_SIL_OF = _SIL.replace("e AS (SELECT vec_id, label AS cluster, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
                       "e AS (SELECT vec_id, cluster, v FROM label3)")


def _lloyd_sql(k: int, steps: int) -> str:
    """CTEs ``label0`` .. ``label<steps>`` (vec_id, cluster, v, d): Lloyd steps
    from the first ``k`` points by md5 of the id; a centroid that loses all
    its points stays where it is."""
    out = f"""
p AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
cent0 AS (SELECT row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1 AS cluster, v AS c FROM p
          QUALIFY cluster < {k})"""
    for i in range(steps + 1):
        out += f""",
label{i} AS (SELECT vec_id, cluster, v, d FROM (
  SELECT vec_id, cluster, v, list_distance(v, c) AS d,
         row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(v, c), cluster) AS rn FROM p, cent{i}) WHERE rn = 1)"""
        if i < steps:
            out += f""",
mean{i} AS (SELECT cluster, list(m ORDER BY i) AS c FROM (
  SELECT cluster, i, avg(x) AS m FROM (
    SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM label{i}) GROUP BY cluster, i) GROUP BY cluster),
cent{i + 1} AS (SELECT cluster, coalesce(mean{i}.c, cent{i}.c) AS c FROM cent{i} LEFT JOIN mean{i} USING (cluster))"""
    return out


def _dbscan_sql(eps: float, min_samples: int) -> str:
    return f"""
WITH RECURSIVE
e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
nb AS (SELECT a.id AS i, b.id AS j FROM e a, e b WHERE list_distance(a.v, b.v) <= {eps}),
core AS (SELECT i AS id FROM nb GROUP BY i HAVING count(*) >= {min_samples}),
ce AS (SELECT nb.i, nb.j FROM nb JOIN core c1 ON nb.i = c1.id JOIN core c2 ON nb.j = c2.id),
r(i, j) AS (SELECT i, j FROM ce UNION SELECT r.i, ce.j FROM r JOIN ce ON r.j = ce.i),
comp AS (SELECT i AS id, min(j) AS root FROM r GROUP BY i),
num AS (
  SELECT root, CAST(row_number() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster
  FROM (SELECT DISTINCT root FROM comp)
),
corelab AS (SELECT comp.id, num.cluster FROM comp JOIN num USING (root)),
border AS (
  SELECT nb.i AS id, min(cl.cluster) AS cluster FROM nb JOIN corelab cl ON nb.j = cl.id
  WHERE nb.i NOT IN (SELECT id FROM core) GROUP BY nb.i
),
labels AS (
  SELECT e.id AS vec_id, CAST(coalesce(corelab.cluster, border.cluster, -1) AS INTEGER) AS cluster
  FROM e LEFT JOIN corelab USING (id) LEFT JOIN border USING (id)
)"""


def _sil_bounds_sql(cells: str) -> str:
    """Bounds of the silhouette from all pairs: mean squared and fourth-power
    distances to the other members of a cell, and the distance to its mean."""
    return f"""{_EMB},
cell AS ({cells}),
f AS (SELECT e.vec_id, e.cluster, cell.cell, e.v FROM e JOIN cell USING (vec_id)),
fx AS (SELECT cluster, cell, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM f),
fm AS (
  SELECT cluster, cell, list(m ORDER BY i) AS c
  FROM (SELECT cluster, cell, i, avg(x) AS m FROM fx GROUP BY cluster, cell, i) GROUP BY cluster, cell
),
fsz AS (SELECT cluster, cell, count(*) AS n FROM f GROUP BY cluster, cell),
pw AS (
  SELECT a.vec_id, a.cluster AS own, b.cluster AS other, b.cell, count(*) AS k,
         avg(power(list_distance(a.v, b.v), 2)) AS e2, avg(power(list_distance(a.v, b.v), 4)) AS e4,
         any_value(a.v) AS v
  FROM f a JOIN f b ON a.vec_id <> b.vec_id GROUP BY a.vec_id, a.cluster, b.cluster, b.cell
),
pb AS (
  SELECT vec_id, own, other, sum(k) AS k, sum(k * sqrt(e2)) AS high,
         sum(k * least(sqrt(e2), greatest(CASE WHEN e4 > 0 THEN e2 * sqrt(e2) / sqrt(e4) ELSE 0 END,
                                          list_distance(v, c) * n / k))) AS low
  FROM pw JOIN fm ON fm.cluster = other AND fm.cell = pw.cell JOIN fsz ON fsz.cluster = other AND fsz.cell = pw.cell
  GROUP BY vec_id, own, other
),
ab AS (
  SELECT vec_id, own AS cluster, max(CASE WHEN other = own THEN low / k END) AS a_low,
         max(CASE WHEN other = own THEN high / k END) AS a_high,
         min(CASE WHEN other <> own THEN low / k END) AS b_low, min(CASE WHEN other <> own THEN high / k END) AS b_high
  FROM pb GROUP BY vec_id, own
),
sb AS (
  SELECT cluster,
         CASE WHEN a_low IS NOT NULL AND greatest(a_high, b_low) > 0 THEN (b_low - a_high) / greatest(a_high, b_low) ELSE 0.0 END AS s_low,
         CASE WHEN a_low IS NOT NULL AND greatest(a_low, b_high) > 0 THEN (b_high - a_low) / greatest(a_low, b_high) ELSE 0.0 END AS s_high
  FROM ab
)"""


def vector_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    bounds = f"count(*) AS n_points, round(avg(s_low), {R}) AS silhouette_low, round(avg(s_high), {R}) AS silhouette_high FROM sb"
    q["silhouette_bounds"] = f"WITH {_sil_bounds_sql('SELECT vec_id, 0 AS cell FROM e')}\nSELECT {bounds}"
    q["silhouette_bounds_by_cluster"] = (f"WITH {_sil_bounds_sql('SELECT vec_id, cluster AS cell FROM assign')}\n"
                                         f"SELECT CAST(cluster AS INTEGER) AS cluster, {bounds} GROUP BY cluster")
    q["nearest_centroid"] = f"WITH {_EMB}\nSELECT vec_id, CAST(cluster AS INTEGER) AS cluster FROM assign"
    q["cluster_sizes"] = f"WITH {_EMB}\nSELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n_points FROM assign GROUP BY cluster"
    q["inertia"] = f"WITH {_EMB}\nSELECT count(*) AS n_points, round(sum(dist2), {R}) AS inertia FROM assign"
    q["silhouette_exact"] = f"WITH {_SIL}\nSELECT count(*) AS n_points, round(avg(s), {R}) AS silhouette FROM ss"
    q["silhouette_by_cluster"] = (f"WITH {_SIL}\nSELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n_points, "
                                  f"round(avg(s), {R}) AS silhouette FROM ss GROUP BY cluster")
    q["silhouette_sq_euclidean"] = f"""
WITH e AS (SELECT vec_id, label AS cluster, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
sz AS (SELECT cluster, count(*) AS n FROM e GROUP BY cluster),
pd AS (
  SELECT a.vec_id, a.cluster AS own, b.cluster AS other,
         sum(list_distance(a.v, b.v) * list_distance(a.v, b.v)) AS s
  FROM e a, e b WHERE a.vec_id <> b.vec_id GROUP BY a.vec_id, a.cluster, b.cluster
),
pp AS (
  SELECT vec_id, max(CASE WHEN other = own THEN s / (n - 1) END) AS a,
         min(CASE WHEN other <> own THEN s / n END) AS b, max(CASE WHEN other = own THEN n END) AS n_own
  FROM pd JOIN sz ON sz.cluster = pd.other GROUP BY vec_id
)
SELECT count(*) AS n_points,
       round(avg(CASE WHEN n_own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0 END), {R})
       AS silhouette
FROM pp
"""
    db = _dbscan_sql(1.15, 5)
    q["dbscan_labels"] = f"{db}\nSELECT vec_id, cluster FROM labels"
    q["dbscan_sizes"] = f"{db}\nSELECT cluster, count(*) AS n_points FROM labels GROUP BY cluster"
    q["dbscan_summary"] = (f"{db}\nSELECT count(DISTINCT CASE WHEN cluster >= 0 THEN cluster END) AS n_clusters, "
                           "CAST(sum(CASE WHEN cluster = -1 THEN 1 ELSE 0 END) AS BIGINT) AS n_noise, "
                           "count(*) AS n_points FROM labels")
    return q


def _route_sql() -> str:
    case = " ".join(f"WHEN contains(host, {_q(k)}) THEN {_q(k)}" for k in EXAMPLE_KEYS)
    return f"""
p0 AS (
  SELECT page_id, url, html, regexp_extract(url, {_q(NETLOC)}, 1) AS host,
         regexp_replace(regexp_extract(url, {_q(PATH)}, 1), ';[^/]*$', '') AS path
  FROM pages
),
p1 AS (
  SELECT *, CASE {case} END AS site_key,
         regexp_replace(regexp_replace(path, '^/+|/+$', '', 'g'), '/', '_', 'g') AS c0
  FROM p0
),
routed AS (
  SELECT page_id, url, html, site_key,
         CASE WHEN c1 LIKE '%.htm' OR c1 LIKE '%.html' THEN split_part(c1, '.', 1) ELSE c1 END AS category
  FROM (SELECT *, CASE WHEN c0 = '' THEN 'trang-chu' ELSE c0 END AS c1 FROM p1)
  WHERE site_key IS NOT NULL
),
links AS (
  SELECT page_id, site_key, category, 0 AS selector_ix,
         CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS pos, unnest(hrefs) AS href,
         regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin
  FROM (SELECT *, regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1),
                                     '<a href="([^"]*)"', 1) AS hrefs FROM routed)
),
rlinks AS (SELECT *, origin || href AS link FROM links),
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY page_id, link ORDER BY selector_ix, pos) AS r FROM rlinks
  ) WHERE r = 1
),
langs AS (SELECT *, split_part(category, '_', 1) AS language FROM firsts),
fresh AS (
  SELECT f.* FROM langs f
  WHERE NOT EXISTS (SELECT 1 FROM langs s WHERE s.site_key = f.site_key AND s.language = f.language
                    AND s.link = f.link AND length(s.link) % 2 = 0)
)"""


def _taken(name: str, links: str, cap: int) -> str:
    """CTE ``name(page_id, picks)``: what each page takes, page after page of
    a (site, language), skipping what the pages before it took."""
    return f"""
{name}_pages AS (
  SELECT site_key, language, page_id, list(link ORDER BY selector_ix, pos) AS all_links,
         row_number() OVER (PARTITION BY site_key, language ORDER BY page_id) AS n
  FROM {links} GROUP BY site_key, language, page_id
),
{name}(site_key, language, n, page_id, picks, taken) AS (
  SELECT site_key, language, n, page_id, all_links[1:{cap}], all_links[1:{cap}] FROM {name}_pages WHERE n = 1
  UNION ALL
  SELECT site_key, language, n, page_id, picks, list_concat(taken, picks) FROM (
    SELECT p.site_key, p.language, p.n, p.page_id, r.taken,
           list_filter(p.all_links, lambda x: NOT list_contains(r.taken, x))[1:{cap}] AS picks
    FROM {name} r JOIN {name}_pages p ON p.site_key = r.site_key AND p.language = r.language AND p.n = r.n + 1)
)"""


def page_oracles() -> dict[str, str]:
    r = _route_sql()
    q: dict[str, str] = {}
    q["page_site"] = f"WITH {r}\nSELECT page_id, site_key, category FROM routed"
    q["page_links"] = f"WITH {r}\nSELECT page_id, CAST(selector_ix AS INTEGER) AS selector_ix, pos, href, link FROM rlinks"
    q["page_links_distinct"] = (f"WITH {r}\nSELECT page_id, link, CAST(selector_ix AS INTEGER) AS selector_ix, pos "
                                "FROM firsts")
    q["new_links"] = q["known_links"] = f"WITH {r}\nSELECT page_id, link FROM fresh"
    q["capped_links"] = f"""WITH RECURSIVE {r},{_taken('cap1', 'fresh', 3)}
SELECT page_id, unnest(picks) AS link, CAST(generate_subscripts(picks, 1) AS INTEGER) AS rank FROM cap1
"""
    q["page_rejects"] = f"WITH {r}\nSELECT 'no_content' AS reason, count(*) AS n_pages FROM routed"
    q["site_pages"] = f"""WITH {r}, d(site_key, ord, name) AS (VALUES ('blog', 0, 'Blog pages'),
  ('example.com', 1, 'Example COM'), ('example.net', 2, 'Example NET'), ('example.org', 3, 'Example ORG'))
SELECT site_key, ord, name, (SELECT count(*) FROM routed s WHERE s.site_key = d.site_key) AS n_pages FROM d
"""
    q["stored_articles"] = f"""WITH RECURSIVE {r},
source AS (SELECT link, min(page_id) AS src FROM firsts GROUP BY link),
links1 AS (SELECT page_id, site_key, category AS language, selector_ix, pos, link FROM firsts),{_taken('run1', 'links1', 3)},
store1 AS (SELECT DISTINCT site_key, language, link FROM (SELECT site_key, language, unnest(picks) AS link FROM run1)
           JOIN source USING (link)),
links2 AS (SELECT * FROM links1 WHERE (site_key, language, link) NOT IN (SELECT site_key, language, link FROM store1)),
{_taken('run2', 'links2', 3)},
store2 AS (SELECT DISTINCT site_key, language, link FROM (SELECT site_key, language, unnest(picks) AS link FROM run2)
           JOIN source USING (link))
SELECT link AS url, site_key, language AS category FROM (SELECT * FROM store1 UNION ALL SELECT * FROM store2)
"""
    unesc = _unescape("regexp_extract(html, '<article><h1>(.*?)</h1>', 1)")
    ws = WS
    q["page_titles"] = (f"WITH {r}\nSELECT page_id, regexp_replace({unesc}, {_q('^[' + ws + ']+|[' + ws + ']+$')}, '', 'g') "
                        "AS title FROM routed")
    # Element text = its text nodes, each stripped, glued together.
    # On these pages that is: drop tags with the whitespace around them, trim.
    def text_of(e):
        e = f"regexp_replace({e}, {_q('[' + ws + ']*<[^>]*>[' + ws + ']*')}, '', 'g')"
        e = f"regexp_replace({e}, {_q('^[' + ws + ']+|[' + ws + ']+$')}, '', 'g')"
        return _unescape(e)
    # a <p> that isn't closed stays open to the end of the article and holds
    # all that follows, as no tag is closed implicitly
    para = ("CASE WHEN contains(piece, '</p>') THEN " + text_of(f"regexp_replace(piece, {_q('(?s)</p>.*$')}, '')")
            + " ELSE " + text_of("rest") + " END")
    desc = text_of("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")
    title = text_of("regexp_extract(html, '(?s)<article><h1>(.*?)</h1>', 1)")
    q["page_articles"] = f"""WITH {r},
arts AS (
  SELECT page_id, url, site_key, category, {title} AS title,
         CASE WHEN site_key = 'example.com' THEN '' ELSE {desc} END AS description,
         regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body
  FROM routed
),
pieces AS (
  SELECT page_id, i, parts[i] AS piece, array_to_string(parts[i:], '<p>') AS rest
  FROM (SELECT page_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT page_id, string_split(body, '<p>') AS parts FROM arts))
),
paras AS (SELECT page_id, i, {para} AS txt FROM pieces WHERE i > 1),
content AS (SELECT page_id, string_agg(txt, chr(10) ORDER BY i) AS content FROM paras GROUP BY page_id)
SELECT a.page_id, a.url, a.site_key, a.category, a.title, a.description, c.content
FROM arts a JOIN content c USING (page_id) WHERE c.content <> ''
"""
    return q


def _unescape(e: str) -> str:
    """Single-pass HTML unescaping of the entities these pages use; the
    legacy names are also recognised without the closing ';', as HTML
    parsers do (``&amp`` -> ``&``).  ``&amp`` goes last so ``&amp;lt;``
    stays ``&lt;``."""
    for a, b in (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;", "'"), ("&amp;?", "&")):
        e = f"regexp_replace({e}, {_q(a)}, {_q(b)}, 'g')"
    return e


#: Forward and backward sums over the lattice of runs of 1 .. 4 tokens, as
#: logarithms: lists that grow by one position a step (after three fillers).
_LATTICE = """
sizes AS (SELECT doc_id, CAST(len(tokens) AS INT) AS n FROM toks_kept),
runs AS (
  SELECT k.doc_id, CAST(s.s AS INT) AS s, l.l, array_to_string(k.tokens[s.s + 1 : s.s + l.l], ' ') AS term
  FROM toks_kept k, LATERAL (SELECT unnest(range(len(k.tokens))) AS s) s, (VALUES (1), (2), (3), (4)) l(l)
  WHERE s.s + l.l <= len(k.tokens)
),
lex AS (SELECT term, l, count(*) AS c FROM runs GROUP BY term, l HAVING l = 1 OR count(*) >= 5),
edges AS (
  SELECT r.doc_id, r.s, r.s + r.l AS t, r.l, r.term, x.c / (SELECT sum(c) FROM lex) AS p
  FROM runs r JOIN lex x ON x.term = r.term AND x.l = r.l
),
""" + ",".join(f"""
{name}_at AS (
  SELECT doc_id, {at} AS i, {{'p1': coalesce(max(p) FILTER (l = 1), 0), 'p2': coalesce(max(p) FILTER (l = 2), 0),
         'p3': coalesce(max(p) FILTER (l = 3), 0), 'p4': coalesce(max(p) FILTER (l = 4), 0),
         'g': CAST([] AS DOUBLE[])}} AS step
  FROM edges GROUP BY doc_id, {at}
),
{name} AS (
  SELECT doc_id, list_reduce(
    list_prepend({{'p1': 0::DOUBLE, 'p2': 0::DOUBLE, 'p3': 0::DOUBLE, 'p4': 0::DOUBLE,
                  'g': CAST(['-inf', '-inf', '-inf', '0'] AS DOUBLE[])}}, list(step ORDER BY i {order})),
    lambda x, y: {{'p1': y.p1, 'p2': y.p2, 'p3': y.p3, 'p4': y.p4,
      'g': list_append(x.g, x.g[-1] + ln(y.p1 + y.p2 * exp(x.g[-2] - x.g[-1]) + y.p3 * exp(x.g[-3] - x.g[-1])
                                         + y.p4 * exp(x.g[-4] - x.g[-1])))}}).g AS g
  FROM {name}_at GROUP BY doc_id
)""" for name, at, order in (("fwd", "t", "ASC"), ("bwd", "s", "DESC")))

_PHRASES = """
uni AS (SELECT term AS t, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY term),
nterms AS (SELECT count(*) AS n FROM uni),
pos_toks AS (
  SELECT doc_id, CAST(generate_subscripts(tokens, 1) - 1 AS BIGINT) AS pos, unnest(tokens) AS tok
  FROM toks_kept
),
adj AS (
  SELECT doc_id, pos, tok AS a, lead(tok) OVER (PARTITION BY doc_id ORDER BY pos) AS b FROM pos_toks
),
pc AS (SELECT a, b, count(*) AS n_ab FROM adj WHERE b IS NOT NULL GROUP BY a, b HAVING count(*) >= 5),
phr AS (
  SELECT pc.a, pc.b, pc.n_ab, (pc.n_ab - 5) * CAST(nterms.n AS DOUBLE) / (ua.n * ub.n) AS score
  FROM pc JOIN uni ua ON ua.t = pc.a JOIN uni ub ON ub.t = pc.b, nterms
  WHERE (pc.n_ab - 5) * CAST(nterms.n AS DOUBLE) / (ua.n * ub.n) > 10.0
)"""


def misc_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    cols = ["text", "lang", "source", "n_chars", "quality", "toxic"]
    nulls = ", ".join(f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_{c}" for c in cols)
    q["null_profile"] = f"SELECT count(*) AS n_rows, {nulls} FROM documents LEFT JOIN labels USING (doc_id)"
    proc = f"""
proc AS (
  SELECT doc_id, processed_content FROM (
    SELECT doc_id, array_to_string({tokens_sql('text')}, ' ') AS processed_content FROM documents
  ) WHERE length(regexp_replace(processed_content, {_q(f'[{WS}]+')}, '', 'g')) > 0
)"""
    rows = "(SELECT count(*) FROM documents) + (SELECT count(*) FROM labels)"
    q["blank_filter_stats"] = (f"WITH {proc}\nSELECT {rows} AS n_before, count(*) AS n_after, "
                               f"{rows} - count(*) AS n_removed FROM proc")
    q["processed_table"] = f"WITH {proc}\nSELECT doc_id, processed_content FROM proc"
    q["labelled_audit"] = (f"WITH {proc}\nSELECT count(*) AS n_docs, count(*) AS n_labelled, CAST(0 AS BIGINT) AS n_misassigned, "
                           "CAST(0 AS BIGINT) AS n_off_unit FROM proc")
    q["stored_pipeline"] = "\nUNION ALL\n".join(
        f"SELECT '{src}' AS input, count(*) AS n_labelled, CAST(0 AS BIGINT) AS n_changed, CAST(0 AS BIGINT) AS n_misassigned "
        f"FROM (WITH {_corpus(src, key, '')} SELECT doc_id FROM toks_kept)" for src, key in (("documents", "doc_id"), ("benchmark", "item_id")))
    q["article_csv"] = "SELECT 'https://example.org/' || doc_id AS url, source AS title, text AS content FROM documents"
    q["stopword_file"] = f"""WITH {_corpus(extra='')}
SELECT term FROM (SELECT term, CAST(sum(tf) AS BIGINT) AS tf FROM counts GROUP BY term) ORDER BY tf DESC, term LIMIT 20
"""
    q["load_or_train"] = ("SELECT count(*) AS n_points, false AS first_loaded, true AS second_loaded, "
                          "false AS other_loaded, true AS same_centers, 5 AS n_centroids FROM embeddings")
    for k in range(2, 6):
        steps = _lloyd_sql(k, 3)
        if k == 5:
            q["kmeans_given"] = f"WITH {steps}\nSELECT vec_id, CAST(cluster AS INTEGER) AS cluster FROM label3"
    sweep = "\nUNION ALL\n".join(
        f"SELECT * FROM (WITH {_lloyd_sql(k, 3)},{_SIL_OF}\nSELECT {k} AS k, round((SELECT sum(d * d) FROM label3), {R}) AS inertia, "
        f"round(avg(s), {R}) AS silhouette FROM ss)" for k in range(2, 6))
    q["k_sweep_given"] = sweep
    q["best_k_given"] = f"SELECT * FROM ({sweep}) ORDER BY silhouette DESC, k LIMIT 1"
    q["silhouette_sampled"] = (
        "WITH " + _SIL.strip().replace("FROM embeddings)", "FROM embeddings ORDER BY md5('42:' || vec_id), vec_id LIMIT 300)", 1)
        + f"\nSELECT count(*) AS n_points, round(avg(s), {R}) AS silhouette FROM ss")
    q["alignment_check"] = f"""WITH {proc},
lk AS (SELECT DISTINCT doc_id FROM proc), rk AS (SELECT DISTINCT doc_id FROM labels)
SELECT (SELECT count(*) FROM lk WHERE doc_id NOT IN (SELECT doc_id FROM rk)) AS left_only,
       (SELECT count(*) FROM rk WHERE doc_id NOT IN (SELECT doc_id FROM lk)) AS right_only
"""
    q["preview"] = f"WITH {proc}\nSELECT doc_id, processed_content FROM proc ORDER BY doc_id LIMIT 5"
    q["stopword_tokens"] = f"""WITH {_corpus(extra='')},
sw AS (SELECT list(term) AS l FROM (
  SELECT term FROM (SELECT term, CAST(sum(tf) AS BIGINT) AS tf FROM counts GROUP BY term) ORDER BY tf DESC, term LIMIT 20)),
st AS (SELECT doc_id, list_filter(tokens, lambda x: NOT list_contains(sw.l, x)) AS t FROM toks, sw)
SELECT doc_id, array_to_string(t, ' ') AS processed_content FROM st WHERE len(t) > 0
"""
    q["word_counts"] = f"""WITH {_corpus(extra='')},{_LATTICE}
SELECT e.term, e.l AS n_tokens, round(sum(exp(a.g[e.s + 4] + ln(e.p) + b.g[n.n - e.t + 4] - a.g[n.n + 4])), {R}) AS expected
FROM edges e JOIN sizes n USING (doc_id) JOIN fwd a USING (doc_id) JOIN bwd b USING (doc_id)
GROUP BY e.term, e.l"""
    q["phrase_scores"] = f"WITH {_corpus(extra='')},{_PHRASES}\nSELECT a, b, n_ab, round(score, {R}) AS score FROM phr"
    q["phrase_apply"] = f"""WITH {_corpus(extra='')},{_PHRASES},
starts AS (SELECT adj.doc_id, adj.pos FROM adj JOIN phr ON adj.a = phr.a AND adj.b = phr.b),
runs AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS grp FROM starts),
chosen AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, min(pos) OVER (PARTITION BY doc_id, grp) AS run0 FROM runs
  ) WHERE (pos - run0) % 2 = 0
),
marked AS (
  SELECT a.doc_id, a.pos,
         CASE WHEN c.pos IS NOT NULL THEN a.a || '_' || a.b ELSE a.a END AS tok,
         p.pos IS NOT NULL AS cont
  FROM adj a LEFT JOIN chosen c ON c.doc_id = a.doc_id AND c.pos = a.pos
             LEFT JOIN chosen p ON p.doc_id = a.doc_id AND p.pos + 1 = a.pos
)
SELECT doc_id, string_agg(tok, ' ' ORDER BY pos) AS processed_content
FROM marked WHERE NOT cont GROUP BY doc_id
"""
    return q
