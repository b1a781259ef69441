"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filters": OP2, "op3_ngram_join": OP3, "op9_substring_dedup": OP9, "op11_collocations": OP11}


_HOST = r"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"

OP2 = rf"""
WITH rules(r_rule, r_host, r_path, r_verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
labels(l_label) AS (VALUES ('spam-farm'), ('spam'), ('casino'), ('porn'), ('xxx'), ('torrent'), ('doorway'), ('adserver')),
p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path, url FROM pages),
j AS (SELECT p.*,
  (SELECT max_by({{'r': r_rule, 'v': r_verdict}}, length(r_rule)) FROM rules
    WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS hit,
  (SELECT max_by('label:' || l_label, length(l_label) * 100 + ascii(l_label)) FROM labels
    WHERE regexp_matches(host, '(^|[^a-z0-9])' || l_label || '([^a-z0-9]|$)')) AS lab,
  regexp_matches(host || path, '^[^/]*/([^/]*/)*(login|logout|signin|cart|checkout)(/|\.|$)') AS sess
  FROM p),
k AS (SELECT *, CASE WHEN hit IS NOT NULL THEN NULL
       WHEN lab IS NOT NULL AND (NOT sess OR length(lab) > 12) THEN lab
       WHEN sess THEN 'path:session' END AS pattern FROM j)
SELECT page_id, host, path, hit.r AS rule,
  CASE WHEN hit IS NOT NULL THEN hit.v WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, pattern
FROM k
"""

#: Words between blanks, tabs to carriage returns, of each row of documents.
_WORDS = r"""
SELECT row_number() OVER () AS r, doc_id,
       list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents"""

OP3 = f"""
WITH RECURSIVE d AS ({_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}),
g AS (SELECT DISTINCT r, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS gram
      FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n, md5(string_agg(gram, chr(10) ORDER BY gram)) AS kind FROM g GROUP BY r),
linked AS (SELECT a.r AS a, b.r AS b FROM g a JOIN g b ON a.gram = b.gram AND a.r <> b.r JOIN n x ON x.r = a.r JOIN n y ON y.r = b.r
           GROUP BY a.r, b.r, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(a, b) AS (SELECT r, r FROM n UNION SELECT reach.a, linked.b FROM reach JOIN linked ON linked.a = reach.b),
low AS (SELECT reach.a AS r, min(d.doc_id) AS least FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a),
links AS (SELECT a AS r, count(DISTINCT y.kind) AS k FROM linked JOIN n x ON x.r = a JOIN n y ON y.r = b
          WHERE x.kind <> y.kind GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.least, doc_id) AS component_id, coalesce(links.k, 0) AS n_links
FROM d LEFT JOIN n USING (r) LEFT JOIN low USING (r) LEFT JOIN links USING (r)
"""

OP9 = f"""
WITH d AS ({_WORDS.format(text="coalesce(text, '')")}),
w AS (SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)),
hit AS (SELECT r, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, i + k AS p FROM hit, unnest(range(0, 35)) t(k)),
kept AS (SELECT d.r, string_agg(ws[p], ' ' ORDER BY p) AS left_over, count(*) AS k
         FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS p FROM d) d WHERE (d.r, p) NOT IN (SELECT (r, p) FROM gone) GROUP BY d.r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(left_over, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP11 = r"""
WITH t AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT doc, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
ws AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
pos AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM ws),
g AS MATERIALIZED (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM pos, (VALUES (1), (2), (3)) v(k)
      WHERE i + k - 1 <= len(ws) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= 10),
halves AS MATERIALIZED (SELECT lang, k, phrase, f AS a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
           FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
cuts AS MATERIALIZED (SELECT h.lang, h.k, h.phrase, h.a, h.cut, x.f AS l, y.f AS r,
           CAST((1000000::HUGEINT * h.a * h.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
         FROM halves h JOIN g x ON x.lang = h.lang AND x.phrase = h.head JOIN g y ON y.lang = h.lang AND y.phrase = h.tail),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, inner_phrase, max(f) AS f FROM (
             SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS inner_phrase FROM c WHERE k = 3)
           GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN longer ON longer.lang = low.lang AND inner_phrase = phrase
         WHERE longer.f IS NULL OR 100 * longer.f < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
