"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""

LINE_DEDUP = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
d AS (
  SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS dropped FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""

SUBSTRING_DEDUP = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS p, w FROM t WHERE len(w) >= 13),
h AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 12], ' ')) AS h FROM s),
r AS (
  SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first FROM h) WHERE doc_id > first),
c AS (
  SELECT DISTINCT doc_id, p + k AS i FROM r, range(13) AS x(k)),
w AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM t),
k AS (
  SELECT w.doc_id, count(*) AS kept, string_agg(word, ' ' ORDER BY w.i) AS text
  FROM w ANTI JOIN c ON w.doc_id = c.doc_id AND w.i = c.i GROUP BY w.doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(kept, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM t LEFT JOIN k ON t.doc_id = k.doc_id
"""

JACCARD_JOIN = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(w[p:p + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM t WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (
  SELECT u, v FROM o JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (
  SELECT doc_id, doc_id AS far FROM documents UNION SELECT r.doc_id, e.v FROM r JOIN e ON e.u = r.far)
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, min(far) AS component_id
FROM t JOIN r ON r.doc_id = t.doc_id LEFT JOIN n ON n.doc_id = t.doc_id GROUP BY t.doc_id, n
"""

#: The same with the number of links of each document.
JACCARD_LINKS = f"""
SELECT j.*, coalesce(k.n_links, 0) AS n_links FROM ({JACCARD_JOIN}) j LEFT JOIN (
  WITH t AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  s AS MATERIALIZED (
    SELECT DISTINCT doc_id, md5(array_to_string(w[p:p + 4], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM t WHERE len(w) > 0)),
  n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  o AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL)
  SELECT u AS doc_id, count(*) AS n_links FROM o JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
  WHERE 100 * c >= 75 * (x.n + y.n - c) GROUP BY u) k ON k.doc_id = j.doc_id
"""


def url_filter(rules: list[tuple[str, str, str]]) -> str:
    values = ", ".join(map(str, rules))
    return rf"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {values}),
p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
m AS (
  SELECT page_id, host, path, r_host, r_path, r_verdict
  FROM q LEFT JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)),
b AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(r_host) + length(r_path) DESC NULLS LAST) AS k FROM m)
SELECT page_id, host, path, r_host || r_path AS rule, coalesce(r_verdict, 'allow') AS verdict FROM b WHERE k = 1
"""

COLLOCATIONS = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                  'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
s AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 5) AS x(k) WHERE len(w) >= k),
f AS MATERIALIZED (
  SELECT lang, phrase, k, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM s) GROUP BY ALL),
n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (
  SELECT lang, phrase, string_split(phrase, ' ') AS w, k, f AS a FROM f WHERE k >= 2 AND f >= 30),
b AS (
  SELECT c.lang, c.phrase, c.k, c.a, x.j, array_to_string(c.w[1:x.j], ' ') AS first, array_to_string(c.w[x.j + 1:], ' ') AS rest
  FROM c, range(1, 4) AS x(j) WHERE x.j < c.k),
cuts AS (
  SELECT b.lang, b.phrase, b.k, b.a, b.j, lf.f AS l, rf.f AS r,
         CAST((CAST(2000000 AS HUGEINT) * b.a) // (lf.f + rf.f) AS BIGINT) AS score
  FROM b JOIN f lf ON lf.lang = b.lang AND lf.phrase = b.first JOIN f rf ON rf.lang = b.lang AND rf.phrase = b.rest),
low AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT c.lang, array_to_string(c.w[y.i:y.i + x.j - 1], ' ') AS phrase, max(c.a) AS longer
  FROM c, range(2, 4) AS x(j), range(1, 4) AS y(i) WHERE x.j < c.k AND y.i + x.j - 1 <= c.k GROUP BY ALL),
kept AS (
  SELECT low.* FROM low LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a),
top AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM top JOIN n USING (lang) WHERE rank <= 2000
"""
