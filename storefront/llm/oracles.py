"""DuckDB SQL for those corpus queries that SQL can express."""

from __future__ import annotations

from .licenses import TEMPLATES

_VALUES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))
assert not any("'" in text for _, text in TEMPLATES)

OP1 = rf"""
WITH files AS (
  SELECT doc_id, concat_ws('/', source, lang, doc_id::VARCHAR) AS path, coalesce(text, '') AS t FROM documents),
placed AS (SELECT *, regexp_replace(path, '/[^/]*$', '') AS dir FROM files),
spoken AS (
  SELECT doc_id, dir, unit, u AS text, len(list_filter(regexp_split_to_array(t, '\s+'), lambda w: w <> '')) AS words
  FROM (SELECT doc_id, dir, t, unnest(us) AS u, unnest(range(len(us))) AS unit
        FROM (SELECT doc_id, dir, t, list_concat(list_concat(string_split(t, chr(10)),
                     list_filter(regexp_split_to_array(t, '\n[ \t\r\n]*\n'), lambda b: contains(b, chr(10)))),
                     CASE WHEN contains(t, chr(10)) THEN [t] ELSE [] END) AS us FROM placed))),
known(template, licence, text) AS (VALUES {_VALUES}),
sa AS (SELECT doc_id, unit, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS term FROM spoken),
sb AS (SELECT template, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS term FROM known),
n AS (SELECT count(*) AS n FROM known),
idf AS (SELECT term, ln((1 + (SELECT n FROM n))::DOUBLE / (1 + count(DISTINCT template))) + 1 AS idf FROM sb GROUP BY term),
wa AS (SELECT doc_id, unit, term, (1 + ln(count(*))) * any_value(coalesce(idf, ln((1 + (SELECT n FROM n))::DOUBLE) + 1)) AS w
       FROM sa LEFT JOIN idf USING (term) GROUP BY ALL),
wb AS (SELECT template, term, (1 + ln(count(*))) * any_value(idf) AS w FROM sb JOIN idf USING (term) GROUP BY ALL),
na AS (SELECT doc_id, unit, sqrt(sum(w * w)) AS norm FROM wa GROUP BY ALL),
nb AS (SELECT template, sqrt(sum(w * w)) AS norm FROM wb GROUP BY ALL),
cosines AS (
  SELECT wa.doc_id, wa.unit, wb.template, round(sum(wa.w / na.norm * wb.w / nb.norm), 6) AS cosine
  FROM wa JOIN wb USING (term) JOIN na USING (doc_id, unit) JOIN nb USING (template) GROUP BY ALL),
best AS (
  SELECT doc_id, licence, unit, cosine FROM cosines JOIN known USING (template) WHERE cosine >= 0.65
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, licence, unit) = 1),
own AS (
  SELECT s.doc_id, s.dir, b.licence, b.cosine,
         len(list_filter(regexp_split_to_array(s.text, '\s+'), lambda w: w <> '')) >= 0.5 * s.words AS is_file
  FROM spoken s JOIN best b USING (doc_id, unit)),
by_dir AS (
  SELECT dir AS above, licence, cosine FROM own WHERE is_file
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, licence) = 1),
found AS (
  SELECT d.dir, b.above, b.licence, b.cosine FROM (SELECT DISTINCT dir FROM placed) d
  JOIN by_dir b ON b.above = '' OR d.dir = b.above OR starts_with(d.dir, b.above || '/')
  QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(b.above) DESC) = 1)
SELECT p.doc_id, p.path, coalesce(o.licence, f.licence) AS licence,
       CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN f.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       coalesce(o.cosine, f.cosine) AS cosine,
       CASE WHEN o.licence IS NOT NULL THEN p.dir ELSE f.above END AS origin_dir
FROM placed p LEFT JOIN own o USING (doc_id) LEFT JOIN found f ON f.dir = p.dir
"""

#: Brute force over all pairs that share a shingle, then components by a recursive query.
OP6 = r"""
WITH RECURSIVE sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5
    THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents)),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS same
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs WHERE 100 * same >= 75 * (na + nb - same)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
FROM sets s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s
"""

ORACLES: dict[str, str] = {"op1_licenses": OP1, "op6_jaccard": OP6}
