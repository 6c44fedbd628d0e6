"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from riskframe.llm.license_dice import TEMPLATES, THRESHOLD

# Exact Jaccard on the shingles themselves; components by walking the links to the smallest id.
_OP10 = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\pL\\pM\\pN_]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)])
  WHEN len(w) > 0 THEN [array_to_string(w, ' ') || ' |' ] ELSE [] END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
rare AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
e2 AS (SELECT e.* FROM e SEMI JOIN rare USING (g)),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e2 a JOIN e2 b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
cls AS (SELECT a, min(least(a, b)) AS class_id FROM reach GROUP BY a),
sets AS (SELECT doc_id, list_sort(s) AS k FROM s WHERE len(s) > 0),
copies AS (SELECT doc_id, count(*) OVER (PARTITION BY k) AS n_copies, min(doc_id) OVER (PARTITION BY k) AS rep FROM sets),
deg AS (SELECT l.a, count(*) AS n_links, count(DISTINCT cb.rep) FILTER (WHERE cb.rep <> ca.rep) AS n_texts
  FROM links l JOIN copies ca ON l.a = ca.doc_id JOIN copies cb ON l.b = cb.doc_id GROUP BY l.a)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, coalesce(g.n_links, 0) AS n_links, coalesce(g.n_texts, 0) AS n_texts,
  coalesce(k.n_copies, 1) AS n_copies
FROM documents d LEFT JOIN cls c ON d.doc_id = c.a LEFT JOIN deg g ON d.doc_id = g.a LEFT JOIN copies k ON d.doc_id = k.doc_id
"""



def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Every unit against every template: no guard words, no size bounds.
_OP4 = f"""
WITH t AS (SELECT * FROM (VALUES {", ".join(f"({i}, {_literal(n)}, {_literal(x.lower())})" for i, (n, x) in enumerate(TEMPLATES))}) v(no, license, body)),
tw AS (SELECT no, license, regexp_extract_all(body, '[a-z0-9]+') AS w FROM t),
tg AS (SELECT no, license, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g FROM tw),
d AS (SELECT row_number() OVER () AS rid, doc_id, lower(text) AS x FROM documents WHERE text IS NOT NULL),
u AS (SELECT rid, doc_id, unnest(list_distinct(list_concat(string_split(x, chr(10)), regexp_split_to_array(x, '\\n\\s*\\n'), [x]))) AS u FROM d),
uw AS (SELECT rid, doc_id, u, regexp_extract_all(u, '[a-z0-9]+') AS w FROM u),
ug AS (SELECT rid, doc_id, u, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g FROM uw WHERE len(w) > 1),
ue AS (SELECT rid, doc_id, u, len(g) AS n, unnest(g) AS gram FROM ug),
te AS (SELECT no, license, len(g) AS n, unnest(g) AS gram FROM tg),
dice AS (SELECT rid, doc_id, u, no, license, 2 * count(*) / any_value(ue.n + te.n) AS dice FROM ue JOIN te USING (gram) GROUP BY rid, doc_id, u, no, license),
best AS (SELECT rid, doc_id, u, arg_max(struct_pack(l := license, d := dice), struct_pack(d := dice, f := -no)) AS b FROM dice WHERE dice >= {THRESHOLD} GROUP BY rid, doc_id, u)
SELECT doc_id, b.l AS license, round(max(b.d), 6) AS dice, count(*) AS n_units FROM best GROUP BY rid, doc_id, b.l
"""

# Exact cosine of all pairs in double precision; components by walking the links to the smallest id.
_OP9 = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
u AS (SELECT vec_id, e, sqrt(list_sum([x * x FOR x IN e])) AS n FROM v),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND a.n > 0 AND b.n > 0 AND len(a.e) = len(b.e)
  AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
cls AS (SELECT a, min(least(a, b)) AS c FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(deg.n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN cls ON vec_id = cls.a LEFT JOIN deg ON vec_id = deg.a
"""

# Every kept term in every group, every pair of groups of a language.
_OP11 = """
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
occ AS (SELECT rid, lang, source, unnest(regexp_extract_all(x, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
tot AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * v.v) AS p,
  1 + (1000000000::HUGEINT * (k.n + 2)) // (v.total + 2 * v.v) AS q
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN tot t ON t.lang = g.lang AND t.source = g.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM grid WHERE n > 0 AND p > q),
both_parts AS (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM both_parts QUALIFY part = 'pair' OR rank <= 10
"""


def _op12(rounds: int = 4) -> str:
    """Every part against every entry; vectors of one length that 4 divides."""
    steps = ["""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
c AS MATERIALIZED (SELECT rid, (j - 1) // (n // 4) AS k, (j - 1) % (n // 4) AS i, x FROM (SELECT rid, len(v) AS n, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM v)),
b0 AS MATERIALIZED (SELECT k, rid - 1 AS e, i, x FROM c WHERE rid <= 256)"""]
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS (SELECT c.rid, c.k, b.e, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d FROM c JOIN b{r} b ON c.k = b.k AND c.i = b.i GROUP BY c.rid, c.k, b.e),
a{r} AS MATERIALIZED (SELECT rid, k, min(struct_pack(d := d, e := e)) AS m FROM d{r} GROUP BY rid, k)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT c.k, a.m.e AS e, c.i, (sum(c.x)::BIGINT - (sum(c.x)::BIGINT % count(*) + count(*)) % count(*)) // count(*) AS x FROM c JOIN a{r} a ON c.rid = a.rid AND c.k = a.k GROUP BY c.k, a.m.e, c.i),
b{r + 1} AS MATERIALIZED (SELECT b.k, b.e, b.i, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN m{r} m ON b.k = m.k AND b.e = m.e AND b.i = m.i)""")
    last = f"""
coded AS (SELECT rid, string_agg(printf('%02x', m.e), '' ORDER BY k) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY k, e, i)) FROM b{rounds}) AS codebooks_sha256
FROM v JOIN coded USING (rid)
"""
    return ",".join([*steps, last])


ORACLE: dict[str, str] = {"op4_license_dice": _OP4, "op9_pq_near_duplicates": _OP9, "op10_chosen_path_join": _OP10,
                          "op11_packed_term_audit": _OP11, "op12_slice_codes": _op12()}
