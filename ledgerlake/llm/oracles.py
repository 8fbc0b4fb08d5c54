"""The same results in SQL, where SQL can express them.

Left out: greedy tilings, FP-growth, aligned licence templates, entropy windows, fitted rates and
encoded shards; tests hold those against plain computations.
"""

from __future__ import annotations

from ledgerlake.llm.centroid_clusters import Clustering
from ledgerlake.llm.part_codes import Coding
from ledgerlake.llm.quality_rules import BOILERPLATE, MENU_ITEMS, SEPARATORS, Limits

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"


def _texts(values: tuple[str, ...]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _quality(limits: Limits = Limits()) -> str:
    phrases = " OR ".join(f"contains(low, {_texts((p,))})" for p in BOILERPLATE)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
spots AS (SELECT rid, ws, unnest(range(1, len(ws) - {limits.window} + 2)) AS i FROM w WHERE len(ws) >= {limits.window}),
windows AS (SELECT rid, i, array_to_string(ws[i:i + {limits.window - 1}], ' ') AS k FROM spots),
often AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM windows) WHERE c > 1),
covered AS (SELECT DISTINCT rid, unnest(range(i, i + {limits.window})) AS p FROM often),
again AS (SELECT rid, count(*) AS n FROM covered GROUP BY rid),
parts AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (
  SELECT rid, line, regexp_extract_all(line, '{_WORD}') AS ws, regexp_replace(line, '{_SPACE}', '', 'g') AS body,
         translate(line, '{_UPPER}', '{_LOWER}') AS low
  FROM parts WHERE regexp_matches(line, '{_WORD}')
),
judged AS (
  SELECT *, length(body) AS chars, len(list_filter(ws, lambda x: x IN ({_texts(SEPARATORS)}))) AS bare,
         length(regexp_replace(body, '[^#*$%&|<>!{{}}\[\]~^\\]', '', 'g')) AS symbols
  FROM lines
),
flagged AS (
  SELECT *, 100 * symbols > {limits.symbol_pct} * chars
      OR (bare >= {limits.separators} AND 100 * bare >= {limits.separator_pct} * len(ws))
      OR regexp_replace(low, '^{_SPACE}+|{_SPACE}+$', '', 'g') IN ({_texts(MENU_ITEMS)})
      OR {phrases} AS fails
  FROM judged
),
per_text AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (fails) AS n_failed_lines,
         coalesce(sum(chars) FILTER (fails), 0) AS failed_chars
  FROM flagged GROUP BY rid
),
figures AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(again.n, 0)::BIGINT AS n_repeat_words,
         coalesce(n_failed_lines, 0)::BIGINT AS n_failed_lines, coalesce(failed_chars, 0)::BIGINT AS failed_chars
  FROM w LEFT JOIN again USING (rid) LEFT JOIN per_text USING (rid)
),
based AS (
  SELECT *, n_words < {limits.least_words} OR 100 * n_repeat_words > {limits.most_repeated_pct} * n_words AS base_failed
  FROM figures
)
SELECT *, NOT base_failed AND 100 * failed_chars <= {limits.most_removed_pct} * word_chars AS kept FROM based
"""


_LINES = rf"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents WHERE text IS NOT NULL
),
sets AS (
  SELECT doc_id, line_no, list_distinct(regexp_extract_all(translate(line, '{_UPPER}', '{_LOWER}'), '{_WORD}')) AS ws
  FROM parts WHERE regexp_matches(line, '{_WORD}')
),
placed AS (SELECT doc_id, line_no, len(ws) AS n, unnest(ws) AS word FROM sets),
spread AS (SELECT word, count(*) AS f FROM placed GROUP BY word),
ranked AS (
  SELECT doc_id, line_no, n, word, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY f, word) AS r
  FROM placed JOIN spread USING (word)
),
firsts AS (SELECT doc_id, line_no, n, word FROM ranked WHERE r <= n - ceil(0.8 * n - 1e-9) + 1),
pairs AS (
  SELECT DISTINCT a.doc_id AS da, a.line_no AS la, b.doc_id AS db, b.line_no AS lb
  FROM firsts a JOIN firsts b ON a.word = b.word AND (a.doc_id, a.line_no) < (b.doc_id, b.line_no)
   AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
),
shared AS (
  SELECT db, lb, len(list_intersect(x.ws, y.ws)) AS c, len(x.ws) + len(y.ws) AS s
  FROM pairs JOIN sets x ON x.doc_id = da AND x.line_no = la JOIN sets y ON y.doc_id = db AND y.line_no = lb
),
gone AS (SELECT DISTINCT db AS doc_id, lb AS line_no FROM shared WHERE 180 * c >= 80 * s),
lists AS (SELECT doc_id, list(line_no::INTEGER ORDER BY line_no) AS removed FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::INTEGER AS n_lines, coalesce(len(removed), 0)::INTEGER AS n_removed,
       coalesce(removed, CAST([] AS INTEGER[])) AS removed_lines
FROM documents LEFT JOIN lists USING (doc_id)
"""

_ARCHIVES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
r AS (SELECT sha1(h) AS d, max(page_id) AS keeper FROM p WHERE strlen(h) >= 1000 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM p LEFT JOIN r ON sha1(h) = d AND strlen(h) >= 1000
"""

_COMPONENTS = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM documents
),
spots AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0),
grams AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g FROM spots),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
commons AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM commons JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.other
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least.m AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY 1) AS least USING (doc_id)
"""



def _finite(scale: int, more: str = "true") -> str:
    """Kept rows of embeddings, numbered, with their integer vectors."""
    return f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, *, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND {more} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""


def _clusters(how: Clustering = Clustering()) -> str:
    gap = f"list_sum(list_transform(range(1, {how.size + 1}), lambda i: (kept.v[i] - c.v[i]) * (kept.v[i] - c.v[i])))"
    steps = []
    for n in range(how.rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT rid, arg_min(struct_pack(k := c.k, d := {gap}), struct_pack(d := {gap}, k := c.k)) AS best FROM kept, c{n} c GROUP BY rid
)""")
        if n < how.rounds:
            steps.append(f"""s{n} AS (
  SELECT best.k AS k, j, CAST(floor(sum(v[j]) / count(*)) AS BIGINT) AS m FROM a{n} JOIN kept USING (rid), range(1, {how.size + 1}) t(j) GROUP BY 1, 2
),
c{n + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN (SELECT k, list(m ORDER BY j) AS v FROM s{n} GROUP BY k) m USING (k)
)""")
    return f"""
WITH {_finite(how.scale, f"len(embedding) = {how.size}")},
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v FROM (
    SELECT sha256('{how.seed}' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {how.clusters}
  )
),
{", ".join(steps)},
done AS (SELECT vec_id, best.k AS k, best.d AS d FROM a{how.rounds} JOIN kept USING (rid))
SELECT vec_id, done.k::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY done.k))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{how.rounds}.v, ',')) AS centroid_sha256
FROM done JOIN c{how.rounds} ON c{how.rounds}.k = done.k
"""


def _codes(how: Coding = Coding()) -> str:
    steps = []
    for n in range(how.rounds + 1):
        steps.append(f"""d{n} AS (
  SELECT u.rid, u.p, c.e, list_sum(list_transform(range(1, len(u.x) + 1), lambda i: (u.x[i] - c.x[i]) * (u.x[i] - c.x[i]))) AS d
  FROM parts u JOIN c{n} c ON c.p = u.p
),
a{n} AS MATERIALIZED (SELECT rid, p, arg_min(e, struct_pack(d := d, e := e)) AS e, min(d) AS d FROM d{n} GROUP BY 1, 2)""")
        if n < how.rounds:
            steps.append(f"""s{n} AS (
  SELECT p, e, j, CAST(floor(sum(x[j]) / count(*)) AS BIGINT) AS m
  FROM a{n} JOIN parts USING (rid, p), (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS j) GROUP BY 1, 2, 3
),
c{n + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.x, c.x) AS x
  FROM c{n} c LEFT JOIN (SELECT p, e, list(m ORDER BY j) AS x FROM s{n} GROUP BY 1, 2) m ON m.p = c.p AND m.e = c.e
)""")
    return f"""
WITH {_finite(how.scale)},
parts AS MATERIALIZED (
  SELECT rid, vec_id, label, p, v[p * len(v) // {how.parts} + 1:(p + 1) * len(v) // {how.parts}] AS x FROM kept, range({how.parts}) t(p)
),
c0 AS MATERIALIZED (
  SELECT p, e, x FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id NULLS LAST, rid) - 1 AS e FROM parts) WHERE e < {how.entries}
),
{", ".join(steps)},
codes AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d) AS error FROM a{how.rounds} GROUP BY rid),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM c{how.rounds})
SELECT vec_id, code, error::BIGINT AS error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM codes JOIN kept USING (rid), digest
"""


ORACLES: dict[str, str] = {
    "op1_line_dedup": _LINES,
    "op2_quality_rules": _quality(),
    "op5_warc": _ARCHIVES,
    "op9_ngram_join": _COMPONENTS,
    "op12_centroid_clusters": _clusters(),
    "op13_part_codes": _codes(),
}
