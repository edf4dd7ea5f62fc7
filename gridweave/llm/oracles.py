"""DuckDB SQL for the queries of this subpackage that SQL can express: exact windows, base spans, cosines and their groups."""

from __future__ import annotations

from .op6_secrets import BASE, MORE

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WINDOWS = f"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents), b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id::VARCHAR AS item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS phrase FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT n FROM p), x AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, s WHERE len(w) >= n)),
h AS (SELECT doc_id, i, x.n, item FROM x JOIN p ON p.n = x.n AND p.phrase = x.phrase), c AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY 1),
k AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)"""


def _spans() -> str:
    parts = []
    for i, r in enumerate((*BASE, *MORE)):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"SELECT doc_id, {i} AS rank, '{r.kind}' AS kind, {r.least} AS least, regexp_split_to_array(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS hits, regexp_extract_all(t, '{pattern}', {r.group}) AS own FROM t")
    told = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank)"
    counts = ", ".join(f"count(*) FILTER (WHERE rank = {i}) AS n_{r.kind}" for i, r in enumerate(BASE))
    names = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS ({' UNION ALL '.join(parts)}),
u AS (SELECT doc_id, rank, kind, least, generate_subscripts(hits, 1) AS i, unnest(gaps[:len(hits)]) AS gap, unnest(hits) AS hit, unnest(own) AS own FROM m WHERE len(hits) > 0),
s AS (SELECT doc_id, rank, kind, length(own) >= least AS fine, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS b, length(hit) AS n FROM u),
f AS (SELECT doc_id, rank, kind, b - n AS a, b FROM s WHERE fine),
g AS (SELECT doc_id, {counts}, {told} FILTER (WHERE rank < {len(BASE)}) AS base, {told} AS spans FROM f GROUP BY 1)
SELECT doc_id, {names}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN g USING (doc_id)"""


COSINES = """WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings), ok AS (SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS n FROM v WHERE x IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND list_inner_product(x, x) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_inner_product(a.x, b.x) / (a.n * b.n) >= 0.9::DOUBLE),
r AS (SELECT a AS node, a AS low FROM e UNION SELECT e.b, r.low FROM r JOIN e ON e.a = r.node AND r.low < e.b)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(low, vec_id) AS component_id, coalesce(low, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM e GROUP BY 1) USING (vec_id) LEFT JOIN (SELECT node AS vec_id, min(low) AS low FROM r GROUP BY 1) USING (vec_id)"""

ORACLE_SQL = {"op2_fm_decontamination": WINDOWS, "op6_trigram_secrets": _spans(), "op7_epsilon_grid_join": COSINES}
