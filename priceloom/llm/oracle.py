"""DuckDB SQL for those queries that SQL can express."""

#: All phrases are counted here, whatever their parts.
_COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), f AS (
    SELECT lang, size, phrase, count(*) AS a FROM (
        SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
        FROM w CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(w) >= size
    ) GROUP BY ALL HAVING count(*) >= 100
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY 1
), cuts AS (
    SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size > 1
), rated AS (
    SELECT c.lang, c.size, c.phrase, c.a, c.w, c.k, l.a AS l, r.a AS r, t.n,
           (1000 * CAST(c.a AS HUGEINT) * CAST(t.n AS HUGEINT)) // (CAST(l.a AS HUGEINT) * CAST(r.a AS HUGEINT)) AS score
    FROM cuts c JOIN totals t USING (lang)
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : c.k], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1 :], ' ')
), best AS (
    SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), parts AS (
    SELECT lang, a, unnest(list_transform(flatten(list_transform(range(2, size), lambda m: list_transform(range(1, size - m + 2), lambda i: [i, m]))),
                                          lambda x: array_to_string(w[x[1] : x[1] + x[2] - 1], ' '))) AS phrase
    FROM best WHERE size > 2
), covered AS (
    SELECT lang, phrase, max(a) AS longer FROM parts GROUP BY 1, 2
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best LEFT JOIN covered USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
"""

ORACLE_SQL = {
    "op13_collocations": _COLLOCATIONS,
    "op8_exact_dedup": r"""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), g AS (
    SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-chars, doc_id)) AS keep_id FROM n GROUP BY 1
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.text_sha256
FROM n JOIN g USING (text_sha256)
""",
    "op3_nearest": """
WITH v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_or(list_transform(embedding, lambda y: y <> 0))
      AND list_bool_and(list_transform(embedding, lambda y: y IS NOT NULL AND isfinite(y)))
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
""",
}
