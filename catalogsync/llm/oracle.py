"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
           list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
    FROM v a, v b
    WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

_NEAR = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{WORD}') AS ws FROM documents
), sh AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s
    FROM w
), n AS (
    SELECT doc_id, count(s) AS n_shingles FROM documents LEFT JOIN sh USING (doc_id) GROUP BY doc_id
), links AS (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
    ) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * shared >= 75 * (na.n_shingles + nb.n_shingles - shared)
), reach AS (
    SELECT doc_id AS id, doc_id AS r FROM documents
    UNION
    SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT doc_id, n_shingles::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM n JOIN (SELECT id, min(r) AS component_id FROM reach GROUP BY id) ON id = doc_id
"""

_EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_SHARE = "1 + (1000000000::HUGEINT * ({count} + 2)) // {total}"
_DISTANCE = "(({p} - {q}) * ({p} - {q})) // ({p} + {q})"

_DIVERGENCE = f"""
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS text
    FROM documents
), t AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), k AS (
    SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), g AS (
    SELECT DISTINCT lang, source FROM d
), c AS (
    SELECT g.lang, g.source, k.term, k.lang_n, coalesce(n, 0) AS n
    FROM g JOIN k USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) s
        ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
), v AS (
    SELECT lang, count(*) AS terms, sum(lang_n) AS lang_total FROM k GROUP BY lang
), m AS (
    SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source
), p AS (
    SELECT lang, source, term, n, {_SHARE.format(count="n", total="(total + 2 * terms)")} AS p,
           {_SHARE.format(count="lang_n", total="(lang_total + 2 * terms)")} AS q
    FROM c JOIN v USING (lang) JOIN m USING (lang, source)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum({_DISTANCE.format(p="x.p", q="y.p")}) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL
), rows AS (
    SELECT lang, source, 'term' AS part, term AS item, {_DISTANCE.format(p="p", q="q")} AS value FROM p WHERE n > 0 AND p > q
    UNION ALL
    SELECT lang, source, 'pair', item, coalesce(value, 0) FROM pairs
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
WHERE part = 'pair' OR rank <= 10
"""


_REPEATS = f"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents
), g AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS said FROM w, unnest(range(1, len(ws) - 11)) AS p(i)
), late AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY said) AS least FROM g) WHERE least < doc_id
), gone AS (
    SELECT DISTINCT doc_id, i + k AS i FROM late, unnest(range(0, 13)) AS p(k)
), kept AS (
    SELECT doc_id, string_agg(ws[i], ' ' ORDER BY i) AS text, count(*) AS n
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w) ANTI JOIN gone USING (doc_id, i)
    GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

# crc32 of a conversation's id, a bit at a time, then the rebuilt conversations and their beginnings as lists of turns.
_TRIE = f"""
WITH RECURSIVE t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
           {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
    FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
    SELECT conv_id, conv_id::VARCHAR AS digits, 0 AS bit, 4294967295::BIGINT AS state FROM (SELECT DISTINCT conv_id FROM t)
    UNION ALL
    SELECT conv_id, digits, bit + 1, xor(step >> 1, CASE WHEN step & 1 = 1 THEN 3988292384 ELSE 0 END)
    FROM (SELECT *, CASE WHEN bit % 8 = 0 THEN xor(state, ascii(substr(digits, bit // 8 + 1, 1))::BIGINT) ELSE state END AS step FROM crc)
    WHERE bit < 8 * length(digits)
), c AS (
    SELECT conv_id, xor(state, 4294967295) % 4 AS h FROM crc WHERE bit = 8 * length(digits)
), r AS (
    SELECT c.conv_id, 0 AS own, t.i, said FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.i <= h
    UNION ALL
    SELECT c.conv_id, 1, t.i, said FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > h
), l AS (
    SELECT c.conv_id, coalesce(turns, []) AS turns
    FROM c LEFT JOIN (SELECT conv_id, list(said ORDER BY own, i) AS turns FROM r GROUP BY conv_id) USING (conv_id)
), b AS (
    SELECT conv_id, depth, turns[:depth] AS node, depth = len(turns) AS ends FROM l, unnest(range(0, len(turns) + 1)) AS d(depth)
), n AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ended,
           CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(node[depth].text, '{WORD}')) END AS saved
    FROM b GROUP BY node, depth
), m AS (
    SELECT n.*, parent.conv_id AS parent_conv_id, coalesce(k.n_children, 0) AS n_children
    FROM n LEFT JOIN n AS parent ON parent.depth = n.depth - 1 AND parent.node = n.node[:n.depth - 1]
    LEFT JOIN (SELECT node[:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL) k ON k.node = n.node
), s AS (
    SELECT a.node, sum(m.saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves
    FROM m JOIN b AS a ON a.conv_id = m.conv_id AND a.depth <= m.depth
    GROUP BY a.node
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ended) AS ends_sha256
FROM m JOIN s USING (node)
"""


def _mixing() -> str:
    fits = "extra = 0 AND rest > 0 AND size <= rest"
    return f"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
           -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 12))::BIGINT::DOUBLE + 1) / 281474976710656.0)
           / greatest(coalesce(power_share, 0.0), 0.05) AS key
    FROM (
        SELECT *, share * share AS power_share FROM (
            SELECT *, length(regexp_replace(text, '[^a-zà-ÿ ]+', '', 'g'))::DOUBLE / greatest(length(text), 1) AS share FROM documents
        )
    )
), t AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
    SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, (sum(source_size) OVER ())::BIGINT AS total FROM t
), o AS (
    SELECT *, source_size * 6 // weight AS ratio FROM r
), c AS (
    SELECT *, coalesce(sum(source_size) OVER before, 0)::BIGINT AS stopped_size,
           (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS weights_left
    FROM o WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), s AS (
    SELECT *, (total - 3 * stopped_size) * weight >= 3 * source_size * weights_left AS stops FROM c
), g AS (
    SELECT source, source_size, CASE WHEN stops THEN (3 * source_size)::DOUBLE ELSE
        ((total - 3 * sum(CASE WHEN stops THEN source_size ELSE 0 END) OVER ()) * weight)::DOUBLE
        / (sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
    FROM s
), p0 AS (
    SELECT d.*, source_size, target, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs,
           target - coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT * source_size AS rest, 0 AS extra
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), p AS (
    SELECT *, 0 AS pass FROM p0
    UNION ALL
    SELECT * EXCLUDE (rest, extra, pass, before, more, filled, taken_now),
           rest - (sum(filled) OVER (PARTITION BY source))::DOUBLE AS rest, CASE WHEN taken_now THEN 1 ELSE extra END AS extra, pass + 1 AS pass
    FROM (SELECT *, {fits} AND before + size <= rest AS taken_now, CASE WHEN {fits} AND before + size <= rest THEN size ELSE 0 END AS filled
          FROM (SELECT *, bool_or({fits}) OVER () AS more, coalesce(sum(CASE WHEN {fits} THEN size ELSE 0 END) OVER (
                    PARTITION BY source ORDER BY key, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
                FROM p))
    WHERE more
)
SELECT doc_id, size, source_size, target, epochs + extra AS times, (epochs + extra) * size AS taken
FROM p WHERE pass = (SELECT max(pass) FROM p)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk_search": _TOP_K,
        "op5_near_dedup": _NEAR,
        "op8_exact_dedup": _EXACT,
        "op9_mixing": _mixing(),
        "op11_divergence": _DIVERGENCE,
        "op12_substring_dedup": _REPEATS,
        "op13_conversation_trie": _TRIE,
    }
