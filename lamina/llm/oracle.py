"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ALNUM = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

_ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)


def _matches(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT doc_id, '{kind}' AS kind, {rank} AS rank, start, start + length(took[i]) AS stop FROM (
        SELECT doc_id, took, counted, i,
            list_sum(list_transform(parts[1:i], lambda x: length(x)))
              + coalesce(list_sum(list_transform(took[1:i - 1], lambda x: length(x))), 0) AS start
        FROM (
            SELECT doc_id, regexp_split_to_array(text, '{pattern}') AS parts,
                regexp_extract_all(text, '{pattern}', 0) AS took,
                regexp_extract_all(text, '{pattern}', {group}) AS counted,
                unnest(generate_series(1, len(regexp_extract_all(text, '{pattern}', 0)))) AS i
            FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        )
    ) WHERE length(counted[i]) >= {least}"""


OP3 = f"""
WITH found AS ({_matches("assign", 1, _ASSIGN, 2, 6)}
    UNION ALL {_matches("access", 2, "AKIA[A-Z0-9]+", 0, 20)}
    UNION ALL {_matches("hex", 3, "[0-9a-f]+", 0, 24)}
    UNION ALL {_matches("pem", 4, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0)}),
told AS (
    SELECT doc_id, count(*) FILTER (rank = 1) AS n_assign, count(*) FILTER (rank = 2) AS n_access,
        count(*) FILTER (rank = 3) AS n_hex,
        string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
        string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, rank) AS spans
    FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN told USING (doc_id)
"""

OP6 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
sized AS (
    SELECT *, 23 + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
        + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS chars FROM turns),
summed AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text
    ROWS UNBOUNDED PRECEDING) AS upto FROM sized)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples,
    coalesce(sum(upto) FILTER (role = 'assistant'), 0)::BIGINT AS example_chars
FROM summed GROUP BY conv_id
"""

OP7 = f"""
WITH items AS (SELECT item_id, {ALNUM} AS w FROM benchmark),
item_windows AS (
    SELECT item_id, least(13, len(w)) AS size,
        unnest(list_transform(generate_series(1, len(w) - least(13, len(w)) + 1),
            lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS win
    FROM items WHERE len(w) > 0),
docs AS (SELECT doc_id, {ALNUM} AS w FROM documents),
doc_windows AS (
    SELECT doc_id, size, start, array_to_string(w[start:start + size - 1], ' ') AS win
    FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS start
        FROM docs, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)),
hits AS (SELECT DISTINCT doc_id, item_id, start, size FROM doc_windows JOIN item_windows USING (size, win)),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(start, start + size - 1)) AS place FROM hits) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)
"""

OP9 = rf"""
WITH docs AS (
    SELECT doc_id, {WORDS} AS w, length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents),
windows AS (
    SELECT doc_id, start, array_to_string(w[start:start + 4], ' ') AS win
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS start FROM docs WHERE len(w) >= 5)),
repeated AS (SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest(generate_series(start, start + 4)) AS place
        FROM windows JOIN (SELECT doc_id, win FROM windows GROUP BY ALL HAVING count(*) > 1) USING (doc_id, win))
    GROUP BY doc_id),
told AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines
    FROM docs LEFT JOIN repeated USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM told)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 5 * n_symbols > n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM judged
"""

def _lloyd(rounds: int) -> str:
    """Rounds spelled out: ``a`` has each vector's 8 * distance + cluster, ``m`` means, ``c`` centroids."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT kept.id, any_value(kept.x) AS x, min(8 * CAST(list_sum(list_transform(list_zip(kept.x, c{r}.x),
        lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) + c{r}.k) AS e
    FROM kept, c{r} GROUP BY kept.id)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
        SELECT k, i, sum(v) AS s, count(*) AS n FROM (
            SELECT e % 8 AS k, unnest(x) AS v, unnest(range(64)) AS i FROM a{r})
        GROUP BY k, i)
    GROUP BY k),
c{r + 1} AS MATERIALIZED (
    SELECT c{r}.k, coalesce(m{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN m{r} ON m{r}.k = c{r}.k)""")
    return ",\n".join(steps)


OP12 = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS id, vec_id,
        list_transform(embedding, lambda v: CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE len(embedding) = 64
        AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k, x
    FROM kept ORDER BY k LIMIT 8),
{_lloyd(10)},
told AS (SELECT kept.vec_id, e % 8 AS k, e // 8 AS distance FROM a10 JOIN kept USING (id))
SELECT vec_id, CAST(told.k AS INTEGER) AS cluster, distance,
    CAST(sum(distance) OVER (PARTITION BY told.k) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c10.x, ',')) AS centroid_sha256
FROM told JOIN c10 USING (k)
"""


ORACLE = {
    "op3_secret_scans": OP3,
    "op6_chat_format": OP6,
    "op7_decontaminate": OP7,
    "op9_quality_rules": OP9,
    "op12_centroid_clusters": OP12,
}
