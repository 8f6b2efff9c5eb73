"""DuckDB SQL that gives the rows of the queries, written without the code under test."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LOWER_WORDS = _WORDS.format(text=_LOWER.format(text="coalesce(text, '')"))


def _shingles(table: str, key: str, width: int) -> str:
    return f"""
        SELECT DISTINCT {key}, unnest(CASE
            WHEN len(w) >= {width} THEN list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i:i + {width - 1}], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
        FROM (SELECT {key}, {_LOWER_WORDS} AS w FROM {table})"""


OP3 = f"""
WITH RECURSIVE s AS ({_shingles("documents", "doc_id", 2)}),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least.component_id, d.doc_id = least.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN least USING (doc_id)
"""

OP5 = r"""
WITH w AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
spots AS (
    SELECT doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS three
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
again AS (SELECT doc_id, three FROM spots GROUP BY 1, 2 HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS word FROM spots JOIN again USING (doc_id, three)),
repeated AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
m AS (
    SELECT doc_id, source, len(w) AS n_words, coalesce(len(array_to_string(w, '')), 0) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
    FROM w LEFT JOIN repeated USING (doc_id)),
failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)::int + (10 * n_symbols > n_words)::int
           + (10 * n_dup_lines > 3 * n_lines)::int + (word_chars < 3 * n_words OR word_chars > 10 * n_words)::int
           + (5 * n_repeat_words > n_words)::int AS n_failed
    FROM m),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (n_failed > 0) AS f FROM failed GROUP BY source),
moments AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v, avg(1 / n) AS a FROM hosts),
prior AS (SELECT m, CASE WHEN a < 1 THEN (v - m * (1 - m) * a) / (1 - a) ELSE 0 END AS v FROM moments),
judged AS (
    SELECT source, CASE WHEN v > 0
        THEN (f + greatest(1, m * (1 - m) / v - 1) * m) / (n + greatest(1, m * (1 - m) / v - 1)) ELSE m END > 0.5 AS host_failed
    FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_failed, host_failed,
       NOT base_failed AND n_failed < CASE WHEN host_failed THEN 1 ELSE 2 END AS kept
FROM failed JOIN judged ON failed.source IS NOT DISTINCT FROM judged.source
"""

OP8 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < response THEN response END AS refers_to
FROM r
"""

OP10 = f"""
WITH w AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
short AS (SELECT DISTINCT len(w) AS k FROM (SELECT {_LOWER_WORDS} AS w FROM benchmark) WHERE len(w) BETWEEN 1 AND 4),
d AS (
    {_shingles("documents", "doc_id", 5)}
    UNION
    SELECT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS shingle
    FROM w, short),
b AS ({_shingles("benchmark", "item_id", 5)}),
n AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id)
SELECT doc_id, item_id, count(*)::int AS n_shared, any_value(n)::int AS n_shingles
FROM d JOIN b USING (shingle) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n)
"""

OP12 = r"""
WITH l AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
k AS (
    SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM l),
common AS (
    SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT k.*, owner IS NOT NULL AND owner <> doc_id AS dropped FROM k LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP13 = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
           sha256('7:' || doc_id) AS h
    FROM documents),
d AS (
    SELECT doc_id, text, lines, len(lines) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
           ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM t),
c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM d),
parts AS (
    SELECT *, array_to_string(lines[1:a], '') AS p, array_to_string(lines[a + 1:b], '') AS m, array_to_string(lines[b + 1:n], '') AS s
    FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
           AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

TWINS: dict[str, str] = {
    "op3_near_duplicates": OP3,
    "op5_host_quality": OP5,
    "op8_warc_revisits": OP8,
    "op10_decontaminate": OP10,
    "op12_line_dedup": OP12,
    "op13_fill_in_middle": OP13,
}
