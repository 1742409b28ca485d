"""DuckDB SQL for the queries that SQL states in full: the same rows from the
definitions, by plain joins over all windows or shingles."""

from __future__ import annotations

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(text: str, pattern: str) -> str:
    return f"coalesce(regexp_extract_all({text}, {pattern}), CAST([] AS VARCHAR[]))"


ORACLE_SQL = {
    "op1_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_words('text', _SPACED)} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM starts),
owners AS (SELECT k, min(doc_id) AS owner FROM windows GROUP BY k),
repeats AS (SELECT doc_id, i FROM windows JOIN owners USING (k) WHERE owner < doc_id),
gone AS (SELECT DISTINCT doc_id, i + o AS i, true AS cut FROM repeats, range(13) t(o)),
marked AS (SELECT doc_id, i, word, coalesce(cut, false) AS cut FROM words LEFT JOIN gone USING (doc_id, i))
SELECT d.doc_id, CAST(len(any_value(d.w)) AS BIGINT) AS n_words,
    CAST(count(*) FILTER (WHERE m.cut) AS BIGINT) AS n_removed,
    sha256(coalesce(string_agg(m.word, ' ' ORDER BY m.i) FILTER (WHERE NOT m.cut), '')) AS kept_sha256
FROM d LEFT JOIN marked m USING (doc_id) GROUP BY d.doc_id""",
    "op3_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_words(f'translate(text, {_LETTERS})', _ALNUM)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words(f'translate(text, {_LETTERS})', _ALNUM)} AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
runs AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS k
    FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM runs),
starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes),
hits AS (SELECT doc_id, i, n, item FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM starts) s JOIN runs USING (n, k)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
    "op5_ngram_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(f'translate(text, {_LETTERS})', _SPACED)} AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a JOIN shingles b USING (k)
    WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * common >= 90 * (a.n + b.n - common)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(min(y), doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.x = d.doc_id GROUP BY doc_id""",
}
