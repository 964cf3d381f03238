"""DuckDB SQL for the spelling variants: words, near words by cutting out one place, forms, roots."""

from logengine.llm import spelling
from logengine.llm.oracle_merkle import CRC_TABLE, crc32

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP13 = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, r, count(*) c FROM (SELECT doc_id, unnest(regexp_extract_all(
        translate(text, {_UPPER}), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) r FROM documents) GROUP BY ALL),
hashed AS (SELECT r, c, {crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r")} h FROM runs, crc_table),
dropped AS (SELECT c, CASE WHEN h % {spelling.DROP} = 0
        THEN substr(r, 1, CAST(h % length(r) AS BIGINT)) || substr(r, CAST(h % length(r) + 2 AS BIGINT)) ELSE r END word FROM hashed),
w AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) n FROM dropped WHERE length(word) >= {spelling.MIN_CHARS}
        GROUP BY word HAVING sum(c) >= {spelling.MIN_COUNT}),
cut AS MATERIALIZED (SELECT word, n, k, substr(word, 1, CAST(k AS BIGINT)) a, substr(word, CAST(k + 2 AS BIGINT)) b
        FROM (SELECT word, n, unnest(range(0, length(word))) k FROM w)),
near AS MATERIALIZED (
        SELECT DISTINCT * FROM (
        SELECT x.word, x.n, y.word v, y.n m FROM cut x JOIN cut y ON x.k = y.k AND x.a = y.a AND x.b = y.b AND x.word <> y.word
        UNION ALL SELECT x.word, x.n, w.word, w.n FROM cut x JOIN w ON x.a || x.b = w.word
        UNION ALL SELECT w.word, w.n, x.word, x.n FROM cut x JOIN w ON x.a || x.b = w.word)),
best AS (SELECT word, any_value(n) n, count(*) n_near, arg_min(v, (-m, encode(v))) v, max(m) m FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) n_near, CASE WHEN m >= {spelling.RATIO} * w.n THEN v END form,
        CASE WHEN m >= {spelling.RATIO} * w.n THEN m END form_n FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS at FROM forms UNION ALL SELECT chain.word, form FROM chain JOIN forms ON chain.at = forms.word
        WHERE form IS NOT NULL)
SELECT f.word, f.form, chain.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain USING (word)
JOIN forms l ON chain.at = l.word AND l.form IS NULL
"""
