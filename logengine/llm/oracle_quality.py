"""DuckDB SQL for the quality rules: base counts, sketches, thresholds, verdicts."""

from logengine.llm import quality

_FIGURE_ROWS = " UNION ALL ".join(f"SELECT rid, l, s, '{f}' figure, f_{f} v FROM m" for f in quality.FIGURES)

#: ``verdicts``: one row per document (rid, doc_id, counts, base_failed, kept) over a table ``{docs}``.
VERDICTS = rf"""
d AS (SELECT row_number() OVER () rid, doc_id, coalesce(text, '') t,
        coalesce('0' || lang, '1') l, coalesce('0' || source, '1') s FROM {{docs}}),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) lines FROM d),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) c
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) i FROM w)),
rep AS (SELECT rid, sum(least(3, coalesce(i - before, 3))) n FROM
        (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) before FROM win WHERE c > 1) GROUP BY rid),
b AS (SELECT rid, doc_id, l, s, len(w) n_words, length(array_to_string(w, '')) word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) n_symbols,
        length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) n_upper,
        len(lines) n_lines, len(lines) - len(list_distinct(lines)) n_dup_lines,
        coalesce(CAST(n AS BIGINT), 0) n_repeat_words FROM w LEFT JOIN rep USING (rid)),
m AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words base_failed,
        CASE WHEN n_words > 0 THEN {quality.SCALE} * n_symbols // n_words ELSE 0 END f_symbols,
        CASE WHEN n_lines > 0 THEN {quality.SCALE} * n_dup_lines // n_lines ELSE 0 END f_dup_lines,
        CASE WHEN n_words > 0 THEN {quality.SCALE} * n_repeat_words // n_words ELSE 0 END f_repeats,
        CASE WHEN word_chars > 0 THEN {quality.SCALE} * n_upper // word_chars ELSE 0 END f_capitals,
        CASE WHEN n_words > 0 THEN {quality.SCALE} * word_chars // n_words ELSE 0 END f_word_length FROM b),
v AS ({_FIGURE_ROWS}),
cells AS (SELECT l, s, figure, (v >> drop_bits) << drop_bits k, count(*) n FROM
        (SELECT *, greatest(length(bin(v)) - 8, 0) drop_bits FROM v
         WHERE rid IN (SELECT rid FROM m WHERE NOT base_failed)) GROUP BY ALL),
corpus AS (SELECT figure, k, {quality.SHARES} * n // t sh FROM (SELECT figure, k, n, sum(n) OVER (PARTITION BY figure) t
        FROM (SELECT figure, k, sum(n) n FROM cells GROUP BY ALL))),
ln AS (SELECT l, figure, k, sum(n) n FROM cells GROUP BY ALL),
lw AS (SELECT l, figure, k, {quality.SHARES // quality.PRIOR} * coalesce(n, 0) + sh w
        FROM (SELECT DISTINCT l, figure FROM ln) JOIN corpus USING (figure) LEFT JOIN ln USING (l, figure, k)),
lsh AS (SELECT l, figure, k, {quality.SHARES} * w // t sh FROM (SELECT *, sum(w) OVER (PARTITION BY l, figure) t FROM lw WHERE w > 0)),
ow AS (SELECT l, s, figure, k, {quality.SHARES // quality.PRIOR} * coalesce(n, 0) + sh w
        FROM (SELECT DISTINCT l, s, figure FROM cells) JOIN lsh USING (l, figure) LEFT JOIN cells USING (l, s, figure, k)),
oz AS (SELECT *, 2 * coalesce(sum(w) FILTER (k = 0) OVER g, 0) >= sum(w) OVER g z FROM ow WINDOW g AS (PARTITION BY l, s, figure)),
cum AS (SELECT *, sum(w) OVER (PARTITION BY l, s, figure ORDER BY k) upto, sum(w) OVER (PARTITION BY l, s, figure) total
        FROM oz WHERE w > 0 AND NOT (z AND k = 0)),
q AS (SELECT l, s, figure, any_value(z) z, min(k) FILTER (10 * upto >= total) q1, min(k) FILTER (10 * upto >= 5 * total) q5,
        min(k) FILTER (10 * upto >= 9 * total) q9 FROM cum GROUP BY ALL),
chosen AS (SELECT l, s, figure, CASE WHEN z THEN 0 ELSE q1 - greatest({quality.FENCE} * (q5 - q1), q5 // 128 + 1) END low,
        q9 + greatest({quality.FENCE} * (q9 - q5), q5 // 128 + 1) high FROM q),
outside AS (SELECT DISTINCT rid FROM v JOIN chosen USING (l, s, figure) WHERE v.v < low OR v.v > high),
verdicts AS (SELECT rid, doc_id, CAST(n_words AS BIGINT) n_words, CAST(word_chars AS BIGINT) word_chars,
        CAST(n_symbols AS BIGINT) n_symbols, CAST(n_dup_lines AS BIGINT) n_dup_lines,
        CAST(n_repeat_words AS BIGINT) n_repeat_words, base_failed,
        NOT base_failed AND rid NOT IN (SELECT rid FROM outside) kept FROM m)
"""

OP2 = (
    "WITH " + VERDICTS.replace("{docs}", "documents") + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, "
    "n_repeat_words, base_failed, kept FROM verdicts"
)
