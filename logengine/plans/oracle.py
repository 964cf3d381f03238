"""DuckDB oracle SQL for every query with a SQL equivalent.

Tables ``events orders lineitem customer documents labels ...`` are
views over the parquet files. The log rows, parsed records, points and
query-result rows are recomputed here from the base tables in plain SQL,
independently of the Spark code path (e.g. the result-document reader is
checked against the orders it was built from, and empty ticks against a
full tick grid with an anti join).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Shared CTE pieces
# ---------------------------------------------------------------------------

_MS = "(1484337436366 + (epoch_us(ts) - 1704067200000000) // 600000)"

LOGTOPIC = f"""logtopic AS (
  SELECT event_id*2 AS off, make_timestamp(ms*1000) AS record_ts,
    'flume-agent-0' || CAST(user_id % 3 + 1 AS VARCHAR) || ' '
    || CASE WHEN user_id % 2 = 0 THEN 'namenode' ELSE 'datanode' END || ' '
    || strftime(make_timestamp(ms*1000), '%Y-%m-%d %H:%M:%S,%g') || ' '
    || CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'INFO'
         WHEN 'click' THEN 'DEBUG' WHEN 'purchase' THEN 'WARN' ELSE 'FATAL' END
    || ' org.example.Server: event ' || CAST(event_id AS VARCHAR)
    || CASE WHEN event_id % 7 = 0 THEN ' after ERROR' ELSE '' END
    || ' props=' || props AS value
  FROM (SELECT *, {_MS} AS ms FROM events)
  UNION ALL
  SELECT event_id*2+1, make_timestamp({_MS}*1000),
    chr(9) || 'at org.example.Foo.bar(Foo.java:' || CAST(event_id AS VARCHAR) || ')'
  FROM events WHERE event_type = 'error' AND event_id % 5 = 0
)"""

MARKERS = "(contains(value,'INFO') OR contains(value,'WARN') OR contains(value,'ERROR') OR contains(value,'DEBUG'))"


def jsplit(x: str) -> str:
    """Java String.split(" ") in DuckDB."""
    return (f"(CASE WHEN {x} = '' THEN [''] WHEN rtrim({x}, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({x}, ' '), ' ') END)")


_LENS = "len(t[1])+len(t[2])+len(t[3])+len(t[4])+len(t[5])"

CDH = f"""hdr AS (
  SELECT off, record_ts, value, {jsplit('value')} AS t FROM logtopic WHERE {MARKERS}
), cdhrolelogs AS (
  SELECT off, record_ts, value, t[1] AS hostName, t[2] AS serviceName, t[3] || ' ' || t[4] AS lineTimestamp,
    t[5] AS logType, substr(value, {_LENS} + 6) AS logInfo,
    substr(value, {_LENS} + len(t[5]) + 2) AS legacyInfo,
    try_strptime(t[3] || ' ' || t[4], '%Y-%m-%d %H:%M:%S,%g') AS event_ts
  FROM hdr WHERE len(t) >= 5
)"""

LOG = f"WITH {LOGTOPIC}, {CDH}"


def tick(i: str = "0", slide_us: int = 5_000_000, ts: str = "record_ts") -> str:
    return f"make_timestamp(((epoch_us({ts}) // {slide_us}) + 1 + {i}) * {slide_us})"


KEY = "hostName || '_' || serviceName || '_' || logType"
# Bucket of a key among the 8 parts of a tick.
PART = f"CAST(CAST('0x' || substr(md5({KEY}), 1, 8) AS BIGINT) % 8 AS INTEGER)"


def esc(x: str) -> str:
    return f"regexp_replace({x}, '([ ,=])', '\\\\\\1', 'g')"


def fesc(x: str) -> str:
    return f"('\"' || regexp_replace({x}, '([\\\\\"])', '\\\\\\1', 'g') || '\"')"


def fmt(x: str) -> str:
    """Plain decimal text of a double with at least one fraction digit."""
    return f"(CASE WHEN contains(CAST({x} AS VARCHAR), '.') THEN CAST({x} AS VARCHAR) ELSE CAST({x} AS VARCHAR) || '.0' END)"


def jts(x: str) -> str:
    """java.sql.Timestamp.toString text."""
    trimmed = f"regexp_replace(strftime({x}, '%Y-%m-%d %H:%M:%S.%f'), '0+$', '')"
    return f"(CASE WHEN ends_with({trimmed}, '.') THEN {trimmed} || '0' ELSE {trimmed} END)"


ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"

ORDER_LINE = ("'orders,o_orderpriority=' || " + esc("o_orderpriority") + " || ' o_custkey=' || o_custkey || 'i,o_orderstatus=' || "
              + fesc("o_orderstatus") + " || ',o_totalprice=' || " + fmt("o_totalprice") + " || ' ' || epoch_ns(o_orderdate)")

LINEITEM_LINE = ("'lineitem,l_linestatus=' || " + esc("l_linestatus") + " || ',l_returnflag=' || " + esc("l_returnflag")
                 + " || ' l_discount=' || " + fmt("l_discount") + " || ',l_extendedprice=' || " + fmt("l_extendedprice")
                 + " || ',l_partkey=' || l_partkey || 'i,l_quantity=' || " + fmt("l_quantity")
                 + " || ',l_suppkey=' || l_suppkey || 'i ' || epoch_ns(l_shipdate)")

WORDS_LOG = f"w AS (SELECT record_ts, unnest({jsplit('value')}) AS word FROM logtopic)"

VARIANT = f"""v AS (
  SELECT {tick('i')} AS tick, hostName, serviceName, logType, count(logType) AS cnt
  FROM cdhrolelogs, range(0, 6) r(i) WHERE logType IN ('INFO','DEBUG','WARN','ERROR') GROUP BY 1, 2, 3, 4
)"""

SLIDING = f"""s AS (
  SELECT {tick('i')} AS tick, hostName, serviceName, logType, count(logType) AS cnt
  FROM cdhrolelogs, range(0, 3) r(i) GROUP BY 1, 2, 3, 4
)"""

COUNT_LINE = f"'logtype_count,host_service_logtype=' || {esc(KEY)} || ' count=' || cnt"

ORDER_SERIES = f"""os AS (
  SELECT o_orderkey // 100 AS doc_id, o_orderstatus, o_orderkey, o_orderdate, o_custkey, o_totalprice, o_orderpriority,
    CAST(dense_rank() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderstatus) - 1 AS INTEGER) AS series_idx,
    CAST(row_number() OVER (PARTITION BY o_orderkey // 100, o_orderstatus ORDER BY o_orderdate, o_orderkey) - 1 AS INTEGER) AS row_idx
  FROM orders
)"""


def _union_levels(src: str = "cdhrolelogs") -> str:
    return " UNION ALL ".join(
        f"SELECT hostName, serviceName, '{lv}' AS logType, count(logType) AS cnt FROM {src} "
        f"WHERE logType = '{lv}' GROUP BY hostName, serviceName"
        for lv in ("INFO", "DEBUG", "WARN", "ERROR")
    )


ORACLE_SQL: dict[str, str] = {
    "log_source": f"WITH {LOGTOPIC} SELECT off, record_ts, value FROM logtopic",
    "header_lines": f"WITH {LOGTOPIC} SELECT off, record_ts, value FROM logtopic WHERE {MARKERS}",
    "parse_log": f"{LOG} SELECT off, record_ts, hostName, serviceName, lineTimestamp, logType, logInfo, event_ts FROM cdhrolelogs",
    "log_message": f"{LOG} SELECT off, logType, logInfo, legacyInfo FROM cdhrolelogs",
    "log_event_time": f"{LOG} SELECT off, lineTimestamp, event_ts FROM cdhrolelogs",
    "series_key": f"{LOG} SELECT off, {KEY} AS key FROM cdhrolelogs",
    "drop_continuations": (
        f"WITH {LOGTOPIC} SELECT CASE WHEN {MARKERS} THEN 'header' ELSE 'continuation' END AS kind, "
        "count(*) AS n_rows FROM logtopic GROUP BY 1"
    ),
    "tokenize": (
        f"SELECT doc_id, CAST(unnest(range(len(t))) AS INTEGER) AS pos, unnest(t) AS word "
        f"FROM (SELECT doc_id, {jsplit('text')} AS t FROM documents)"
    ),
    "format_log": (
        f"{LOG} SELECT off, concat_ws(' ', coalesce(hostName,'null'), coalesce(serviceName,'null'), "
        "coalesce(lineTimestamp,'null'), coalesce(logType,'null'), coalesce(logInfo,'null')) AS line FROM cdhrolelogs"
    ),
    "rejects": (
        f"WITH {LOGTOPIC} SELECT * FROM (SELECT off, record_ts, value, CASE WHEN NOT {MARKERS} THEN 'no_level_marker' "
        f"WHEN len({jsplit('value')}) < 5 THEN 'too_few_tokens' END AS reason FROM logtopic) WHERE reason IS NOT NULL"
    ),
    "key_count_per_tick": f"{LOG} SELECT {tick()} AS tick, {KEY} AS key, count(*) AS cnt FROM cdhrolelogs GROUP BY 1, 2",
    "word_count": f"SELECT word, count(*) AS cnt FROM (SELECT unnest({jsplit('text')}) AS word FROM documents) GROUP BY word",
    "level_count": f"{LOG} SELECT hostName, serviceName, logType, count(logType) AS cnt FROM cdhrolelogs GROUP BY 1, 2, 3",
    "fixed_level_count": (
        f"{LOG} SELECT hostName, serviceName, logType, count(logType) AS cnt FROM cdhrolelogs "
        "WHERE logType IN ('INFO','DEBUG','WARN','ERROR') GROUP BY 1, 2, 3"
    ),
    "latest_level": (
        f"{LOG} SELECT hostName, logType FROM cdhrolelogs "
        "QUALIFY row_number() OVER (PARTITION BY hostName ORDER BY record_ts DESC, off DESC) = 1"
    ),
    "running_count": (
        f"WITH {LOGTOPIC}, {WORDS_LOG}, pt AS (SELECT word, {tick()} AS tick, count(*) AS cnt FROM w GROUP BY 1, 2) "
        "SELECT word, tick, cnt, CAST(sum(cnt) OVER (PARTITION BY word ORDER BY tick "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM pt"
    ),
    "windowed_word_count": (
        f"WITH {LOGTOPIC}, {WORDS_LOG} SELECT {tick('i')} AS tick, word, count(word) AS cnt "
        "FROM w, range(0, 6) r(i) GROUP BY 1, 2"
    ),
    "tumbling_level_count": (
        f"{LOG} SELECT {tick()} AS tick, hostName, serviceName, logType, count(logType) AS cnt FROM cdhrolelogs GROUP BY 1, 2, 3, 4"
    ),
    "sliding_level_count": f"{LOG}, {SLIDING} SELECT * FROM s",
    "sliding_fixed_level_count": f"{LOG}, {VARIANT} SELECT * FROM v",
    "sliding_latest_level": (
        f"{LOG} SELECT tick, hostName, logType FROM (SELECT {tick('i')} AS tick, hostName, logType, record_ts, off "
        "FROM cdhrolelogs, range(0, 6) r(i)) "
        "QUALIFY row_number() OVER (PARTITION BY tick, hostName ORDER BY record_ts DESC, off DESC) = 1"
    ),
    "hourly_level_count": (
        f"{LOG} SELECT {tick('i')} AS tick, hostName, serviceName, logType, count(logType) AS cnt "
        "FROM cdhrolelogs, range(0, 720) r(i) GROUP BY 1, 2, 3, 4"
    ),
    "hourly_latest_level": (
        f"{LOG} SELECT tick, hostName, arg_max(logType, (record_ts, off)) AS logType FROM (SELECT {tick('i')} AS tick, hostName, "
        "logType, record_ts, off FROM cdhrolelogs, range(0, 720) r(i)) GROUP BY 1, 2"
    ),
    "empty_ticks": (
        f"{LOG}, ne AS (SELECT DISTINCT hostName, serviceName, ((epoch_us(record_ts) // 5000000) + 1 + i) * 5000000 AS te "
        "FROM cdhrolelogs, range(0, 3) r(i)), "
        "b AS (SELECT hostName, serviceName, min(te) AS lo, max(te) AS hi FROM ne GROUP BY 1, 2), "
        "grid AS (SELECT hostName, serviceName, unnest(range(lo, hi + 5000000, 5000000)) AS te FROM b) "
        "SELECT g.hostName, g.serviceName, make_timestamp(g.te) AS tick FROM grid g "
        "WHERE NOT EXISTS (SELECT 1 FROM ne WHERE ne.hostName = g.hostName AND ne.serviceName = g.serviceName AND ne.te = g.te)"
    ),
    "union_levels": f"{LOG} {_union_levels()}",
    "tick_preview": (
        f"{LOG}, kc AS (SELECT {tick()} AS tick, {KEY} AS key, count(*) AS cnt FROM cdhrolelogs GROUP BY 1, 2) "
        "SELECT * FROM (SELECT tick, key, cnt, CAST(row_number() OVER (PARTITION BY tick ORDER BY key) AS INTEGER) AS rn FROM kc) "
        "WHERE rn <= 10"
    ),
    "count_lines": f"{LOG}, {SLIDING} SELECT tick, {COUNT_LINE} AS line FROM s",
    "tick_payload": (
        f"{LOG}, {SLIDING}, l AS (SELECT tick, {PART} AS part, {COUNT_LINE} AS line FROM s) "
        "SELECT tick, part, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY line) || chr(10) AS payload FROM l GROUP BY 1, 2"
    ),
    "count_documents": (
        f"{LOG}, {VARIANT} SELECT {KEY} AS key, tick, "
        "'[{\"timeStamp\":\"' || " + jts("tick") + " || '\",\"hostName\":\"' || hostName || '\",\"serviceName\":\"' || serviceName "
        "|| '\",\"logType\":\"' || logType || '\",\"count\":\"' || cnt || '\"}]' AS value FROM v"
    ),
    "tick_snapshot": (
        f"{LOG}, {VARIANT} SELECT " + jts("tick") + f" AS key, {PART} AS part, '[' || string_agg('{{\"host_service_logtype\":\"' || "
        f"{KEY} || '\",\"count\":\"' || cnt || '\"}}', ',' ORDER BY {KEY}) || ']' AS value FROM v GROUP BY tick, part"
    ),
    "millis_to_iso": f"WITH {LOGTOPIC} SELECT off, epoch_ms(record_ts) AS ms, strftime(record_ts, {ISO}) AS iso FROM logtopic",
    "iso_to_millis": (
        f"WITH {LOGTOPIC}, i AS (SELECT off, strftime(record_ts, {ISO}) AS iso FROM logtopic) "
        f"SELECT off, iso, epoch_ms(strptime(iso, {ISO})) AS ms FROM i"
    ),
    "record_time_text": f"WITH {LOGTOPIC} SELECT off, {jts('record_ts')} AS ts_text FROM logtopic",
    "points": f"SELECT o_orderkey, {ORDER_LINE} AS line FROM orders",
    "escape_keys": f"SELECT o_orderkey, {esc('o_orderpriority')} AS tag_value FROM orders",
    "escape_strings": f"SELECT event_id, {fesc('props')} AS field_value FROM events",
    "typed_fields": (
        "SELECT l_orderkey, l_linenumber, 'l_linenumber=' || l_linenumber || 'i,l_partkey=' || l_partkey || 'i,l_quantity=' || "
        + fmt("l_quantity") + " || ',l_returnflag=' || " + fesc("l_returnflag") + " AS fields FROM lineitem"
    ),
    "tags_sorted": (
        "SELECT event_id, CASE WHEN event_type = 'signup' THEN '' ELSE ',bucket=a\\,b\\=c' END || ',type=' || "
        + esc("event_type") + " || ',user\\ id=' || user_id AS tags FROM events"
    ),
    "point_time": (
        "SELECT o_orderkey, epoch_ns(o_orderdate) AS time_ns, epoch_ms(o_orderdate) AS time_ms, "
        "epoch_ns(o_orderdate) // 3600000000000 AS time_h, epoch_ms(o_orderdate) * 1000000 AS from_ms_ns FROM orders"
    ),
    "legacy_number_fields": (
        "SELECT c_custkey, 'c_acctbal=' || " + fmt("c_acctbal") + " || ',c_custkey=' || " + fmt("CAST(c_custkey AS DOUBLE)")
        + " || ',c_nationkey=' || " + fmt("CAST(c_nationkey AS DOUBLE)") + " AS fields FROM customer"
    ),
    "invalid_points": (
        "WITH j AS (SELECT d.doc_id, l.quality, l.toxic, d.source, doc_id % 11 = 0 AS no_name, "
        "doc_id % 13 = 0 OR lang IS NULL AS no_lang, doc_id % 17 = 0 OR source IS NULL AS no_note, "
        "doc_id % 19 = 0 OR doc_id % 23 = 0 AS odd FROM documents d LEFT JOIN labels l USING (doc_id)) "
        "SELECT * FROM (SELECT doc_id, CASE WHEN no_name THEN 'empty_measurement' WHEN no_lang OR source IS NULL THEN 'null_tag' "
        "WHEN quality IS NULL AND toxic IS NULL AND NOT odd THEN 'no_fields' WHEN odd THEN 'not_finite' END AS reason, "
        "'numbers' AS point FROM j UNION ALL "
        "SELECT doc_id, CASE WHEN no_name THEN 'empty_measurement' WHEN no_lang THEN 'null_tag' "
        "WHEN no_note THEN 'null_string_field' END, 'texts' FROM j) WHERE reason IS NOT NULL"
    ),
    "batch_tags": (
        "SELECT o_orderkey, 'orders,async=true,o_orderpriority=' || " + esc("o_orderpriority")
        + " || ',o_orderstatus=batch o_custkey=' || o_custkey || 'i,o_orderstatus=' || " + fesc("o_orderstatus")
        + " || ',o_totalprice=' || " + fmt("o_totalprice") + " || ' ' || epoch_ns(o_orderdate) AS line FROM orders"
    ),
    "variant_points": (
        "SELECT event_id, event_type || ',user_id=' || user_id || ' ' || list_aggregate(list_sort(list_filter(["
        "CASE WHEN event_id % 3 = 0 THEN 'a\\ b=' || (event_id % 2 = 0) END, "
        "CASE WHEN event_id % 5 = 0 THEN 'id=' || CASE WHEN event_id % 2 = 0 THEN '\"say \\\"' || user_id || '\\\"\"' ELSE user_id || 'i' END END, "
        "'k=' || CAST(props->>'k' AS BIGINT) || 'i', CASE WHEN event_id % 2 = 0 THEN 'v=' || "
        + fmt("CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE)") + " END], lambda x: x IS NOT NULL)), 'string_agg', ',') "
        "|| ' ' || epoch_ns(ts) AS line FROM events "
        "WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0"
    ),
    "variant_rejects": (
        "SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'no_fields' WHEN event_id % 19 = 0 OR event_id % 13 = 0 THEN 'unreadable_fields' "
        "WHEN event_id % 11 = 0 THEN 'nested_field' END AS reason FROM events "
        "WHERE event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0"
    ),
    "write_batches": (
        f"WITH l AS (SELECT 'orders_' || substr(o_orderpriority, 1, 1) AS db, 'autogen' AS rp, o_orderkey AS id, {ORDER_LINE} AS line "
        "FROM orders), b AS (SELECT *, CAST((row_number() OVER (PARTITION BY db, rp ORDER BY id) - 1) // 100 AS INTEGER) AS batch_no "
        "FROM l) SELECT db, rp, batch_no, count(*) AS n_points, CAST(sum(strlen(line) + 1) AS BIGINT) AS n_bytes, "
        "string_agg(line, chr(10) ORDER BY id) || chr(10) AS payload FROM b GROUP BY 1, 2, 3"
    ),
    "oversize_batches": (
        f"WITH l AS (SELECT 'lineitem_' || l_returnflag AS db, 'autogen' AS rp, l_orderkey * 8 + l_linenumber AS id, "
        f"{LINEITEM_LINE} AS line FROM lineitem), "
        "b AS (SELECT *, CAST((row_number() OVER (PARTITION BY db, rp ORDER BY id, substr(md5(line), 1, 15)) - 1) // 800 AS INTEGER) AS batch_no FROM l) "
        "SELECT db, rp, batch_no, count(*) AS n_points, CAST(sum(strlen(line) + 1) AS BIGINT) AS n_bytes, "
        "sum(strlen(line) + 1) > 65535 AS oversize FROM b GROUP BY 1, 2, 3"
    ),
    "byte_batches": (
        f"WITH RECURSIVE l AS (SELECT 'lineitem_' || l_returnflag AS db, 'autogen' AS rp, l_orderkey * 8 + l_linenumber AS id, "
        f"{LINEITEM_LINE} AS line FROM lineitem UNION ALL SELECT 'lineitem_' || substr('ANR', doc_id % 3 + 1, 1), 'autogen', "
        f"doc_id * 100, line FROM (SELECT doc_id, 'note,source=' || {esc('source')} || ' text=' || {fesc('text')} AS line "
        "FROM documents) WHERE strlen(line) BETWEEN 20000 AND 60000), "
        "s AS MATERIALIZED (SELECT db, rp, strlen(line) + 1 AS n, COALESCE(sum(strlen(line) + 1) OVER (PARTITION BY db, rp "
        "ORDER BY id, substr(md5(line), 1, 15) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM l), "
        "b AS (SELECT DISTINCT db, rp, CAST(0 AS INTEGER) AS batch_no, CAST(0 AS HUGEINT) AS first FROM s UNION ALL "
        "SELECT b.db, b.rp, b.batch_no + 1, min(s.start) FROM b JOIN s ON s.db = b.db AND s.rp = b.rp "
        "AND s.start + s.n > b.first + 65535 GROUP BY b.db, b.rp, b.batch_no) "
        "SELECT s.db, s.rp, b.batch_no, count(*) AS n_points, CAST(sum(n) AS BIGINT) AS n_bytes "
        "FROM s ASOF JOIN b ON s.db = b.db AND s.rp = b.rp AND s.start >= b.first GROUP BY 1, 2, 3"
    ),
    "series_rows": (
        f"WITH {ORDER_SERIES}, d AS (SELECT DISTINCT o_orderkey // 100 AS doc_id FROM orders) "
        "SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN 'timeout in doc ' || doc_id END AS error, CAST(0 AS INTEGER) AS result_idx, "
        f"series_idx, 'orders' AS name, o_orderstatus, row_idx, strftime(o_orderdate, {ISO}) AS time, o_custkey, o_totalprice, "
        "o_orderpriority FROM os "
        "UNION ALL SELECT doc_id, 'partial failure in doc ' || doc_id, 1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL "
        "FROM d WHERE doc_id % 5 = 0 "
        "UNION ALL SELECT -1 - doc_id, 'unreadable document', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL "
        "FROM d WHERE doc_id % 20 = 1 "
        "UNION ALL SELECT -1 - doc_id, NULL, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM d WHERE doc_id % 20 = 2 "
        "UNION ALL SELECT -1 - doc_id, NULL, 0, 0, 'short', NULL, 0, '2000-01-01T00:00:00.000Z', NULL, NULL, NULL "
        "FROM d WHERE doc_id % 20 = 4 "
        "UNION ALL SELECT -1 - doc_id, 'row longer than its header', 0, 0, 'short', NULL, 1, NULL, NULL, NULL, NULL "
        "FROM d WHERE doc_id % 20 = 4"
    ),
    "typed_cells": (
        "WITH k AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS t, CAST(r AS INTEGER) AS row_idx FROM orders, range(2) s(r)), "
        "m AS (SELECT *, (k + row_idx * (k % 2)) % 7 AS m FROM k), "
        "c AS (SELECT k, row_idx, CAST(0 AS INTEGER) AS col_idx, 'n' AS \"column\", CAST(CASE WHEN row_idx = 0 THEN t WHEN k % 3 = 0 THEN 'null' "
        "WHEN k % 3 = 1 THEN t || '.5' ELSE CAST(k + 1 AS VARCHAR) END AS JSON) AS j FROM m UNION ALL "
        "SELECT k, row_idx, 1, 'x', CAST(CASE m WHEN 0 THEN t WHEN 1 THEN '\"' || t || '\"' WHEN 2 THEN t || '.0' "
        "WHEN 3 THEN CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END WHEN 4 THEN 'null' WHEN 5 THEN '{\"a\":[' || t || ']}' "
        "ELSE t || 'e-1' END AS JSON) FROM m), "
        "d AS (SELECT *, CASE json_type(j) WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' "
        "WHEN 'BOOLEAN' THEN 'boolean' WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN 'null' ELSE 'nested' END AS kind FROM c), "
        "a AS (SELECT *, list_sort(list_distinct(list_filter(list(kind) OVER (PARTITION BY k, col_idx), lambda x: x <> 'null'))) AS kinds FROM d) "
        "SELECT k AS doc_id, row_idx, col_idx, \"column\", kind, CASE WHEN len(kinds) = 0 THEN 'null' WHEN len(kinds) = 1 THEN kinds[1] "
        "WHEN kinds = ['integer', 'number'] THEN 'number' ELSE 'mixed' END AS column_kind, "
        "CASE WHEN kind = 'integer' THEN CAST(j AS BIGINT) END AS integer_value, "
        "CASE WHEN kind IN ('integer', 'number') THEN CAST(j AS DOUBLE) END AS number_value, "
        "CASE WHEN kind = 'boolean' THEN CAST(j AS BOOLEAN) END AS boolean_value, "
        "CASE WHEN kind = 'string' THEN j->>'$' WHEN kind = 'nested' THEN CAST(j AS VARCHAR) END AS string_value FROM a"
    ),
    "select_measurement": (
        "SELECT o_orderkey AS point_id, 'o_orderpriority=' || " + esc("o_orderpriority") + " || ',o_orderstatus=' || "
        + esc("o_orderstatus") + " AS series, epoch_ns(o_orderdate) AS time_ns, o_totalprice AS value FROM orders"
    ),
    "group_by_all_tags": (
        "SELECT *, row_number() OVER (PARTITION BY series ORDER BY time_ns, point_id, value) - 1 AS row_idx FROM ("
        "SELECT 'lineitem' AS measurement, 'l_linestatus=' || " + esc("l_linestatus") + " || ',l_returnflag=' || "
        + esc("l_returnflag") + " AS series, epoch_ns(l_shipdate) AS time_ns, l_extendedprice AS value, "
        "l_orderkey * 8 + l_linenumber AS point_id FROM lineitem)"
    ),
    "series_summary": (
        "SELECT 'lineitem' AS measurement, 'l_linestatus=' || " + esc("l_linestatus") + " || ',l_returnflag=' || "
        + esc("l_returnflag") + " AS series, count(*) AS n_points, min(epoch_ns(l_shipdate)) AS first_ns, "
        "max(epoch_ns(l_shipdate)) AS last_ns FROM lineitem GROUP BY 1, 2"
    ),
    "chunked_result": (
        "WITH p AS (SELECT o_orderkey AS point_id, 'o_orderpriority=' || " + esc("o_orderpriority") + " || ',o_orderstatus=' || "
        + esc("o_orderstatus") + " AS series, epoch_ns(o_orderdate) AS time_ns, o_totalprice AS value FROM orders) "
        "SELECT point_id, series, time_ns, value, row_number() OVER (ORDER BY time_ns, point_id) - 1 AS row_idx, "
        "(row_number() OVER (ORDER BY time_ns, point_id) - 1) // 1000 AS chunk FROM p"
    ),
    "result_epoch": (
        f"WITH {ORDER_SERIES} SELECT doc_id, series_idx, row_idx, epoch_ms(o_orderdate) // 1000 AS epoch_s, "
        "epoch_ms(o_orderdate) AS epoch_ms FROM os UNION ALL "
        "SELECT DISTINCT -1 - o_orderkey // 100, 0, 0, 946684800, 946684800000 FROM orders WHERE (o_orderkey // 100) % 20 = 4"
    ),
    "time_range": "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'",
    "result_errors": (
        "WITH d AS (SELECT DISTINCT o_orderkey // 100 AS doc_id FROM orders) "
        "SELECT doc_id, 'query' AS level, CAST(NULL AS INTEGER) AS result_idx, 'timeout in doc ' || doc_id AS error "
        "FROM d WHERE doc_id % 10 = 3 UNION ALL "
        "SELECT doc_id, 'result' AS level, CAST(1 AS INTEGER) AS result_idx, 'partial failure in doc ' || doc_id AS error "
        "FROM d WHERE doc_id % 5 = 0 UNION ALL "
        "SELECT -1 - doc_id, 'query', NULL, 'unreadable document' FROM d WHERE doc_id % 20 = 1 UNION ALL "
        "SELECT -1 - doc_id, 'result', 0, 'row longer than its header' FROM d WHERE doc_id % 20 = 4"
    ),
    "level_count_sql": f"{LOG} SELECT hostName, serviceName, logType, count(logType) AS cnt FROM cdhrolelogs GROUP BY 1, 2, 3",
    "union_levels_sql": f"{LOG} {_union_levels()}",
}
