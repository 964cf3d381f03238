"""Named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (or frames Spark derives from them)
in full; there are no id subsets, prefixes or row caps. The only limit is
:func:`tick_preview`, where showing the first ten rows per tick is the
operator itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logengine.functions import lineproto as lp
from logengine.functions.time import java_timestamp_text, millis_to_iso, iso_to_millis, scale_epoch, to_nanos
from logengine.operators import aggregate as agg
from logengine.operators import batching, parse, points, series, shape, windows
from logengine.plans import sql as sqlsurface
from logengine.session import use_utc
from logengine.sources.logtopic import logtopic
from logengine.sources.points import points_table, series_documents
from logengine.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------------------
# Parameters of the registered queries (shared with the oracles)
# ---------------------------------------------------------------------------
FLAGSHIP_WINDOW = (15, 5)    # window length / slide, seconds
VARIANT_WINDOW = (30, 5)
LONG_WINDOW = (3600, 5)
TICK_S = 5
PREVIEW_ROWS = 10
BATCH_TAGS = {"async": "true", "o_orderstatus": "batch"}
WRITE_BATCH_SIZE = 100
#: Bytes of the long lines that byte batches have among the short ones.
LONG_LINE_BYTES = (20_000, 60_000)
OVERSIZE_BATCH_SIZE = 800
CHUNK_SIZE = 1000
TIME_RANGE_START = "1997-01-01T00:00:00.000Z"
# ---------------------------------------------------------------------------


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    return logtopic(spark, sf)


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_log(_rows(spark, sf))


# -- 2.A / 2.B sources, parsing ------------------------------------------------

def q_log_source(spark, sf):
    return _rows(spark, sf)


def q_header_lines(spark, sf):
    return parse.header_lines(_rows(spark, sf))


def q_parse_log(spark, sf):
    return _records(spark, sf)


def q_log_message(spark, sf):
    return parse.log_message(_rows(spark, sf))


def q_log_event_time(spark, sf):
    return _records(spark, sf).select("off", "lineTimestamp", "event_ts")


def q_series_key(spark, sf):
    return parse.with_series_key(_records(spark, sf)).select("off", "key")


def q_drop_continuations(spark, sf):
    return parse.row_kind_counts(_rows(spark, sf))


def q_tokenize(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return agg.words(docs, "text", keep=("doc_id",))


def q_format_log(spark, sf):
    return parse.format_log(_records(spark, sf))


def q_rejects(spark, sf):
    return parse.rejects(_rows(spark, sf))


# -- 2.C aggregations ------------------------------------------------------------

def q_key_count_per_tick(spark, sf):
    return agg.key_count_per_tick(_records(spark, sf), TICK_S)


def q_word_count(spark, sf):
    return agg.word_count(read_table(spark, sf, "documents", ["text"]), "text")


def q_level_count(spark, sf):
    return agg.level_count(_records(spark, sf))


def q_fixed_level_count(spark, sf):
    return agg.fixed_level_count(_records(spark, sf))


def q_latest_level(spark, sf):
    return agg.latest_level(_records(spark, sf))


def q_running_count(spark, sf):
    return agg.running_count(_rows(spark, sf), TICK_S)


def q_windowed_word_count(spark, sf):
    return agg.windowed_word_count(_rows(spark, sf), *VARIANT_WINDOW)


# -- 2.D windows -------------------------------------------------------------------

def q_tumbling_level_count(spark, sf):
    return windows.tumbling_count(_records(spark, sf), agg.LEVEL_KEYS, TICK_S)


def q_sliding_level_count(spark, sf):
    return windows.sliding_count(_records(spark, sf), agg.LEVEL_KEYS, *FLAGSHIP_WINDOW)


def _variant_counts(spark, sf, parts=0):
    recs = _records(spark, sf).where(F.col("logType").isin(*agg.FIXED_LEVELS))
    return windows.sliding_count(recs, agg.LEVEL_KEYS, *VARIANT_WINDOW, parts=parts)


def q_sliding_fixed_level_count(spark, sf):
    return _variant_counts(spark, sf)


def q_sliding_latest_level(spark, sf):
    return windows.sliding_latest_level(_records(spark, sf), *VARIANT_WINDOW)


def q_hourly_level_count(spark, sf):
    return windows.sliding_count(_records(spark, sf), agg.LEVEL_KEYS, *LONG_WINDOW)


def q_hourly_latest_level(spark, sf):
    return windows.sliding_latest_level(_records(spark, sf), *LONG_WINDOW)


def q_empty_ticks(spark, sf):
    return windows.empty_ticks(_records(spark, sf), ["hostName", "serviceName"], *FLAGSHIP_WINDOW)


# -- 2.E set ops, preview ------------------------------------------------------------

def q_union_levels(spark, sf):
    return agg.union_levels(_records(spark, sf))


def q_tick_preview(spark, sf):
    return agg.tick_preview(agg.key_count_per_tick(_records(spark, sf), TICK_S), PREVIEW_ROWS)


# -- 2.F result shaping -----------------------------------------------------------------

def q_count_lines(spark, sf):
    return shape.count_lines(q_sliding_level_count(spark, sf))


def q_tick_payload(spark, sf):
    counts = windows.sliding_count(_records(spark, sf), agg.LEVEL_KEYS, *FLAGSHIP_WINDOW, parts=shape.TICK_PARTS)
    return shape.tick_payload(shape.count_lines(counts))


def q_count_documents(spark, sf):
    return shape.count_documents(_variant_counts(spark, sf))


def q_tick_snapshot(spark, sf):
    return shape.tick_snapshot(_variant_counts(spark, sf, parts=shape.TICK_PARTS))


# -- 2.J scalar time functions ------------------------------------------------------------

def _ms_rows(spark, sf):
    return _rows(spark, sf).select("off", F.unix_millis("record_ts").alias("ms"))


def q_millis_to_iso(spark, sf):
    return _ms_rows(spark, sf).select("off", "ms", millis_to_iso("ms").alias("iso"))


def q_iso_to_millis(spark, sf):
    iso = _ms_rows(spark, sf).select("off", millis_to_iso("ms").alias("iso"))
    return iso.select("off", "iso", iso_to_millis("iso").alias("ms"))


def q_record_time_text(spark, sf):
    return _rows(spark, sf).select("off", java_timestamp_text("record_ts").alias("ts_text"))


# -- 2.G points -------------------------------------------------------------------------------

def _orders(spark, sf):
    use_utc(spark)
    return read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])


ORDER_FIELDS = ["o_custkey", "o_totalprice", "o_orderstatus"]


def q_points(spark, sf):
    o = _orders(spark, sf)
    return points.encode_points(o, "orders", ORDER_FIELDS, tags=["o_orderpriority"], time_col="o_orderdate", keep=["o_orderkey"])


def q_escape_keys(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", lp.escape_key("o_orderpriority").alias("tag_value"))


def q_escape_strings(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "props"])
    return ev.select("event_id", lp.quoted_string("props").alias("field_value"))


def q_typed_fields(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"])
    specs = lp.field_specs(li.schema, ["l_linenumber", "l_partkey", "l_quantity", "l_returnflag"])
    return li.select("l_orderkey", "l_linenumber", lp.fields_text(specs).alias("fields"))


def q_tags_sorted(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "event_type"])
    tags = F.create_map(
        F.lit("type"), F.col("event_type"),
        F.lit("user id"), F.col("user_id").cast("string"),
        F.lit("bucket"), F.when(F.col("event_type") == "signup", F.lit("")).otherwise(F.lit("a,b=c")),
    )
    return ev.select("event_id", lp.tags_text_from_map(tags).alias("tags"))


def q_point_time(spark, sf):
    o = _orders(spark, sf)
    ns = points.time_ns(o, "o_orderdate")
    ms = scale_epoch(ns, "MILLISECONDS")
    return o.select(
        "o_orderkey",
        ns.alias("time_ns"),
        ms.alias("time_ms"),
        scale_epoch(ns, "HOURS").alias("time_h"),
        to_nanos(ms, "MILLISECONDS").alias("from_ms_ns"),
    )


def q_legacy_number_fields(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    specs = lp.field_specs(c.schema, ["c_custkey", "c_nationkey", "c_acctbal"])
    return c.select("c_custkey", lp.fields_text(specs, legacy_numbers=True).alias("fields"))


def q_invalid_points(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "lang", "source"])
    labels = read_table(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    j = docs.join(labels, "doc_id", "left")
    d = F.col("doc_id")
    j = j.select(
        "doc_id", "source", "quality", "toxic",
        F.when(F.pmod(d, F.lit(11)) == 0, F.lit("")).otherwise(F.lit("doc_labels")).alias("m"),
        F.when(F.pmod(d, F.lit(13)) != 0, F.col("lang")).alias("lang"),
        F.when(F.pmod(d, F.lit(17)) != 0, F.col("source")).alias("note"),
        F.when(F.pmod(d, F.lit(19)) == 0, F.lit(float("nan"))).when(F.pmod(d, F.lit(23)) == 0, F.lit(float("inf")))
        .alias("ratio"),
    )
    numbers = points.invalid_points(j, F.col("m"), ["quality", "toxic", "ratio"], tags=["lang", "source"], keep=["doc_id"])
    texts = points.invalid_points(j, F.col("m"), ["note", "quality"], tags=["lang"], keep=["doc_id"])
    return numbers.withColumn("point", F.lit("numbers")).unionByName(texts.withColumn("point", F.lit("texts")))


def q_batch_tags(spark, sf):
    o = _orders(spark, sf)
    return points.encode_points(
        o, "orders", ORDER_FIELDS, tags=["o_orderpriority", "o_orderstatus"], time_col="o_orderdate",
        batch_tags=BATCH_TAGS, keep=["o_orderkey"],
    )


def _field_sets(spark, sf):
    """Events whose fields are JSON objects: another set for each row, and types by value."""
    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])

    def every(n, text):
        return F.when(F.col("event_id") % n == 0, text).otherwise(F.lit(""))

    user = F.col("user_id").cast("string")
    json = F.concat(
        F.expr("substring(props, 1, length(props) - 1)"),
        every(2, F.concat(F.lit(', "v": '), F.col("value").cast("decimal(18,2)").cast("string"))),
        every(3, F.concat(F.lit(', "a b": '), (F.col("event_id") % 2 == 0).cast("string"))),
        every(5, F.concat(F.lit(', "id": '), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('"say \\"'), user, F.lit('\\""'))).otherwise(user))),
        every(7, F.lit(', "gone": null')),
        every(11, F.lit(', "nest": {"a": [1]}')),
        F.when(F.col("event_id") % 13 == 0, F.lit(", oops")).otherwise(F.lit("}")),
    )
    only_null = F.when(F.col("event_id") % 17 == 0, F.lit('{"gone": null}')).when(F.col("event_id") % 19 == 0, F.lit("[1, 2]")).otherwise(json)
    return e.select("event_id", "ts", "user_id", "event_type", F.try_parse_json(only_null).alias("fields"))


def q_variant_points(spark, sf):
    return points.encode_variant_points(_field_sets(spark, sf), F.col("event_type"), "fields", tags=["user_id"], time_col="ts",
                                        keep=["event_id"])


def q_variant_rejects(spark, sf):
    return points.invalid_variant_points(_field_sets(spark, sf), F.col("event_type"), "fields", tags=["user_id"], keep=["event_id"])


# -- 2.H batching ---------------------------------------------------------------------------------

def _order_lines(spark, sf):
    o = _orders(spark, sf)
    lines = points.encode_points(o, "orders", ORDER_FIELDS, tags=["o_orderpriority"], time_col="o_orderdate",
                                 keep=["o_orderkey", "o_orderpriority"])
    return lines.select(
        F.concat(F.lit("orders_"), F.substring("o_orderpriority", 1, 1)).alias("db"),
        F.lit(batching.DEFAULT_RETENTION_POLICY).alias("rp"),
        F.col("o_orderkey").alias("id"),
        "line",
    )


def _lineitem_lines(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                            "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"])
    lines = points.encode_points(
        li, "lineitem", ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"],
        tags=["l_returnflag", "l_linestatus"], time_col="l_shipdate", keep=["l_orderkey", "l_linenumber", "l_returnflag"],
    )
    return lines.select(
        F.concat(F.lit("lineitem_"), F.col("l_returnflag")).alias("db"),
        F.lit(batching.DEFAULT_RETENTION_POLICY).alias("rp"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        "line",
    )


def _mixed_lines(spark, sf):
    """The line items, and among them lines that hold a text of tens of kilobytes."""
    docs = read_table(spark, sf, "documents", ["doc_id", "text", "source"])
    notes = points.encode_points(docs, "note", ["text"], tags=["source"], keep=["doc_id"], with_time=False).where(
        F.octet_length("line").between(*LONG_LINE_BYTES))
    return _lineitem_lines(spark, sf).unionByName(notes.select(
        F.concat(F.lit("lineitem_"), F.substring(F.lit("ANR"), (F.col("doc_id") % 3 + 1).cast("int"), F.lit(1))).alias("db"),
        F.lit(batching.DEFAULT_RETENTION_POLICY).alias("rp"),
        (F.col("doc_id") * 100).alias("id"),
        "line",
    ))


def q_write_batches(spark, sf):
    return batching.write_batches(_order_lines(spark, sf), WRITE_BATCH_SIZE)


def q_oversize_batches(spark, sf):
    return batching.oversize_batches(_lineitem_lines(spark, sf), OVERSIZE_BATCH_SIZE)


def q_byte_batches(spark, sf):
    return batching.byte_batches(_mixed_lines(spark, sf), batching.DATAGRAM_LIMIT)


# -- 2.A4 / 2.I series ------------------------------------------------------------------------------

def _series_rows(spark, sf):
    return series.series_rows(series_documents(spark, sf))


def q_series_rows(spark, sf):
    r = _series_rows(spark, sf)
    return r.select(
        "doc_id", "error", "result_idx", "series_idx", "name",
        F.col("tags")["o_orderstatus"].alias("o_orderstatus"),
        "row_idx",
        F.col("cells")["time"].alias("time"),
        F.col("cells")["o_custkey"].try_cast("long").alias("o_custkey"),
        F.col("cells")["o_totalprice"].try_cast("double").alias("o_totalprice"),
        F.col("cells")["o_orderpriority"].alias("o_orderpriority"),
    )


def _typed_documents(spark, sf):
    """One result document per order: a column of integers and numbers, one of cells of any type."""
    o = read_table(spark, sf, "orders", ["o_orderkey"])
    k = F.col("o_orderkey")
    text = k.cast("string")

    def any_cell(m):
        return (
            F.when(m == 0, text).when(m == 1, F.concat(F.lit('"'), text, F.lit('"'))).when(m == 2, F.concat(text, F.lit(".0")))
            .when(m == 3, (k % 2 == 0).cast("string")).when(m == 4, F.lit("null"))
            .when(m == 5, F.concat(F.lit('{"a":['), text, F.lit("]}"))).otherwise(F.concat(text, F.lit("e-1")))
        )

    second = F.when(k % 3 == 0, F.lit("null")).when(k % 3 == 1, F.concat(text, F.lit(".5"))).otherwise((k + 1).cast("string"))
    body = F.concat(
        F.lit('{"results":[{"series":[{"name":"typed","columns":["n","x"],"values":[['), text, F.lit(","), any_cell(k % 7),
        F.lit("],["), second, F.lit(","), any_cell((k + k % 2) % 7), F.lit("]]}]}]}"),
    )
    return o.select(k.alias("doc_id"), body.alias("body"))


def q_typed_cells(spark, sf):
    return series.typed_cells(_typed_documents(spark, sf)).drop("result_idx", "series_idx", "name", "error")


def q_select_measurement(spark, sf):
    p = series.with_series(series.select_measurement(points_table(spark, sf), "orders"))
    return p.select("point_id", "series", "time_ns", "value")


def q_group_by_all_tags(spark, sf):
    return series.group_by_all_tags(points_table(spark, sf), "lineitem")


def q_series_summary(spark, sf):
    return series.series_summary(points_table(spark, sf), "lineitem")


def q_chunked_result(spark, sf):
    c = series.chunked_result(points_table(spark, sf), "orders", CHUNK_SIZE, columns=["point_id", "series", "value"])
    return c.select("point_id", "series", "time_ns", "value", "row_idx", "chunk")


def q_result_epoch(spark, sf):
    r = _series_rows(spark, sf).select("doc_id", "series_idx", "row_idx", F.col("cells")["time"].alias("time"))
    r = r.where(F.col("time").isNotNull())
    r = series.result_epoch(series.result_epoch(r, "time", "SECONDS", "epoch_s"), "time", "MILLISECONDS", "epoch_ms")
    return r.drop("time")


def q_time_range(spark, sf):
    return series.time_range(_orders(spark, sf), TIME_RANGE_START, "o_orderdate").select("o_orderkey", "o_orderdate")


def q_result_errors(spark, sf):
    return series.result_errors(series_documents(spark, sf))


# -- 2.L SQL surface --------------------------------------------------------------------------------------

def q_level_count_sql(spark, sf):
    sqlsurface.register_cdhrolelogs(spark, _records(spark, sf))
    return sqlsurface.level_count_sql(spark)


def q_union_levels_sql(spark, sf):
    sqlsurface.register_cdhrolelogs(spark, _records(spark, sf))
    return sqlsurface.union_levels_sql(spark)


QUERIES: dict[str, Query] = {
    "log_source": q_log_source,
    "header_lines": q_header_lines,
    "parse_log": q_parse_log,
    "log_message": q_log_message,
    "log_event_time": q_log_event_time,
    "series_key": q_series_key,
    "drop_continuations": q_drop_continuations,
    "tokenize": q_tokenize,
    "format_log": q_format_log,
    "rejects": q_rejects,
    "key_count_per_tick": q_key_count_per_tick,
    "word_count": q_word_count,
    "level_count": q_level_count,
    "fixed_level_count": q_fixed_level_count,
    "latest_level": q_latest_level,
    "running_count": q_running_count,
    "windowed_word_count": q_windowed_word_count,
    "tumbling_level_count": q_tumbling_level_count,
    "sliding_level_count": q_sliding_level_count,
    "sliding_fixed_level_count": q_sliding_fixed_level_count,
    "sliding_latest_level": q_sliding_latest_level,
    "hourly_level_count": q_hourly_level_count,
    "hourly_latest_level": q_hourly_latest_level,
    "empty_ticks": q_empty_ticks,
    "union_levels": q_union_levels,
    "tick_preview": q_tick_preview,
    "count_lines": q_count_lines,
    "tick_payload": q_tick_payload,
    "count_documents": q_count_documents,
    "tick_snapshot": q_tick_snapshot,
    "millis_to_iso": q_millis_to_iso,
    "iso_to_millis": q_iso_to_millis,
    "record_time_text": q_record_time_text,
    "points": q_points,
    "escape_keys": q_escape_keys,
    "escape_strings": q_escape_strings,
    "typed_fields": q_typed_fields,
    "tags_sorted": q_tags_sorted,
    "point_time": q_point_time,
    "legacy_number_fields": q_legacy_number_fields,
    "invalid_points": q_invalid_points,
    "batch_tags": q_batch_tags,
    "variant_points": q_variant_points,
    "variant_rejects": q_variant_rejects,
    "write_batches": q_write_batches,
    "oversize_batches": q_oversize_batches,
    "byte_batches": q_byte_batches,
    "series_rows": q_series_rows,
    "typed_cells": q_typed_cells,
    "select_measurement": q_select_measurement,
    "group_by_all_tags": q_group_by_all_tags,
    "series_summary": q_series_summary,
    "chunked_result": q_chunked_result,
    "result_epoch": q_result_epoch,
    "time_range": q_time_range,
    "result_errors": q_result_errors,
    "level_count_sql": q_level_count_sql,
    "union_levels_sql": q_union_levels_sql,
}
