"""Series queries: read query-result documents as rows, and the query
shapes callers use (select a measurement, group by all tags, chunks,
epoch units, time range, errors) as DataFrame operators over points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logengine.functions.lineproto import render_tag_entries, tag_entries, variant_kind
from logengine.functions.time import iso_to_millis, scale_epoch
from logengine.operators.numbering import ordinal_within

UNREADABLE = "unreadable document"
UNEVEN = "row longer than its header"

RESULT_SCHEMA = (
    "results ARRAY<STRUCT<series: ARRAY<STRUCT<name: STRING, tags: MAP<STRING,STRING>, "
    "columns: ARRAY<STRING>, values: ARRAY<ARRAY<STRING>>>>, error: STRING>>, error STRING"
)


# Kept apart in the JSON options: a body that does not parse becomes a row
# whose ``_bad`` holds it, instead of a null.
_PARSE_SCHEMA = RESULT_SCHEMA + ", _bad STRING"
# The same with cells that keep the type they have in the document.
_TYPED_SCHEMA = _PARSE_SCHEMA.replace("ARRAY<ARRAY<STRING>>", "ARRAY<ARRAY<VARIANT>>")


def parse_results(docs: DataFrame, body_col: str = "body", id_col: str = "doc_id", typed: bool = False) -> DataFrame:
    """``(doc_id, _r, _unreadable)``: the parsed document and whether its
    body is null or no JSON object of the expected shape. ``typed`` keeps
    cells as VARIANT instead of text."""
    schema = _TYPED_SCHEMA if typed else _PARSE_SCHEMA
    parsed = F.from_json(F.col(body_col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    r = docs.select(id_col, parsed.alias("_r"))
    return r.withColumn("_unreadable", F.col("_r").isNull() | F.col("_r._bad").isNotNull())


def series_rows(docs: DataFrame, body_col: str = "body", id_col: str = "doc_id") -> DataFrame:
    """One row per series value: ``(doc_id, result_idx, series_idx, name,
    tags, row_idx, cells, error)`` where ``cells`` maps header column → cell
    text. Documents without results, results without series and series
    without values keep one row with nulls from there on; ``error`` is the
    statement's error, else the query's. A short row has null cells for the
    columns it lacks; a row longer than its header, and a body that cannot
    be read, say so in ``error`` and have no cells. All nested work is per
    document (explode / zip), no shuffle."""
    r = parse_results(docs, body_col, id_col).select(
        id_col, "_r", F.when(F.col("_unreadable"), F.lit(UNREADABLE)).otherwise(F.col("_r.error")).alias("_error")
    )
    res = r.select(id_col, "_error", F.posexplode_outer(F.col("_r.results")).alias("result_idx", "_res"))
    ser = res.select(
        id_col, "result_idx", F.coalesce("_res.error", "_error").alias("_error"),
        F.posexplode_outer("_res.series").alias("series_idx", "_s"),
    )
    vals = ser.select(
        id_col, "result_idx", "series_idx", "_error",
        F.col("_s.name").alias("name"), F.col("_s.tags").alias("tags"), F.col("_s.columns").alias("_cols"),
        F.posexplode_outer("_s.values").alias("row_idx", "_v"),
    )
    header = F.coalesce(F.col("_cols"), F.array().cast("array<string>"))
    fits = F.size("_v") <= F.size(header)
    cells = F.map_from_entries(F.transform(header, lambda c, i: F.struct(c, F.get(F.col("_v"), i))))
    return vals.select(
        id_col, "result_idx", "series_idx", "name", "tags", "row_idx",
        F.when(F.col("_v").isNotNull() & fits, cells).alias("cells"),
        F.when(F.col("_v").isNotNull() & ~fits, F.lit(UNEVEN)).otherwise(F.col("_error")).alias("error"),
    )


def _merged_kind(kinds: Column) -> Column:
    """The kind of a column whose cells have these kinds: nulls have no say,
    integers and numbers are numbers, other mixtures are ``mixed``."""
    own = F.array_distinct(F.filter(kinds, lambda k: k != "null"))
    return (
        F.when(F.size(own) == 0, F.lit("null"))
        .when(F.size(own) == 1, F.get(own, F.lit(0)))
        .when(F.forall(own, lambda k: k.isin("integer", "number")), F.lit("number"))
        .otherwise(F.lit("mixed"))
    )


def typed_cells(docs: DataFrame, body_col: str = "body", id_col: str = "doc_id") -> DataFrame:
    """One row per cell, with the type that the document gives it:
    ``(doc_id, result_idx, series_idx, name, row_idx, col_idx, column, kind,
    column_kind, integer_value, number_value, boolean_value, string_value,
    error)``.

    ``kind`` is ``integer``, ``number``, ``boolean``, ``string``, ``null``
    (also a cell that a short row lacks) or ``nested`` (its JSON is in
    ``string_value``); ``5``, ``5.0`` and ``"5"`` differ. Integers are in
    ``number_value`` too. ``column_kind`` is the merged kind of the column
    over all rows of the series that fit their header. Documents, results
    and series without cells, unreadable bodies and uneven rows keep one row
    as in :func:`series_rows`. All work is per document, no shuffle."""
    r = parse_results(docs, body_col, id_col, typed=True).select(
        id_col, "_r", F.when(F.col("_unreadable"), F.lit(UNREADABLE)).otherwise(F.col("_r.error")).alias("_error")
    )
    res = r.select(id_col, "_error", F.posexplode_outer("_r.results").alias("result_idx", "_res"))
    ser = res.select(
        id_col, "result_idx", F.coalesce("_res.error", "_error").alias("_error"),
        F.posexplode_outer("_res.series").alias("series_idx", "_s"),
    )
    header = F.coalesce(F.col("_s.columns"), F.array().cast("array<string>"))
    fitting = F.filter("_s.values", lambda v: F.size(v) <= F.size(header))
    kinds = F.transform(header, lambda c, i: _merged_kind(F.transform(fitting, lambda v: variant_kind(F.get(v, i)))))
    vals = ser.select(
        id_col, "result_idx", "series_idx", "_error", F.col("_s.name").alias("name"),
        header.alias("_cols"), kinds.alias("_kinds"), F.posexplode_outer("_s.values").alias("row_idx", "_v"),
    )
    fits = F.size("_v") <= F.size("_cols")
    cells = F.transform("_cols", lambda c, i: F.struct(
        c.alias("column"), F.get(F.col("_kinds"), i).alias("kind"), F.get(F.col("_v"), i).alias("value")))
    each = vals.select(
        id_col, "result_idx", "series_idx", "name", "row_idx",
        F.when(F.col("_v").isNotNull() & ~fits, F.lit(UNEVEN)).otherwise(F.col("_error")).alias("error"),
        F.posexplode_outer(F.when(F.col("_v").isNotNull() & fits, cells)).alias("col_idx", "_c"),
    )
    each = each.select("*", F.col("_c.column").alias("column"), F.col("_c.kind").alias("column_kind"), F.col("_c.value").alias("_x"))
    each = each.withColumn("kind", F.when(F.col("column").isNotNull(), variant_kind(F.col("_x"))))

    def value(type_: str, *kinds: str) -> Column:
        return F.when(F.col("kind").isin(*kinds), F.try_variant_get("_x", "$", type_))

    return each.select(
        id_col, "result_idx", "series_idx", "name", "row_idx", "col_idx", "column", "kind", "column_kind",
        value("bigint", "integer").alias("integer_value"), value("double", "integer", "number").alias("number_value"),
        value("boolean", "boolean").alias("boolean_value"), value("string", "string", "nested").alias("string_value"),
        "error",
    )


def _uneven(res: Column) -> Column:
    """Some row of some series of a result has more cells than its header."""
    def long_row(s: Column) -> Column:
        width = F.coalesce(F.size(s["columns"]), F.lit(0))
        return F.coalesce(F.exists(s["values"], lambda v: F.size(v) > F.greatest(width, F.lit(0))), F.lit(False))

    return F.coalesce(F.exists(res["series"], long_row), F.lit(False))


def result_errors(docs: DataFrame, body_col: str = "body", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, level, result_idx, error)``: failed results at the query
    level (``result_idx`` null; a body that cannot be read is one) and the
    per-statement level (an uneven row of its series is one), in one pass
    over the documents (one candidate array per document, inlined)."""
    r = parse_results(docs, body_col, id_col)
    query_error = F.when(F.col("_unreadable"), F.lit(UNREADABLE)).otherwise(F.col("_r.error"))
    query_level = F.array(F.struct(
        F.lit("query").alias("level"), F.lit(None).cast("int").alias("result_idx"), query_error.alias("error")))
    statement_level = F.transform(
        F.coalesce(F.col("_r.results"), F.array().cast(r.schema["_r"].dataType["results"].dataType)),
        lambda res, i: F.struct(
            F.lit("result").alias("level"), i.alias("result_idx"),
            F.coalesce(res["error"], F.when(_uneven(res), F.lit(UNEVEN))).alias("error")),
    )
    return (
        r.select(id_col, F.inline(F.concat(query_level, statement_level)))
        .where(F.col("error").isNotNull())
    )


def select_measurement(points: DataFrame, measurement: str) -> DataFrame:
    """``SELECT * FROM m``: the measurement's points (filter is pushed to
    the scan when ``points`` is a table with a measurement column)."""
    return points.where(F.col("measurement") == F.lit(measurement))


def with_series(points: DataFrame) -> DataFrame:
    """Add ``series``: canonical text of the tag set (sorted ``k=v``)."""
    return points.withColumn("series", render_tag_entries(tag_entries("tags"), sep_first=False))


def group_by_all_tags(points: DataFrame, measurement: str, tie_breakers: Sequence[str] = ("point_id",)) -> DataFrame:
    """``SELECT * FROM m GROUP BY *``: the rows of every series (distinct tag
    set), ``(measurement, series, row_idx, time_ns, value, *tie_breakers)``,
    numbered in time order within their series. A series may be as hot as
    the measurement: :func:`ordinal_within` spreads it; nothing is collected
    per series."""
    s = with_series(select_measurement(points, measurement)).select(
        "measurement", "series", "time_ns", "value", *tie_breakers
    )
    return ordinal_within(s, ["measurement", "series"], ["time_ns", *tie_breakers, "value"], out_col="row_idx")


def series_summary(points: DataFrame, measurement: str) -> DataFrame:
    """The series of a measurement in short: one row per distinct tag
    set with its point count and time range. Rows are grouped by the
    sorted tag entries (partial aggregate; a hot series costs one row per
    task before the shuffle) and the series text is rendered once per
    group, not once per row."""
    return (
        select_measurement(points, measurement)
        .groupBy("measurement", tag_entries("tags").alias("_k"))
        .agg(
            F.count(F.lit(1)).alias("n_points"),
            F.min("time_ns").alias("first_ns"),
            F.max("time_ns").alias("last_ns"),
        )
        .select("measurement", render_tag_entries(F.col("_k"), sep_first=False).alias("series"),
                "n_points", "first_ns", "last_ns")
    )


def chunked_result(points: DataFrame, measurement: str, chunk_size: int, group_by_tags: bool = False,
                   tie_breakers: Sequence[str] = ("point_id",), columns: Sequence[str] | None = None) -> DataFrame:
    """Result rows cut into chunks of ``chunk_size`` in time order: 3 rows
    with size 2 give chunk 0 (2 rows) and chunk 1 (1 row).

    ``SELECT * FROM m`` (default) is one series holding every point of the
    measurement, i.e. one group as hot as the measurement itself;
    ``group_by_tags=True`` is ``GROUP BY *`` and chunks each tag set on its
    own. Ordinals come from :func:`ordinal_within`, so even the single
    whole-measurement group is split over many tasks instead of sorted in
    one. ``columns`` narrows what is carried through the numbering."""
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")
    s = with_series(select_measurement(points, measurement))
    group = ["series"] if group_by_tags else ["measurement"]
    if columns is not None:  # carry only what is asked for through the shuffle
        need = list(dict.fromkeys([*group, "time_ns", *tie_breakers, *columns]))
        s = s.select(*need)
    o = ordinal_within(s, group, ["time_ns", *tie_breakers], out_col="row_idx")
    return o.withColumn("chunk", F.floor(F.col("row_idx") / F.lit(chunk_size)).cast("long"))


def result_epoch(rows: DataFrame, time_col: str, unit: str, out_col: str = "epoch") -> DataFrame:
    """Times as epoch numbers in ``unit`` (from ISO text)."""
    ns = iso_to_millis(F.col(time_col)) * F.lit(1_000_000)
    return rows.withColumn(out_col, scale_epoch(ns, unit))


def time_range(points: DataFrame, start_iso: str, time_col: str = "time") -> DataFrame:
    """``WHERE time >= '<iso>'``; on a table scan this reaches Parquet as a
    pushed filter."""
    return points.where(F.col(time_col) >= F.to_timestamp(F.lit(start_iso)).cast(points.schema[time_col].dataType))
