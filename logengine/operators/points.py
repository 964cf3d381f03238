"""Encode a whole table or stream as time-series points (line protocol).

One projection per row; no shuffle. The encoding rule per field comes
from the column's Spark type, decided once when the plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logengine.functions.lineproto import (
    field_specs,
    fields_text,
    merge_batch_tags,
    point_line,
    tags_text_from_columns,
    tags_text_from_map,
    variant_fields,
    variant_fields_text,
)
from logengine.functions.time import epoch_us_ntz, to_nanos


def time_ns(df: DataFrame, time_col: str | None, unit: str = "NANOSECONDS") -> Column:
    """Point time in ns: timestamps exactly, integer epochs scaled from
    ``unit``; no column, or a null in it, means the current time in ms (as
    the builder)."""
    if time_col is None:
        return F.unix_millis(F.current_timestamp()) * F.lit(1_000_000)
    dtype = df.schema[time_col].dataType
    c = F.col(time_col)
    if isinstance(dtype, T.TimestampType):
        ns = F.unix_micros(c) * F.lit(1000)
    elif isinstance(dtype, T.TimestampNTZType):
        ns = epoch_us_ntz(c) * F.lit(1000)
    elif isinstance(dtype, T.DateType):
        ns = epoch_us_ntz(c.cast("timestamp_ntz")) * F.lit(1000)
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        ns = to_nanos(c.cast("long"), unit)
    else:
        raise TypeError(f"time column must be a timestamp, date or integer epoch, got {dtype.simpleString()}")
    return F.coalesce(ns, F.unix_millis(F.current_timestamp()) * F.lit(1_000_000))


def encode_points(
    df: DataFrame,
    measurement: str | Column,
    fields: Sequence[str],
    tags: Sequence[str] | Mapping[str, str] = (),
    tags_map: str | None = None,
    time_col: str | None = None,
    time_unit: str = "NANOSECONDS",
    legacy_numbers: bool = False,
    batch_tags: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
    with_time: bool = True,
) -> DataFrame:
    """``(*keep, line)``: one line-protocol point per valid row; rows that
    cannot become a point are left to :func:`invalid_points`, called with
    the same arguments, so every row is in exactly one of the two.

    ``tags`` are column names (tag key = column name) or ``{key: column}``;
    ``tags_map`` is a ``MAP<STRING,STRING>`` column for dynamic tag sets.
    ``batch_tags`` are merged into every point and win over point values.
    """
    tag_cols = dict(tags) if isinstance(tags, Mapping) else {t: t for t in tags}
    if tags_map is not None or batch_tags:
        m = F.col(tags_map) if tags_map else F.create_map().cast("map<string,string>")
        if tag_cols:
            m = F.map_concat(
                F.map_filter(m, lambda k, v: ~F.array_contains(F.array(*[F.lit(k2) for k2 in tag_cols]), k)),
                F.create_map(*[x for k, c in tag_cols.items() for x in (F.lit(k), F.col(c).cast("string"))]),
            )
        tags_text = tags_text_from_map(merge_batch_tags(m, batch_tags or {}))
    else:
        tags_text = tags_text_from_columns({k: F.col(c).cast("string") for k, c in tag_cols.items()})
    ftxt = fields_text(field_specs(df.schema, fields), legacy_numbers=legacy_numbers)
    t = time_ns(df, time_col, time_unit) if with_time else None
    reason = invalid_reason(df, measurement, fields, tags, tags_map)
    return df.where(reason.isNull()).select(*keep, point_line(measurement, tags_text, ftxt, t).alias("line"))


def invalid_points(
    df: DataFrame,
    measurement: str | Column,
    fields: Sequence[str],
    tags: Sequence[str] | Mapping[str, str] = (),
    keep: Sequence[str] = (),
    tags_map: str | None = None,
) -> DataFrame:
    """``(*keep, reason)`` for rows that cannot become a point. These go to
    a rejects output instead of failing."""
    reason = invalid_reason(df, measurement, fields, tags, tags_map)
    return df.select(*keep, reason.alias("reason")).where(F.col("reason").isNotNull())


def invalid_reason(
    df: DataFrame,
    measurement: str | Column,
    fields: Sequence[str],
    tags: Sequence[str] | Mapping[str, str] = (),
    tags_map: str | None = None,
) -> Column:
    """Why a row cannot become a point, or null: empty measurement, a null
    tag value, a null string field, a field that is not a finite number, or
    no non-null field at all. The encoder and the rejects share it."""
    tags = list(tags.values()) if isinstance(tags, Mapping) else list(tags)
    m = F.lit(measurement) if isinstance(measurement, str) else measurement
    types = {f.name: f.dataType for f in df.schema.fields}
    null_string = [F.col(f).isNull() for f in fields if isinstance(types[f], T.StringType)]
    null_tag = [F.col(t).isNull() for t in tags]
    if tags_map is not None:
        null_tag.append(F.coalesce(F.exists(F.map_values(F.col(tags_map)), lambda v: v.isNull()), F.lit(False)))
    not_finite = [
        F.isnan(F.col(f)) | F.col(f).isin(float("inf"), float("-inf"))
        for f in fields if isinstance(types[f], (T.FloatType, T.DoubleType))
    ]
    any_field = F.lit(False)
    for f in fields:
        any_field = any_field | F.col(f).isNotNull()
    reason = F.when(m.isNull() | (m == F.lit("")), F.lit("empty_measurement"))
    if null_tag:
        reason = reason.when(_any(null_tag), F.lit("null_tag"))
    if null_string:
        reason = reason.when(_any(null_string), F.lit("null_string_field"))
    reason = reason.when(~any_field, F.lit("no_fields"))
    if not_finite:
        reason = reason.when(_any([F.coalesce(c, F.lit(False)) for c in not_finite]), F.lit("not_finite"))
    return reason


def _variant_parts(df: DataFrame, measurement: str | Column, fields: str, tags: Sequence[str]) -> tuple[DataFrame, Column]:
    """Rows with ``_entries``, and why one of them cannot become a point."""
    parts = df.withColumn("_entries", variant_fields(fields))
    m = F.lit(measurement) if isinstance(measurement, str) else measurement
    entries = F.col("_entries")
    reason = F.when(m.isNull() | (m == F.lit("")), F.lit("empty_measurement"))
    if tags:
        reason = reason.when(_any([F.col(t).isNull() for t in tags]), F.lit("null_tag"))
    return parts, (
        reason.when(entries.isNull(), F.lit("unreadable_fields"))
        .when(F.exists(entries, lambda e: e["kind"] == "nested"), F.lit("nested_field"))
        .when(~F.exists(entries, lambda e: e["text"].isNotNull()), F.lit("no_fields"))
    )


def encode_variant_points(df: DataFrame, measurement: str | Column, fields: str, tags: Sequence[str] = (),
                          time_col: str | None = None, time_unit: str = "NANOSECONDS", keep: Sequence[str] = (),
                          with_time: bool = True) -> DataFrame:
    """``(*keep, line)``: points whose fields are an object in a VARIANT
    column (``parse_json``, ``to_variant_object`` or a VARIANT table column):
    each row has its own set of fields, each value its own type. Nulls are
    skipped; rows that are no point are in :func:`invalid_variant_points`."""
    parts, reason = _variant_parts(df, measurement, fields, tags)
    t = time_ns(df, time_col, time_unit) if with_time else None
    tags_text = tags_text_from_columns({k: F.col(k).cast("string") for k in tags})
    line = point_line(measurement, tags_text, variant_fields_text(F.col("_entries")), t)
    return parts.where(reason.isNull()).select(*keep, line.alias("line"))


def invalid_variant_points(df: DataFrame, measurement: str | Column, fields: str, tags: Sequence[str] = (),
                           keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, reason)`` of the rows that :func:`encode_variant_points` leaves out."""
    parts, reason = _variant_parts(df, measurement, fields, tags)
    return parts.select(*keep, reason.alias("reason")).where(F.col("reason").isNotNull())


def _any(cs: list[Column]) -> Column:
    out = cs[0]
    for c in cs[1:]:
        out = out | c
    return out
