"""Time-series line protocol as column expressions.

``measurement[,tag=v...] field=v[,field=v...] <time ns>`` built with
``concat`` / ``concat_ws`` / ``regexp_replace`` / ``format_number``: a
per-row expression that runs in whole-stage codegen over a whole table
or stream. The field encoding is chosen per column from the Spark type at
plan time (a fixed schema per frame), or per entry for map-typed tags.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------
# Key escaper: space, comma and '=' get a backslash (measurement, tag keys,
# tag values, field keys).
KEY_SPECIALS = " ,="
# Field string escaper: backslash and double quote get a backslash.
FIELD_SPECIALS = '\\"'
# Floating fields: no grouping, at least 1 and at most 340 fraction digits,
# never scientific notation.
MIN_FRACTION_DIGITS = 1
MAX_FRACTION_DIGITS = 340
# Suffix of integer fields.
INTEGER_SUFFIX = "i"
# ---------------------------------------------------------------------------

DECIMAL_PATTERN = "0." + "0" * MIN_FRACTION_DIGITS + "#" * (MAX_FRACTION_DIGITS - MIN_FRACTION_DIGITS)

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _has_any(c: Column, chars: str) -> Column:
    out = None
    for ch in chars:
        t = c.contains(ch)
        out = t if out is None else out | t
    return out


def escape_key(c: Column | str) -> Column:
    """Backslash before each space, comma and ``=``. The regex runs only
    when a byte search finds one of them (most keys have none)."""
    c = _c(c)
    return F.when(_has_any(c, KEY_SPECIALS), F.regexp_replace(c, "([ ,=])", "\\\\$1")).otherwise(c)


def escape_field_string(c: Column | str) -> Column:
    """Backslash before each backslash and double quote (one pass), with
    the same byte-search fast path."""
    c = _c(c)
    return F.when(_has_any(c, FIELD_SPECIALS), F.regexp_replace(c, '([\\\\"])', "\\\\$1")).otherwise(c)


def quoted_string(c: Column | str) -> Column:
    return F.concat(F.lit('"'), escape_field_string(c), F.lit('"'))


def format_floating(c: Column | str) -> Column:
    """Plain decimal text of a float/double/decimal: ``0.0000001``,
    ``150000000000000000000.0``, ``12.5``; float goes through double."""
    return F.call_function("format_number", _c(c), F.lit(DECIMAL_PATTERN))


def field_value(c: Column | str, dtype: T.DataType, legacy_numbers: bool = False) -> Column:
    """Encoded field value by Spark type.

    ``legacy_numbers`` is the deprecated ``field()`` path: byte, short, int
    and long become double before encoding.
    """
    c = _c(c)
    if isinstance(dtype, T.StringType):
        return quoted_string(c)
    if isinstance(dtype, T.BooleanType):
        return c.cast("string")
    if isinstance(dtype, _INTEGRAL):
        if legacy_numbers:
            return format_floating(c.cast("double"))
        return F.concat(c.cast("string"), F.lit(INTEGER_SUFFIX))
    if isinstance(dtype, T.FloatType):
        return format_floating(c.cast("double"))
    if isinstance(dtype, (T.DoubleType, T.DecimalType)):
        return format_floating(c)
    raise TypeError(f"unsupported field type {dtype.simpleString()}")


def fields_text(fields: Mapping[str, tuple[Column | str, T.DataType]], legacy_numbers: bool = False) -> Column:
    """``k=v,...`` sorted by field name; null fields are skipped (no
    dangling comma). Empty string when every field is null."""
    parts = []
    for name in sorted(fields):
        col, dtype = fields[name]
        v = field_value(col, dtype, legacy_numbers)
        parts.append(F.when(_c(col).isNotNull(), F.concat(F.lit(_escape_lit(name) + "="), v)))
    return F.concat_ws(",", *parts)


def tags_text_from_columns(tags: Mapping[str, Column | str]) -> Column:
    """``,k=v...`` sorted by key; pairs with an empty or null value dropped."""
    parts = []
    for name in sorted(tags):
        if name == "":
            continue
        v = _c(tags[name])
        parts.append(F.when(v.isNotNull() & (v != F.lit("")), F.concat(F.lit("," + _escape_lit(name) + "="), escape_key(v))))
    return F.concat_ws("", *parts) if parts else F.lit("")


def tag_entries(tags: Column | str) -> Column:
    """Sorted ``(key, value)`` entries of a tag map, empty keys / values
    dropped: a groupable canonical form of the tag set."""
    return F.array_sort(
        F.filter(F.map_entries(_c(tags)), lambda e: (e["key"] != F.lit("")) & (e["value"] != F.lit("")) & e["value"].isNotNull())
    )


def render_tag_entries(entries: Column, sep_first: bool = True) -> Column:
    """``,k=v,k=v`` (or ``k=v,k=v`` with ``sep_first=False``), escaped."""
    pairs = F.transform(entries, lambda e: F.concat(escape_key(e["key"]), F.lit("="), escape_key(e["value"])))
    joined = F.array_join(pairs, ",")
    if not sep_first:
        return joined
    return F.when(F.size(entries) > 0, F.concat(F.lit(","), joined)).otherwise(F.lit(""))


def tags_text_from_map(tags: Column | str) -> Column:
    """Same for a ``MAP<STRING,STRING>`` column: sort entries by key, drop
    empty keys / values, escape, join."""
    return render_tag_entries(tag_entries(tags))


def merge_batch_tags(tags: Column | str, batch_tags: Mapping[str, str]) -> Column:
    """Batch-wide tags merged into a point's tag map; the batch value wins.
    The point side is filtered first, so no duplicate-key policy is needed."""
    if not batch_tags:
        return _c(tags)
    keys = F.array(*[F.lit(k) for k in batch_tags])
    point_side = F.map_filter(_c(tags), lambda k, v: ~F.array_contains(keys, k))
    batch_side = F.create_map(*[x for k, v in batch_tags.items() for x in (F.lit(k), F.lit(v))])
    return F.map_concat(point_side, batch_side)


def point_line(measurement: str | Column, tags: Column, fields: Column, time_ns: Column | None) -> Column:
    """Assemble ``measurement<tags> <fields>[ <time>]`` from the parts."""
    m = F.lit(_escape_lit(measurement)) if isinstance(measurement, str) else escape_key(measurement)
    parts = [m, tags, F.lit(" "), fields]
    if time_ns is not None:
        parts += [F.lit(" "), time_ns.cast("string")]
    return F.concat(*parts)


def _escape_lit(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in KEY_SPECIALS else ch)
    return "".join(out)


def field_specs(schema: T.StructType, names: Sequence[str]) -> dict[str, tuple[str, T.DataType]]:
    """``{name: (column, type)}`` for :func:`fields_text` from a frame schema."""
    by_name = {f.name: f.dataType for f in schema.fields}
    return {n: (n, by_name[n]) for n in names}


def variant_kind(value: Column) -> Column:
    """``integer``, ``number``, ``boolean``, ``string``, ``null`` or ``nested``
    (objects and arrays): what a VARIANT value holds."""
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    return (
        F.when(kind == "BIGINT", F.lit("integer"))
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), F.lit("number"))
        .when(kind == "BOOLEAN", F.lit("boolean"))
        .when(kind == "STRING", F.lit("string"))
        .when(kind == "VOID", F.lit("null"))
        .otherwise(F.lit("nested"))
    )


def variant_fields(fields: Column | str) -> Column:
    """Sorted ``(key, kind, text)`` entries of an object in a VARIANT column:
    any set of fields, each with the type of its own value. Kinds are
    ``integer``, ``number``, ``boolean``, ``string``, ``null`` and ``nested``
    (objects and arrays, which a point cannot hold); ``text`` is the encoded
    value, null for the last two. Null where the column is no object."""
    entries = F.map_entries(F.try_variant_get(_c(fields), "$", "map<string,variant>"))

    def one(e: Column) -> Column:
        value, name = e["value"], variant_kind(e["value"])

        def as_type(t: str) -> Column:
            return F.try_variant_get(value, "$", t)

        text = (
            F.when(name == "integer", F.concat(as_type("bigint").cast("string"), F.lit(INTEGER_SUFFIX)))
            .when(name == "number", format_floating(as_type("double")))
            .when(name == "boolean", as_type("boolean").cast("string"))
            .when(name == "string", quoted_string(as_type("string")))
        )
        return F.struct(e["key"].alias("key"), name.alias("kind"), text.alias("text"))

    return F.array_sort(F.transform(entries, one))


def variant_fields_text(entries: Column) -> Column:
    """``k=v,...`` of :func:`variant_fields`; nulls are skipped."""
    shown = F.filter(entries, lambda e: e["text"].isNotNull())
    return F.array_join(F.transform(shown, lambda e: F.concat(escape_key(e["key"]), F.lit("="), e["text"])), ",")
