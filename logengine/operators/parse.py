"""Log row parsing: header filter, record parse, dead letters, formatting.

All built-in expressions: the marker filter and the token-count check
are plain predicates that fuse into one whole-stage-codegen span with the
scan. The check counts separators instead of splitting, so a row is split
once, in the projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logengine.functions.text import (
    LINE_TS_FORMAT,
    has_level_marker,
    java_split,
    message_offset,
    printf_join,
    series_key,
    substring_from,
    token,
)

RECORD_COLUMNS = ["hostName", "serviceName", "lineTimestamp", "logType", "logInfo"]

_TOK = "_tokens"


def header_lines(rows: DataFrame) -> DataFrame:
    """Rows holding a level marker anywhere: the first line of each entry."""
    return rows.where(has_level_marker("value"))


def _five_tokens(value: str = "value") -> Column:
    """At least five tokens, without splitting: four separators are left
    once trailing spaces (empty tokens, which the split drops) are cut."""
    cut = F.rtrim(F.col(value))
    return F.length(cut) - F.length(F.replace(cut, F.lit(" "), F.lit(""))) >= 4


def _tokenized(rows: DataFrame) -> DataFrame:
    return header_lines(rows).where(_five_tokens()).withColumn(_TOK, java_split("value"))


def parse_log(rows: DataFrame, legacy_offset: bool = False, keep: tuple[str, ...] = ("off", "record_ts")) -> DataFrame:
    """Header rows with at least five tokens → parsed records.

    Columns: ``keep`` + hostName, serviceName, lineTimestamp, logType,
    logInfo, event_ts. ``legacy_offset`` reproduces the reference's message
    offset (drops the first message letter after a five-letter level).
    """
    t = F.col(_TOK)
    line_ts = F.concat_ws(" ", token(t, 2), token(t, 3))
    return (
        _tokenized(rows)
        .select(
            *keep,
            token(t, 0).alias("hostName"),
            token(t, 1).alias("serviceName"),
            line_ts.alias("lineTimestamp"),
            token(t, 4).alias("logType"),
            substring_from("value", message_offset(t, legacy_offset)).alias("logInfo"),
            F.try_to_timestamp(line_ts, F.lit(LINE_TS_FORMAT)).alias("event_ts"),
        )
    )


def log_message(rows: DataFrame) -> DataFrame:
    """Message text after the level, correct and reference (legacy) offsets."""
    t = F.col(_TOK)
    return (
        _tokenized(rows)
        .select(
            "off",
            token(t, 4).alias("logType"),
            substring_from("value", message_offset(t, False)).alias("logInfo"),
            substring_from("value", message_offset(t, True)).alias("legacyInfo"),
        )
    )


def rejects(rows: DataFrame) -> DataFrame:
    """Dead-letter output: rows that do not become a record, with a reason.

    ``no_level_marker`` = continuation line (dropped by the reference too),
    ``too_few_tokens`` = marker present but fewer than five tokens (the
    reference throws and the job dies; here the stream goes on).
    """
    marked, enough = has_level_marker("value"), _five_tokens()
    reason = F.when(~marked, F.lit("no_level_marker")).otherwise(F.lit("too_few_tokens"))
    return rows.where(~marked | ~enough).select("off", "record_ts", "value", reason.alias("reason"))


def observe_rows(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with counts under ``name`` in the metrics of the query that
    reads them: ``rows_read`` and the reasons of :func:`rejects`. Counted as
    the rows pass, no further job."""
    marked = F.coalesce(has_level_marker("value"), F.lit(False))
    return rows.observe(
        name,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~marked).alias("no_level_marker"),
        F.count_if(marked & ~_five_tokens()).alias("too_few_tokens"),
    )


def untimed(rows: DataFrame) -> DataFrame:
    """Records whose own time does not parse: what an event-time stream
    leaves out."""
    return parse_log(rows).where(F.col("event_ts").isNull())


def row_kind_counts(rows: DataFrame) -> DataFrame:
    """Header vs continuation row counts (what the continuation drop removes)."""
    kind = F.when(has_level_marker("value"), F.lit("header")).otherwise(F.lit("continuation"))
    return rows.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_rows"))


def with_series_key(records: DataFrame) -> DataFrame:
    return records.withColumn("key", series_key("hostName", "serviceName", "logType"))


def format_log(records: DataFrame) -> DataFrame:
    """A record back to one text line, five fields joined by one space."""
    return records.select("off", printf_join(*RECORD_COLUMNS).alias("line"))
