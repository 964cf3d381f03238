"""Column expressions for log text, following Java string rules.

Everything here is a built-in Spark expression (whole-stage codegen, no
Python on the data path).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------
# Level markers; a row holding any of them anywhere (case-sensitive) is the
# first line of a log entry.
LEVEL_MARKERS = ("INFO", "WARN", "ERROR", "DEBUG")
# Levels of the four-branch count, in the reference's branch order.
FIXED_LEVELS = ("INFO", "DEBUG", "WARN", "ERROR")
# Token separator of a log row (one U+0020, never a run of whitespace).
TOKEN_SEP = " "
# Text layout of the time inside a log row.
LINE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"
# Separator of the composite series key host_service_level.
KEY_SEP = "_"
# What a null field prints as in String.format("%s").
NULL_TEXT = "null"
# ---------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_level_marker(value: Column | str) -> Column:
    """True when the row contains INFO, WARN, ERROR or DEBUG anywhere."""
    v = _c(value)
    return reduce(lambda a, b: a | b, [v.contains(m) for m in LEVEL_MARKERS])


def java_split(value: Column | str) -> Column:
    """``String.split(" ")``: split at each single space, keep leading and
    inner empty tokens, drop trailing ones; ``""`` gives one empty token,
    an all-space row gives none."""
    v = _c(value)
    stripped = F.rtrim(v)  # Spark's rtrim removes U+0020 only
    return (
        F.when(v == F.lit(""), F.array(F.lit("")))
        .when(stripped == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, TOKEN_SEP, -1))
    )


def token(tokens: Column, i: int) -> Column:
    """0-based token, null (not an error) past the end."""
    return F.get(tokens, i)


def message_offset(tokens: Column, legacy: bool = False) -> Column:
    """0-based start of the message after the level token.

    Correct offset: the five tokens plus five separators. The reference
    adds the level length twice plus one, which is right for four-letter
    levels and one too far for five-letter ones (ERROR, DEBUG)."""
    lens = [F.length(token(tokens, i)) for i in range(5)]
    total = reduce(lambda a, b: a + b, lens)
    if legacy:
        return total + lens[4] + F.lit(1)
    return total + F.lit(5)


def substring_from(value: Column | str, offset0: Column) -> Column:
    """Java ``substring(begin)``; past the end gives ``""`` instead of an error."""
    v = _c(value)
    return F.substr(v, offset0 + F.lit(1), F.length(v) + F.lit(1))


def series_key(*cols: Column | str) -> Column:
    """``host_service_level`` composite key."""
    return F.concat_ws(KEY_SEP, *[_c(c) for c in cols])


def printf_join(*cols: Column | str) -> Column:
    """``String.format("%s %s ...")``: space-joined, null prints as ``null``."""
    return F.concat_ws(TOKEN_SEP, *[F.coalesce(_c(c), F.lit(NULL_TEXT)) for c in cols])
