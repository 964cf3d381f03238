"""Time expressions: epochs, ISO text, Java timestamp text, unit scaling.

Renderings go through TIMESTAMP_NTZ so they do not depend on the session
time zone; instants stay TIMESTAMP (watermarks need that type).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------
# Time precision names by unit.
UNIT_NAMES = {
    "HOURS": "h",
    "MINUTES": "m",
    "SECONDS": "s",
    "MILLISECONDS": "ms",
    "MICROSECONDS": "u",
    "NANOSECONDS": "n",
}
# Nanoseconds per unit.
NANOS_PER_UNIT = {
    "HOURS": 3_600_000_000_000,
    "MINUTES": 60_000_000_000,
    "SECONDS": 1_000_000_000,
    "MILLISECONDS": 1_000_000,
    "MICROSECONDS": 1_000,
    "NANOSECONDS": 1,
}
# ISO text of query times: 2016-10-31T06:52:20.020Z
ISO_MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
# ---------------------------------------------------------------------------

def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def precision_name(unit: str) -> str:
    """``TimeUnit`` name → precision text; other units are rejected."""
    try:
        return UNIT_NAMES[unit.upper()]
    except KeyError:
        raise ValueError(f"time precision must be one of: {sorted(UNIT_NAMES)}") from None


def nanos_per(unit: str) -> int:
    try:
        return NANOS_PER_UNIT[unit.upper()]
    except KeyError:
        raise ValueError(f"time unit must be one of: {sorted(NANOS_PER_UNIT)}") from None


def epoch_ntz() -> Column:
    return F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def ntz_from_millis(ms: Column | str) -> Column:
    """Epoch milliseconds → TIMESTAMP_NTZ wall clock in UTC (no session TZ)."""
    return F.timestamp_add("MILLISECOND", _c(ms), epoch_ntz())


def epoch_us_ntz(ts_ntz: Column | str) -> Column:
    """TIMESTAMP_NTZ (read as UTC) → epoch microseconds."""
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(ts_ntz))


def epoch_us(ts: Column | str) -> Column:
    """TIMESTAMP → epoch microseconds (an instant; no TZ involved)."""
    return F.unix_micros(_c(ts))


def epoch_ns(ts: Column | str) -> Column:
    return F.unix_micros(_c(ts)) * F.lit(1000)


def millis_to_iso(ms: Column | str) -> Column:
    """Epoch ms → ``yyyy-MM-ddTHH:mm:ss.SSSZ`` in UTC."""
    return F.date_format(ntz_from_millis(ms), ISO_MILLIS_FORMAT)


def iso_to_millis(text: Column | str) -> Column:
    """ISO text with a ``Z`` zone → epoch ms (true fraction; any digit count);
    unparsable text gives null instead of failing the job."""
    return F.unix_millis(F.try_to_timestamp(_c(text)))


def java_timestamp_text(ts: Column | str) -> Column:
    """``java.sql.Timestamp.toString()`` (session zone, pinned to UTC):
    fraction with trailing zeros trimmed, at least one digit kept
    (``...:20.0``, ``...:16.37``)."""
    full = F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    trimmed = F.regexp_replace(full, "0+$", "")
    return F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)


def int_div(c: Column | str, divisor: int) -> Column:
    """Exact integer division truncating toward zero (as Java's ``/``):
    SQL ``div`` on longs, so 19-digit nanosecond epochs stay exact."""
    c = _c(c)
    if divisor == 1:
        return c
    return F.call_function("div", c.cast("long"), F.lit(divisor).cast("long"))


def scale_epoch(ns: Column | str, unit: str) -> Column:
    """Epoch ns → epoch in ``unit`` (``TimeUnit.convert`` truncation)."""
    return int_div(ns, nanos_per(unit))


def to_nanos(value: Column | str, unit: str) -> Column:
    f = nanos_per(unit)
    c = _c(value)
    return c if f == 1 else c * F.lit(f)
