"""Tumbling and sliding window operators over log records.

Three physical forms give the same rows:

* ``method="window"`` — ``F.window(ts, len, slide)``: each input row is
  expanded len/slide times (×3 for 15 s / 5 s, ×6 for 30 s / 5 s) before
  the partial aggregate. One shuffle, but the expansion runs on raw rows.
* ``method="pane"`` (batch default) — count per slide-sized pane first
  (partial + final aggregate on raw rows, hot keys combined map-side),
  then expand the *aggregated* panes and sum. A second, tiny shuffle; the
  raw rows are touched once. At 100 TB this is the form to run.
* ``method="events"`` — for windows of many slides (``pane`` uses it beyond
  ``PANE_COPIES``): each pane is two events, ``+n`` where it enters and
  ``-n`` where it leaves the window, whatever length / slide is. A running
  sum over the events of a key gives its count from one event to the next;
  ticks in between are written out after the shuffle. The sums run span by
  span, so a hot key is spread over many tasks.

Streaming queries use ``F.window`` (Spark keeps the window state).
A tick is the window end; window ``T`` covers ``[T-len, T)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

US = 1_000_000
#: Panes that one window partition orders at most, for each group of keys.
SPAN_PANES = 17_280
#: Windows of more slides are counted by events, not by copies of their panes.
PANE_COPIES = 12
#: Ticks that are written out at a time where a gap may have any length.
TICK_PIECE = 10_000


def _check(length_s: int, slide_s: int) -> int:
    if slide_s <= 0 or length_s <= 0 or length_s % slide_s:
        raise ValueError(f"window length {length_s}s must be a positive multiple of slide {slide_s}s")
    return length_s // slide_s


def pane_end_us(ts_col: str, slide_s: int) -> Column:
    """Epoch µs of the end of the slide-sized pane holding ``ts_col``."""
    us = F.unix_micros(F.col(ts_col))
    step = F.lit(slide_s * US)
    return us - F.pmod(us, step) + step


def key_part(key: Column, parts: int) -> Column:
    """Bucket of a key: the first 32 bits of its MD5, modulo ``parts``."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(parts)).cast("int")


def _expand_ends(pane_end: Column, k: int, slide_s: int) -> Column:
    """Ends of the k windows that contain a pane."""
    return F.explode(F.array(*[pane_end + F.lit(i * slide_s * US) for i in range(k)]))


def chained(rows: DataFrame, at: str, step: int, *amounts: str) -> DataFrame:
    """Rows of groups ``_g`` with numbers ``at`` (in µs, multiples of
    ``step``), each with ``_span``, the stretch of SPAN_PANES steps that it
    lies in, ``_then``, the first ``at`` of the group's next stretch, and
    ``_base_*``, the sums of ``amounts`` over the stretches before. Only a
    row per group and stretch is ordered over the whole time line."""
    spans = rows.withColumn("_span", F.expr(f"{at} div {SPAN_PANES * step}"))
    each = spans.groupBy("_g", "_span").agg(F.min(at).alias("_first"), *(F.sum(a).alias(a) for a in amounts))
    chain = Window.partitionBy("_g").orderBy("_span")
    before = chain.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"_base_{a}") for a in amounts]
    return spans.join(each.select("_g", "_span", F.lead("_first").over(chain).alias("_then"), *carried), ["_g", "_span"])


def _ticks(first: Column, end: Column, step: int) -> Column:
    """One row for each tick from ``first`` on before ``end``."""
    return F.explode(F.sequence(first, end - F.lit(step), F.lit(step)))


def _counts_by_events(panes: DataFrame, k: int, slide_s: int) -> DataFrame:
    """``(_te, _g, cnt)`` of panes ``(_pe, _g, n, rows)``."""
    step = slide_s * US
    moves = F.array(F.struct(F.col("_pe").alias("at"), F.col("n"), F.col("rows")),
                    F.struct((F.col("_pe") + F.lit(k * step)).alias("at"), (-F.col("n")).alias("n"), (-F.col("rows")).alias("rows")))
    placed = chained(panes.select("_g", F.explode(moves).alias("m")).select("_g", "m.*"), "at", step, "n", "rows")
    own = Window.partitionBy("_g", "_span").orderBy("at")
    # Events of one tick are peers of a range frame; only the last of them has a later successor.
    upto = own.rangeBetween(Window.unboundedPreceding, 0)
    summed = placed.select(
        "_g", "at", (F.col("_base_n") + F.sum("n").over(upto)).alias("cnt"),
        (F.col("_base_rows") + F.sum("rows").over(upto)).alias("rows"),
        F.coalesce(F.lead("at").over(own), "_then").alias("next"),
    )
    return summed.where("rows > 0 AND next > at").select(_ticks(F.col("at"), F.col("next"), step).alias("_te"), "_g", "cnt")


def sliding_count(
    records: DataFrame,
    keys: Sequence[str],
    length_s: int,
    slide_s: int,
    ts_col: str = "record_ts",
    count_col: str = "logType",
    method: str = "pane",
    parts: int = 0,
) -> DataFrame:
    """``(tick, *keys, cnt)``: COUNT(count_col) per window and key.

    ``parts`` above 0 (pane form) adds ``part``, a hash of the key in that
    many buckets, and leaves the result hash-partitioned by (tick, part):
    the expanded pane counts are shuffled that way and summed in place, so
    a consumer that works per (tick, part) needs no further shuffle, and no
    task holds all keys of a tick."""
    keys = list(keys)
    k = _check(length_s, slide_s)
    if method == "window":
        w = F.window(ts_col, f"{length_s} seconds", f"{slide_s} seconds")
        return (
            records.groupBy(w.alias("_w"), *keys)
            .agg(F.count(count_col).alias("cnt"))
            .select(F.col("_w.end").alias("tick"), *keys, "cnt")
        )
    if method not in ("pane", "events"):
        raise ValueError("method must be 'pane', 'events' or 'window'")
    if keys and not parts and (method == "events" or k > PANE_COPIES):
        panes = records.groupBy(pane_end_us(ts_col, slide_s).alias("_pe"), F.struct(*keys).alias("_g")).agg(
            F.count(count_col).alias("n"), F.count(F.lit(1)).alias("rows"))
        return _counts_by_events(panes, k, slide_s).select(F.timestamp_micros("_te").alias("tick"), "_g.*", "cnt")
    panes = records.groupBy(pane_end_us(ts_col, slide_s).alias("_pe"), *keys).agg(F.count(count_col).alias("_n"))
    if k == 1 and not parts:
        return panes.select(F.timestamp_micros("_pe").alias("tick"), *keys, F.col("_n").alias("cnt"))
    expanded = panes.select(_expand_ends(F.col("_pe"), k, slide_s).alias("_te"), *keys, "_n") if k > 1 \
        else panes.select(F.col("_pe").alias("_te"), *keys, "_n")
    if parts:
        ticked = expanded.select(
            F.timestamp_micros("_te").alias("tick"), key_part(F.concat_ws("_", *keys), parts).alias("part"), *keys, "_n"
        ).repartition("tick", "part")
        return ticked.groupBy("tick", "part", *keys).agg(F.sum("_n").alias("cnt"))
    return (
        expanded.groupBy("_te", *keys)
        .agg(F.sum("_n").alias("cnt"))
        .select(F.timestamp_micros("_te").alias("tick"), *keys, "cnt")
    )


def tumbling_count(records: DataFrame, keys: Sequence[str], slide_s: int = 5, ts_col: str = "record_ts",
                   count_col: str = "logType") -> DataFrame:
    return sliding_count(records, keys, slide_s, slide_s, ts_col, count_col, method="pane")


def arrival_order(records: DataFrame, ts_col: str = "record_ts", off_col: str = "off") -> Column:
    """(arrival time, offset) as one number that sorts like the pair: the
    microseconds above 63 bits of offset, without loss. Offsets that are
    pairs themselves (decimals) stay beside the time in a struct."""
    if not isinstance(records.schema[off_col].dataType, (T.LongType, T.IntegerType)):
        return F.struct(ts_col, off_col)
    high = F.unix_micros(F.col(ts_col)).cast("decimal(19,0)") * F.lit(Decimal(1 << 63)).cast("decimal(19,0)")
    return (high + F.col(off_col).cast("decimal(38,0)")).cast("decimal(38,0)")


def sliding_latest_level(
    records: DataFrame,
    length_s: int = 30,
    slide_s: int = 5,
    ts_col: str = "record_ts",
    method: str = "pane",
) -> DataFrame:
    """``(tick, hostName, logType)``: the last level seen per host in each window.

    Windows and order go by the same time, so a window's last level is that
    of its last pane with a record. ``events`` (``pane`` beyond PANE_COPIES
    slides) therefore reduces panes to their last level and lets each hold
    from its own tick to the next pane of the host or to where it leaves the
    window: a pane is shuffled once, not length / slide times."""
    k = _check(length_s, slide_s)
    if method == "window":
        w = F.window(ts_col, f"{length_s} seconds", f"{slide_s} seconds")
        return (
            records.groupBy(w.alias("_w"), "hostName")
            .agg(F.max(F.struct(ts_col, "off", "logType")).alias("_m"))
            .select(F.col("_w.end").alias("tick"), "hostName", F.col("_m.logType").alias("logType"))
        )
    # Raw rows: a hash aggregate to the latest moment of each (pane, host, level).
    panes = records.groupBy(pane_end_us(ts_col, slide_s).alias("_pe"), "hostName", "logType").agg(
        F.max(arrival_order(records, ts_col)).alias("_at")
    )
    if method == "events" or k > PANE_COPIES:
        step = slide_s * US
        last = panes.groupBy(F.struct("hostName").alias("_g"), "_pe").agg(
            F.max_by("logType", F.struct("_at", "logType")).alias("logType"))
        own = Window.partitionBy("_g", "_span").orderBy("_pe")
        held = chained(last, "_pe", step).select(
            "_g", "logType", "_pe",
            F.least(F.col("_pe") + F.lit(k * step), F.coalesce(F.lead("_pe").over(own), "_then")).alias("_end"))
        return held.select(_ticks(F.col("_pe"), F.col("_end"), step).alias("_te"), "_g.hostName", "logType").select(
            F.timestamp_micros("_te").alias("tick"), "hostName", "logType")
    return (
        panes.select(_expand_ends(F.col("_pe"), k, slide_s).alias("_te"), "hostName", "logType", "_at")
        .groupBy("_te", "hostName")
        .agg(F.max_by("logType", F.struct("_at", "logType")).alias("logType"))
        .select(F.timestamp_micros("_te").alias("tick"), "hostName", "logType")
    )


def empty_ticks(
    records: DataFrame,
    by: Sequence[str] = (),
    length_s: int = 15,
    slide_s: int = 5,
    ts_col: str = "record_ts",
) -> DataFrame:
    """``(*by, tick)``: ticks between a group's first and last non-empty
    window whose window holds no record ("no logs in this interval").

    Output-sensitive: the distinct non-empty panes per group (bounded by
    the time span / slide, not by the row count) are ordered with ``lag``.
    A window of k panes ending at T is empty exactly when no pane ends in
    ``[T-(k-1)·slide, T]``, so between consecutive non-empty panes p1 < p2
    the empty ticks are ``p1+k·slide … p2-slide``; ``sequence`` lists only
    those; no ticks × groups grid, no anti join. The panes of a group are
    ordered in spans of ``SPAN_PANES``, so neither a group nor the whole
    time line (``by=()``) is one task: only one row per span is.
    """
    by = list(by)
    k = _check(length_s, slide_s)
    step = slide_s * US
    panes = records.select(*by, pane_end_us(ts_col, slide_s).alias("_pe")).distinct()
    # Panes are ordered span by span; the first pane of a span follows the last
    # one of the span before it, which a window over one row per span tells.
    spans = panes.withColumn("_span", F.expr(f"_pe div {SPAN_PANES * step}"))
    own = Window.partitionBy(*by, "_span").orderBy("_pe")
    last = spans.groupBy(*by, "_span").agg(F.max("_pe").alias("_last"))
    chain = Window.partitionBy(*by).orderBy("_span") if by else Window.orderBy("_span")
    carried = last.select(*by, "_span", F.lag("_last").over(chain).alias("_carried"))
    joined = spans.alias("p").join(
        carried.alias("c"), [F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*by, "_span")]
    ).select(*[F.col(f"p.{c}").alias(c) for c in (*by, "_pe", "_span")], "_carried")
    gaps = joined.withColumn("_prev", F.coalesce(F.lag("_pe").over(own), "_carried")).where(
        F.col("_pe") - F.col("_prev") > F.lit(k * step)
    )
    # A gap may have any length: its ticks are written out piece by piece.
    first, piece = F.col("_prev") + F.lit(k * step), TICK_PIECE * step
    pieces = gaps.select(*by, F.col("_pe"), F.explode(F.sequence(first, F.col("_pe") - F.lit(step), F.lit(piece))).alias("_from"))
    return pieces.select(*by, _ticks(F.col("_from"), F.least(F.col("_from") + F.lit(piece), F.col("_pe")), step).alias("_e")).select(
        *by, F.timestamp_micros("_e").alias("tick"))
