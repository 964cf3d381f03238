"""Exact positions within a group (ordinals, running sums), safe under skew.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends a whole group to
one task. Here every row first gets a range bucket of its order key ``o``
(or of its leading columns): the bounds are literals, taken once from a
sample of rows, and only steer placement, never the result. Each (group,
bucket) cell is numbered on its own and shifted by the totals of the cells
before it. The sample is one of rows, not of keys: a group or a key that
holds a third of all rows makes up a third of it, so the bounds cut it
finely; where one leading value fills a range, the bounds inside it go on
to the other order columns.

One pass counts the rows and one takes the sample (of the leading columns,
which may be much cheaper than the others), one aggregates the cells (partial sums, one row per cell is shuffled); the
rows are shuffled once, by (group, bucket), for both the join with the
cells and the window. Nothing is checkpointed and a retry gives the same
numbers. The order must be total up to rows that are equal anyway (add a
unique tie-breaker).
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that the range bounds are taken from, at least, and for each range;
#: the sample is bounded by the number of ranges, not by the input.
SAMPLE_ROWS = 4096
ROWS_PER_RANGE = 256
#: Ranges that a row is searched in at most (the bounds are literals).
MAX_RANGES = 1024


def _rank(row: Sequence) -> tuple:
    """Sorts as the columns do: nulls first, a null is only ever compared with its flag."""
    return tuple((v is not None, *([v] if v is not None else [])) for v in row)


def _sample(df: DataFrame, total: float, wanted: int) -> list[tuple]:
    """About ``wanted`` of the ``total`` rows, sorted."""
    rows = df if total <= wanted else df.sample(fraction=wanted / total, seed=11)
    return sorted((tuple(r) for r in rows.collect()), key=_rank)


def _bounds(df: DataFrame, cols: Sequence[str], lead: int, n: int, sample_rows: int) -> list[tuple]:
    """Starts of the ranges after the first, ascending: tuples of the first
    ``lead`` columns, or of all where the leading value holds half a range
    or more (a second sample, of the rows with such values only)."""
    keys = df.select(*cols[:lead])
    total, wanted = keys.count(), max(sample_rows, ROWS_PER_RANGE * n)
    rows = _sample(keys, total, wanted)
    held = Counter(rows)
    hot = {v for v, c in held.items() if 2 * n * c >= len(rows)} if lead < len(cols) else set()
    inside: dict[tuple, list[tuple]] = {v: [] for v in hot}
    if hot:
        is_hot = reduce(or_, (reduce(and_, (F.col(c).eqNullSafe(F.lit(x)) for c, x in zip(cols, v, strict=False))) for v in hot))
        for r in _sample(df.where(is_hot).select(*cols), total * sum(held[v] for v in hot) / len(rows), wanted):
            inside[r[:lead]].append(r)
    out = []
    for at in (len(rows) * i // n for i in range(1, n) if rows):
        own = inside.get(rows[at])
        if own:  # as far into the rows of this value as the pick is into its part of the sample
            out.append(own[(at - bisect_left(rows, _rank(rows[at]), key=_rank)) * len(own) // held[rows[at]]])
        else:
            out.append(rows[at])
    return list(dict.fromkeys(out))


def _before(cols: Sequence[str], bound: tuple) -> Column:
    """The row sorts before the bound (nulls first), by as many columns as
    the bound has; the later ones are only computed where the earlier tie."""
    out = F.lit(False)
    for name, value in reversed(list(zip(cols, bound, strict=False))):
        c = F.col(name)
        if value is None:
            out = c.isNull() & out
        else:
            out = c.isNull() | (c < F.lit(value)) | ((c == F.lit(value)) & out)
    return F.coalesce(out, F.lit(False))


def range_bucket(df: DataFrame, cols: Sequence[str], n: int | None = None, sample_rows: int = SAMPLE_ROWS,
                 lead: int | None = None) -> Column:
    """Number of the range (of about ``n``) that a row falls into in the
    order of ``cols``: a binary search over literal bounds."""
    n = min(n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_RANGES)
    bounds = _bounds(df, cols, lead or len(cols), n, sample_rows)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(_before(cols, bounds[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(bounds))


def positions(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], out_col: str = "ordinal",
              size_col: str | None = None, buckets: int | None = None, lead: int | None = None,
              total_col: str | None = None) -> DataFrame:
    """Add ``out_col``: the 0-based place of each row in its group. With
    ``size_col`` also ``start`` (sum of the sizes before the row) and
    ``longest`` (largest size of the group), with ``total_col`` the rows of
    the group. Null keys are a group. ``lead`` is how many of the order
    columns the buckets go by first (all): leave out a tie-breaker that is
    dear to compute; it is used inside a leading value that fills a range."""
    g, o = list(group_cols), list(order_cols)
    placed = df.withColumn("_b", range_bucket(df, o, buckets, lead=lead)).withColumn("_g", F.struct(*g))
    sums = [F.count(F.lit(1)).alias("_n")]
    if size_col:
        sums += [F.sum(size_col).alias("_size"), F.max(size_col).alias("_max")]
    cells = placed.groupBy("_g", "_b").agg(*sums)
    group = Window.partitionBy("_g")
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = [F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_n0")]
    if total_col:
        offsets.append(F.sum("_n").over(group).alias(total_col))
    if size_col:
        offsets += [F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias("_size0"), F.max("_max").over(group).alias("longest")]
    own = Window.partitionBy("_g", "_b").orderBy(*o)
    out = placed.join(cells.select("_g", "_b", *offsets), ["_g", "_b"]).withColumn(
        out_col, (F.col("_n0") + F.row_number().over(own) - 1).cast("long")
    )
    if size_col:
        inside = F.sum(size_col).over(own.rowsBetween(Window.unboundedPreceding, -1))
        out = out.withColumn("start", F.col("_size0") + F.coalesce(inside, F.lit(0)))
    return out.drop("_g", "_b", "_n0", "_size0")


def ordinal_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                   buckets: int | None = None, out_col: str = "ordinal", lead: int | None = None) -> DataFrame:
    """:func:`positions` without sizes."""
    return positions(df, group_cols, order_cols, out_col, buckets=buckets, lead=lead)
