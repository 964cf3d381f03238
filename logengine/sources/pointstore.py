"""A point table in time order: one folder per measurement and day, rows sorted by time inside.

``SELECT * FROM m`` comes in time order and a time range reads only the days that it touches
(partition pruning), then only the row groups (``time_ns`` is pushed to Parquet)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logengine.functions.time import int_div

DAY_NS = 86_400 * 1_000_000_000


def day_of(time_ns: str | Column) -> Column:
    """Days since the epoch: also for times before it, without a time zone."""
    t = F.col(time_ns) if isinstance(time_ns, str) else time_ns
    return int_div(t - F.pmod(t, F.lit(DAY_NS)), DAY_NS).cast("int")


def write_points(points: DataFrame, path: str, tie_breakers: Sequence[str] = ("point_id",), mode: str = "append") -> None:
    """Write points ``(measurement, time_ns, ...)``. Rows are dealt by ranges of (measurement, time),
    not by measurement: a hot measurement is spread over tasks by its time, a task writes few days,
    and files of a day don't overlap in time (but those of other writes). Rows without a measurement
    or a time are refused by an error, as :func:`logengine.operators.points.invalid_points` has them."""
    order = ["measurement", "_day", "time_ns", *tie_breakers]
    checked = points.withColumns({
        "measurement": F.when(F.col("measurement") != "", F.col("measurement")).otherwise(F.raise_error(F.lit("a point without measurement")).cast("string")),
        "time_ns": F.coalesce("time_ns", F.raise_error(F.lit("a point without time")).cast("long")),
    })
    dealt = checked.withColumn("_day", day_of("time_ns")).repartitionByRange(*order[:3]).sortWithinPartitions(*order)
    dealt.write.mode(mode).partitionBy("measurement", "_day").parquet(path)


def read_points(spark: SparkSession, path: str, measurement: str, start_ns: int | None = None, end_ns: int | None = None,
                tie_breakers: Sequence[str] = ("point_id",)) -> DataFrame:
    """The points of a measurement with start_ns <= time_ns < end_ns, in time order (a range sort:
    the order holds from partition to partition, no task has all rows)."""
    points = spark.read.parquet(path).where(F.col("measurement") == measurement)
    if start_ns is not None:
        points = points.where((F.col("_day") >= start_ns // DAY_NS) & (F.col("time_ns") >= start_ns))
    if end_ns is not None:
        points = points.where((F.col("_day") <= (end_ns - 1) // DAY_NS) & (F.col("time_ns") < end_ns))
    return points.drop("_day").orderBy("time_ns", *tie_breakers)
