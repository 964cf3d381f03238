"""The point table: time order over files, pruned days, defined errors."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from logengine.sources.pointstore import DAY_NS, read_points, write_points
from logengine.sources.points import points_table

from .conftest import SF_SMALL

COLUMNS = ["point_id", "time_ns", "value"]
MIDDLE = 9_131 * DAY_NS  # 1995-01-01


def _days(spark, n):
    """The points of n days: every day is a folder."""
    return points_table(spark, SF_SMALL).where(F.col("time_ns").between(MIDDLE - n * DAY_NS // 2, MIDDLE + n * DAY_NS // 2))


def test_a_measurement_comes_in_time_order_across_files_and_writes(spark, scratch):
    path = os.path.join(scratch, "points")
    table = _days(spark, 60)
    for odd in (0, 1):
        write_points(table.where(F.col("point_id") % 2 == odd), path)
    for name in ("orders", "lineitem"):
        got = [tuple(r) for r in read_points(spark, path, name).select(*COLUMNS).collect()]
        want = [tuple(r) for r in table.where(F.col("measurement") == name).select(*COLUMNS).collect()]
        assert got == sorted(want, key=lambda r: (r[1], r[0], r[2])) and len({r[1] // DAY_NS for r in got}) > 10
    assert read_points(spark, path, "none").collect() == []


def test_a_time_range_reads_its_days_only(spark, scratch, capsys):
    path = os.path.join(scratch, "points")
    table = _days(spark, 60)
    write_points(table, path)
    start, end = MIDDLE + 1, MIDDLE + 5 * DAY_NS
    got = read_points(spark, path, "lineitem", start, end)
    want = table.where(f"measurement = 'lineitem' AND time_ns >= {start} AND time_ns < {end}")
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == sorted(map(tuple, want.select(*COLUMNS).collect()))
    got.explain("formatted")
    plan = capsys.readouterr().out
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "measurement" in filters and "_day" in filters
    assert "GreaterThanOrEqual(time_ns" in plan


def test_times_before_the_epoch_and_bad_points(spark, scratch):
    path = os.path.join(scratch, "points")
    rows = [("m", 1, -1, 1.0), ("m", 2, -DAY_NS, 2.0), ("m", 3, 0, 3.0), ("m", 4, -DAY_NS - 1, 4.0), ("m/ =", 5, 0, 5.0)]
    schema = "measurement string, point_id long, time_ns long, value double"
    write_points(spark.createDataFrame(rows, schema), path)
    assert [r.point_id for r in read_points(spark, path, "m").collect()] == [4, 2, 1, 3]
    assert [r.point_id for r in read_points(spark, path, "m", -DAY_NS, 0).collect()] == [2, 1]
    assert [r.point_id for r in read_points(spark, path, "m/ =").collect()] == [5]
    assert read_points(spark, path, "m").columns == ["point_id", "time_ns", "value", "measurement"]
    for bad in (("", 1, 0, 1.0), (None, 1, 0, 1.0), ("m", 1, None, 1.0)):
        with pytest.raises(Exception, match="a point without"):
            write_points(spark.createDataFrame([bad], schema), os.path.join(scratch, "bad"))
