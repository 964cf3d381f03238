"""SQL surface: the ``cdhrolelogs`` view and the two statements callers run.

The view has the parsed record columns plus ``record_ts``, ``off`` and
``event_ts``. It is registered once per frame (not re-registered per tick);
in a stream it is registered inside ``foreachBatch`` on the batch frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEW = "cdhrolelogs"

LEVEL_COUNT_SQL = (
    "SELECT hostName, serviceName, logType, COUNT(logType) AS cnt "
    f"FROM {VIEW} GROUP BY hostName, serviceName, logType"
)

_LEVELS = ("INFO", "DEBUG", "WARN", "ERROR")

# The four-branch form, branch order INFO, DEBUG, WARN, ERROR: four scans.
UNION_LEVELS_SQL = " UNION ALL ".join(
    f"SELECT hostName, serviceName, '{lv}' AS logType, COUNT(logType) AS cnt "
    f"FROM {VIEW} WHERE logType = '{lv}' GROUP BY hostName, serviceName"
    for lv in _LEVELS
)

# The same rows in one scan: what :func:`union_levels_sql` runs.
FIXED_LEVELS_SQL = (
    "SELECT hostName, serviceName, logType, COUNT(logType) AS cnt "
    f"FROM {VIEW} WHERE logType IN ({', '.join(repr(lv) for lv in _LEVELS)}) GROUP BY hostName, serviceName, logType"
)


def register_cdhrolelogs(spark: SparkSession, records: DataFrame, name: str = VIEW) -> None:
    records.createOrReplaceTempView(name)


def level_count_sql(spark: SparkSession) -> DataFrame:
    return spark.sql(LEVEL_COUNT_SQL)


def union_levels_sql(spark: SparkSession) -> DataFrame:
    return spark.sql(FIXED_LEVELS_SQL)
