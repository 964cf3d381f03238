"""logengine: Spark-native log and time-series analytics.

Layout
------
sources/     readers: log stream / table, points and query-result documents
functions/   column expressions (Java string rules, time, line protocol)
operators/   DataFrame operators: parse, aggregate, windows, shape, points,
             batching, series
plans/       named queries, their DuckDB oracles and the SQL surface
streaming/   stream runner and sinks (foreachBatch, keyed upserts, files)
"""

from logengine.session import build_session, checkpoint_dir, use_utc

__all__ = ["build_session", "checkpoint_dir", "use_utc"]
