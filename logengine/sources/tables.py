"""Parquet table reader.

Selecting columns here (rather than after a wide read) is what lets the
plan show a narrow ``ReadSchema``; filters written later on the returned
frame are pushed into the scan by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """The table as a DataFrame (column-pruned when ``columns`` is given).
    Files are listed at each call, so files added later are read."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
