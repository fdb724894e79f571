"""Intermediate tables in the shared folder, so that lost executors cost no earlier work."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulse.sources.store import scratch


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as a table under the shared folder and continue from there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
