"""Tables written once because they are read several times."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.session import scratch_path


def store(df: DataFrame, label: str) -> str:
    """Writes the rows to the shared folder and returns the path.

    Unlike a cache, the table survives lost executors, and it cuts the lineage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    return df.sparkSession.read.parquet(store(df, label))
