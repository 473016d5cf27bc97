"""Small fitted tables (class counts, cut-offs) held as rows and joined back.

What is fitted here has one row per class or per column. The row count is
checked when it is read, and only such checked tables are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expr import col

#: Default of the ``max_classes`` arguments: how many classes a fitted table may have.
MAX_CLASSES = 10_000


def read_classes(df: DataFrame, label: str, limit: int = MAX_CLASSES) -> list[Row]:
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{label} has more than {limit} distinct values; it is not a class column")
    return rows


def attach_classes(
    df: DataFrame, column: str, rows: Sequence[tuple], fields: Sequence[T.StructField]
) -> DataFrame:
    """Adds the fitted ``fields`` to each row by its class; a NULL class matches NULL."""
    kind = df.schema[column].dataType
    schema = T.StructType([T.StructField("__class", kind), *fields])
    side = df.sparkSession.createDataFrame(list(rows), schema)
    return df.join(F.broadcast(side), col(column).eqNullSafe(F.col("__class"))).drop("__class")
