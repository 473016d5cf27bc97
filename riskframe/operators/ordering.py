"""Running totals over a sorted value, without one task seeing a whole column.

A window over an unpartitioned (or per-column) order runs in one task. Here the
value range is first cut into slices of about equal row count; the cut points
come from ``approxQuantile`` and are plain numbers afterwards, so a recomputed
task always lands rows in the same slice. Each slice is sorted on its own and
the totals of the slices before it (a table of slices, not of rows) are added.
The points only balance the work: any points give the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expr import col
from riskframe.session import shuffle_parallelism


def as_number(df: DataFrame, name: str) -> Column:
    """A column as a double that keeps its order (times become microseconds)."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(col(name).cast("timestamp")).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return col(name).cast("double")
    raise TypeError(f"column {name} of type {kind.simpleString()} has no numeric order")


def slice_points(df: DataFrame, columns: Sequence[str], slices: int | None = None) -> dict[str, list[float]]:
    """Ascending cut points per column: one pass over the listed columns only."""
    slices = slices or shuffle_parallelism(df.sparkSession)
    numbers = df.select(*[as_number(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    shares = [i / slices for i in range(1, slices)]
    found = numbers.approxQuantile(numbers.columns, shares, 1 / (2 * slices))
    return {c: sorted(set(points)) for c, points in zip(columns, found)}


def add_slices(df: DataFrame, points: dict[str, list[float]]) -> DataFrame:
    """Adds ``__slice_<i>``, never NULL, for the i-th column of ``points``; equal values share a slice."""
    numbered = df.withColumns({f"__num_{i}": as_number(df, c) for i, c in enumerate(points)})
    for i, cuts in enumerate(points.values()):
        if cuts:
            edges = [-float("inf"), *cuts, float("inf")]
            cutter = Bucketizer(splits=edges, inputCol=f"__num_{i}", outputCol=f"__slice_{i}", handleInvalid="keep")
            slice_no = F.coalesce(F.col(f"__slice_{i}").cast("int"), F.lit(-1))
            numbered = cutter.transform(numbered).withColumn(f"__slice_{i}", slice_no)
        else:
            numbered = numbered.withColumn(f"__slice_{i}", F.lit(0))
    return numbered.drop(*[f"__num_{i}" for i in range(len(points))])


def slice_offsets(totals: DataFrame, slice_col: str, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per slice, the totals of the slices before it and of all slices. Input: one row per (by, slice)."""
    group = Window.partitionBy(*by or [F.lit(0)])
    before = group.orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *by,
        slice_col,
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"{m}__before") for m in measures],
        *[F.sum(m).over(group).alias(f"{m}__all") for m in measures],
    )


def running_totals(
    counts: DataFrame, value: str, slice_col: str, measures: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Adds ``<measure>__upto``, the total of each measure over all values <= this one,
    and ``<measure>__all``, the total of its group.

    ``counts`` holds one row per (by, value); the ``by`` and slice columns must not
    be NULL. Its exchange is read twice (slice totals, rows); the join and the
    window share a partitioning. A group with a large share of the rows is
    spread over its slices.
    """
    keys = [*by, slice_col]
    totals = counts.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    offsets = slice_offsets(totals, slice_col, measures, by)
    inside = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return counts.join(offsets, keys).withColumns(
        {f"{m}__upto": F.sum(m).over(inside) + F.col(f"{m}__before") for m in measures}
    )
