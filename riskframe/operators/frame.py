"""Column surgery: choosing, checking, dropping, renaming, filling."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expr import col, is_missing
from riskframe.operators.ordering import add_slices, slice_offsets, slice_points

FLOATING = (T.DoubleType, T.FloatType)


def floating_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema if isinstance(f.dataType, FLOATING)}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in columns])


def missing_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in columns if c not in have]


def require_columns(df: DataFrame, columns: Sequence[str], label: str = "input") -> DataFrame:
    """The listed columns in the listed order; names what is absent otherwise."""
    absent = missing_columns(df, columns)
    if absent:
        raise ValueError(f"{label} lacks columns: {', '.join(absent)}")
    return project(df, columns)


def drop_columns(df: DataFrame, columns: Iterable[str], protect: Iterable[str] = ()) -> DataFrame:
    keep = set(protect)
    return df.drop(*[c for c in columns if c in df.columns and c not in keep])


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def row_missing_count(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """How many of the columns are missing in a row."""
    floating = floating_columns(df)
    parts = [is_missing(c, c in floating).cast("int") for c in (columns or df.columns)]
    return reduce(add, parts, F.lit(0))


def sparse_columns(df: DataFrame, max_missing: float) -> list[str]:
    """Columns with fewer than ``int(rows * (1 - max_missing))`` values, in one pass."""
    if max_missing <= 0:
        return []
    floating = floating_columns(df)
    filled = [F.count_if(~is_missing(c, c in floating)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *filled).first()
    needed = int(counts["rows"] * max(0.0, 1 - max_missing))
    return [c for i, c in enumerate(df.columns) if counts[f"n{i}"] < needed]


def drop_sparse_columns(df: DataFrame, max_missing: float, protect: Iterable[str] = ()) -> DataFrame:
    return drop_columns(df, sparse_columns(df, max_missing), protect)


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing numbers become 0 and missing flags false; NaN counts as missing."""
    chosen = set(columns or df.columns)
    out = []
    for field in df.schema:
        c = col(field.name)
        if field.name in chosen and isinstance(field.dataType, FLOATING):
            c = F.coalesce(F.nanvl(c, F.lit(0.0).cast(field.dataType)), F.lit(0.0).cast(field.dataType))
        elif field.name in chosen and isinstance(field.dataType, T.NumericType):
            c = F.coalesce(c, F.lit(0).cast(field.dataType))
        elif field.name in chosen and isinstance(field.dataType, T.BooleanType):
            c = F.coalesce(c, F.lit(False))
        out.append(c.alias(field.name))
    return df.select(*out)


def to_double_matrix(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[col(c) for c in keep], *[col(c).cast("double").alias(c) for c in columns])


def numeric_values(value: Column) -> Column:
    """The value as a number; text that is no number, and NaN, become NULL."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` value per key, as one partial aggregate (no sort)."""
    picked = F.max_by(F.struct(*[col(c) for c in columns]), col(order)).alias("__latest")
    return df.groupBy(*keys).agg(picked).select(*keys, "__latest.*")


def top_k(df: DataFrame, by: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*by).limit(k)


def with_row_id(df: DataFrame, key: str, name: str = "row_id") -> DataFrame:
    """0-based position in the order of a unique numeric or time key."""
    points = slice_points(df, [key])
    sliced = add_slices(df, points)
    offsets = slice_offsets(sliced.groupBy("__slice_0").agg(F.count(F.lit(1)).alias("n")), "__slice_0", ["n"])
    place = F.row_number().over(Window.partitionBy("__slice_0").orderBy(col(key))) - 1
    return (
        sliced.withColumn("__place", place)
        .join(offsets, "__slice_0")
        .select(*[col(c) for c in df.columns], (F.col("__place") + F.col("n__before")).cast("long").alias(name))
    )


def with_entity_or_row_id(df: DataFrame, entity: str | None, order_key: str) -> tuple[DataFrame, str]:
    """The entity column if the frame has it, otherwise a ``row_id``; also the name to use."""
    if entity and entity in df.columns:
        return df, entity
    return with_row_id(df, order_key), "row_id"
