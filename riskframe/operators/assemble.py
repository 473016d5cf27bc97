"""Joining entity-level tables, and key checks across tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.expr import col


class DuplicateKeyError(ValueError):
    """A join that must be one-to-one met a repeated key."""


@dataclass(frozen=True)
class Side:
    """A table to join. ``unique`` says its key is unique by construction (a roll-up)."""

    df: DataFrame
    unique: bool = False


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def check_unique(df: DataFrame, key: str, label: str, examples: int = 5) -> None:
    found = [r[0] for r in duplicate_keys(df, key).select(col(key)).limit(examples).collect()]
    if found:
        raise DuplicateKeyError(f"duplicate {key} values in {label}: {found}")


def assemble(entity: DataFrame | Side, sides: Sequence[DataFrame | Side], on: str) -> DataFrame:
    """Left-joins every side to the entity table, one row to at most one row.

    Tables not marked ``unique`` are checked by a narrow aggregate on the key.
    All joins use one key, so the growing left table is shuffled once.
    """
    wrapped = [s if isinstance(s, Side) else Side(s) for s in [entity, *sides]]
    for i, side in enumerate(wrapped):
        if not side.unique:
            check_unique(side.df, on, "the entity table" if i == 0 else f"side table {i}")
    joined = wrapped[0].df
    for side in wrapped[1:]:
        joined = joined.join(side.df, on, "left")
    return joined


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys present in both tables. Both sides are reduced to distinct keys first."""
    return left.select(col(key)).distinct().join(right.select(col(key)).distinct(), key, "left_semi")


def check_no_overlap(left: DataFrame, right: DataFrame, key: str, examples: int = 5) -> None:
    shared = [r[0] for r in key_overlap(left, right, key).orderBy(col(key)).limit(examples).collect()]
    if shared:
        raise ValueError(f"{key} values overlap between the splits: {shared}")
