"""Preparation of the application table alone, without history tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from riskframe.functions import expr as X
from riskframe.operators.encode import MAX_LEVELS, fit_vocabulary, one_hot, read_vocabulary
from riskframe.operators.frame import (
    drop_columns,
    drop_sparse_columns,
    fill_zero,
    floating_columns,
    row_missing_count,
    string_columns,
)
from riskframe.plans.loan_features import ADDRESS_FLAGS, CONTACT_FLAGS, DOCUMENT_FLAGS, INDICATED, RATIOS


@dataclass(frozen=True)
class FlatConfig:
    eps: float = X.RATIO_EPSILON
    sentinel: int | None = X.EMPLOYMENT_SENTINEL
    indicated: Sequence[str] = tuple(INDICATED)
    missing_count: bool = True
    ratios: dict[str, tuple[str, str]] = field(default_factory=lambda: dict(RATIOS))
    flag_sums: dict[str, Sequence[str]] = field(
        default_factory=lambda: {
            "DOC_COUNT": DOCUMENT_FLAGS,
            "CONTACT_COUNT": CONTACT_FLAGS,
            "ADDR_MISMATCH_SUM": ADDRESS_FLAGS,
        }
    )
    max_missing: float = 0.4
    drop: Sequence[str] = ()
    categorical_drop: Sequence[str] = ("NAME_TYPE_SUITE", "OCCUPATION_TYPE", "ORGANIZATION_TYPE")


def derived_columns(df: DataFrame, config: FlatConfig) -> DataFrame:
    """Row-wise features from whichever source columns the frame has."""
    have = set(df.columns)
    new = {}
    if "DAYS_BIRTH" in have:
        new["AGE_YEARS"] = X.days_to_years("DAYS_BIRTH", config.eps)
    if config.sentinel is not None and "DAYS_EMPLOYED" in have:
        replaced = X.sentinel_to_null("DAYS_EMPLOYED", config.sentinel)
        new["DAYS_EMPLOYED_ANOM"] = X.sentinel_flag("DAYS_EMPLOYED", config.sentinel)
        new["DAYS_EMPLOYED_REPLACED"] = replaced
        new["EMPLOYED_YEARS"] = X.days_to_years(replaced, config.eps)
        if "DAYS_BIRTH" in have:
            new["EMPLOYMENT_YEARS_TO_AGE"] = X.tenure_share(replaced, "DAYS_BIRTH", config.eps)
    floating = floating_columns(df)
    new |= {f"{c}_IS_MISSING": X.missing_indicator(c, c in floating) for c in config.indicated if c in have}
    return df.withColumns(new) if new else df


def prepare_flat_table(
    df: DataFrame,
    target: str,
    config: FlatConfig = FlatConfig(),
    drop: Sequence[str] = (),
    max_levels: int = MAX_LEVELS,
) -> DataFrame:
    """Drop, derive, count, encode and zero-fill. The missing count includes derived columns."""
    out = derived_columns(drop_columns(df, drop, protect=(target,)), config)
    if config.missing_count:
        gaps = row_missing_count(out)
        out = out.withColumns({"missing_count": gaps, "TOT_MISSING_COUNT": gaps})
    have = set(out.columns)
    more = {n: X.eps_ratio(a, b, config.eps) for n, (a, b) in config.ratios.items() if a in have and b in have}
    for name, flags in config.flag_sums.items():
        present = [f for f in flags if f in have]
        if present:
            more[name] = X.flag_sum(present)
    if more:
        out = out.withColumns(more)
    out = drop_sparse_columns(out, config.max_missing)
    out = drop_columns(out, [*config.drop, *config.categorical_drop], protect=(target,))
    texts = [c for c in string_columns(out) if c != target]
    vocabulary = {c: [] for c in texts} | (
        read_vocabulary(fit_vocabulary(out, texts), max_levels, len(texts)) if texts else {}
    )
    return fill_zero(one_hot(out, vocabulary))


def selected_columns(df: DataFrame, target: str, selected: Sequence[str] = ()) -> list[str]:
    """The configured model columns, or every column but the target."""
    absent = [c for c in selected if c not in df.columns]
    if absent:
        raise ValueError(f"selected columns are missing: {', '.join(absent)}")
    return list(selected) or [c for c in df.columns if c != target]


