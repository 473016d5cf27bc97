"""Column expressions used by the feature plans. Everything here stays inside Catalyst."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
RATIO_EPSILON = 1e-6
DAYS_PER_YEAR = 365
EMPLOYMENT_SENTINEL = 365243
ZERO_STATUS_CODES = ("C", "X", "0")
HIGH_RISK_FROM = 0.7
MEDIUM_RISK_FROM = 0.4
BANDS = ("high_risk", "medium_risk", "low_risk")


def quoted(name: str) -> str:
    """A column name that may hold blanks, dots or slashes, quoted for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def _as_col(value: Column | str) -> Column:
    return col(value) if isinstance(value, str) else value


def is_missing(value: Column | str, floating: bool = False) -> Column:
    """NULL, and for floating columns NaN as well."""
    value = _as_col(value)
    return value.isNull() | F.isnan(value) if floating else value.isNull()


# --- ratios -----------------------------------------------------------------


def eps_ratio(num: Column | str, den: Column | str, eps: float = RATIO_EPSILON) -> Column:
    """``num / (den + eps)``; NULL if the shifted denominator is exactly zero."""
    return F.try_divide(_as_col(num).cast("double"), _as_col(den).cast("double") + F.lit(float(eps)))


def plain_ratio(num: Column | str, den: Column | str, on_zero: float | None = None) -> Column:
    """``num / den``; a zero denominator gives ``on_zero`` (NULL unless stated)."""
    den = _as_col(den).cast("double")
    ratio = F.try_divide(_as_col(num).cast("double"), den)
    return ratio if on_zero is None else F.when(den == 0, F.lit(float(on_zero))).otherwise(ratio)


# --- day offsets and magic values ---------------------------------------------


def sentinel_flag(value: Column | str, sentinel) -> Column:
    return F.when(_as_col(value) == F.lit(sentinel), 1).otherwise(0)


def sentinel_to_null(value: Column | str, sentinel) -> Column:
    return F.nullif(_as_col(value), F.lit(sentinel))


def days_to_years(days: Column | str, eps: float = RATIO_EPSILON) -> Column:
    """Offsets count backwards from the application, so the sign is flipped."""
    return -_as_col(days).cast("double") / F.lit(DAYS_PER_YEAR + eps)


def tenure_share(days: Column | str, life_days: Column | str, eps: float = RATIO_EPSILON) -> Column:
    """Length of one backward offset as a share of another."""
    return eps_ratio(-_as_col(days), -_as_col(life_days), eps)


def day_gap(actual: Column | str, due: Column | str) -> Column:
    """How much later ``actual`` is than ``due``; NULL if either is NULL."""
    return _as_col(actual) - _as_col(due)


# --- flags and counts ----------------------------------------------------------


def condition_flag(predicate: Column, yes: int = 1) -> Column:
    """1 (or ``yes``) where the predicate holds, 0 where it fails or is unknown."""
    return F.when(predicate, yes).otherwise(0)


def missing_indicator(value: Column | str, floating: bool = False) -> Column:
    return is_missing(value, floating).cast("int")


def flag_sum(flags: Iterable[Column | str]) -> Column:
    """Sum across columns with NULL counted as 0."""
    return reduce(add, [F.coalesce(_as_col(flag), F.lit(0)) for flag in flags])


def code_to_number(code: Column | str, zeros: Sequence[str] = ZERO_STATUS_CODES, lenient: bool = False) -> Column:
    """Listed codes count 0, every other code is its own number.

    A code that is neither raises, or becomes NULL with ``lenient``.
    """
    code = _as_col(code)
    number = code.try_cast("int") if lenient else code.cast("int")
    return F.when(code.isin(*zeros), 0).otherwise(number)


# --- aggregates ----------------------------------------------------------------


def count_where(predicate: Column) -> Column:
    return F.sum(condition_flag(predicate))


def share_where(predicate: Column, weight: int = 1) -> Column:
    """Mean of a flag. ``weight`` scales the flag, so 30 gives thirty times the share."""
    return F.avg(condition_flag(predicate, weight))


def last_offset_where(predicate: Column, offset: Column | str) -> Column:
    """Distance back to the most recent event that meets the predicate."""
    return -F.max(F.when(predicate, _as_col(offset)))


def mean_of_ratio(num: Column | str, den: Column | str, eps: float | None = RATIO_EPSILON) -> Column:
    return F.avg(plain_ratio(num, den) if eps is None else eps_ratio(num, den, eps))


# --- decisions -----------------------------------------------------------------


def risk_band(probability: Column | str, high: float = HIGH_RISK_FROM, mid: float = MEDIUM_RISK_FROM) -> Column:
    p = _as_col(probability)
    return F.when(p >= high, BANDS[0]).when(p >= mid, BANDS[1]).otherwise(BANDS[2])


def decide(probability: Column | str, threshold: float) -> Column:
    return (_as_col(probability) >= F.lit(float(threshold))).cast("int")


def logistic(features: dict[str, float], intercept: float = 0.0) -> Column:
    """Probability of a logistic model with known coefficients."""
    score = reduce(add, [F.lit(float(w)) * col(name) for name, w in features.items()], F.lit(float(intercept)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))
