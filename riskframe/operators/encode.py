"""Category encoding, exact median imputation and scaling. Fit small state, then apply it as a map."""

from __future__ import annotations

import math
import struct
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.expr import col, is_missing
from riskframe.operators.frame import floating_columns, numeric_columns, string_columns

#: Default of the ``max_levels`` arguments: each level of a column becomes an output column.
MAX_LEVELS = 1000
MEDIAN_MARGIN = 1e-4
BUCKETS = 256
_MAGNITUDE = (1 << 63) - 1


# --- categories -----------------------------------------------------------------


def fit_vocabulary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct (column, value) pairs of the text columns, NULL left out."""
    columns = list(columns if columns is not None else string_columns(df))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*").filter("value is not null").distinct()


def read_vocabulary(
    vocabulary: DataFrame, max_levels: int = MAX_LEVELS, columns: int | None = None
) -> dict[str, list[str]]:
    """The levels per column in sorted order, read with a row bound.

    Each level becomes an output column, so more than ``max_levels`` are an error, and no more than
    ``max_levels`` rows per column ever reach the driver. Without the number of columns it is counted.
    """
    if columns is None:
        columns = vocabulary.select("column").distinct().count()
    bound = max_levels * columns
    rows = vocabulary.limit(bound + 1).collect()
    levels: dict[str, list[str]] = {}
    for row in rows:
        levels.setdefault(row["column"], []).append(row["value"])
    wide = sorted(c for c, values in levels.items() if len(values) > max_levels)
    if wide or len(rows) > bound:
        raise ValueError(f"more than {max_levels} levels in: {', '.join(wide) or 'the text columns together'}")
    return {c: sorted(v) for c, v in levels.items()}


def one_hot(df: DataFrame, vocabulary: Mapping[str, Sequence[str]]) -> DataFrame:
    """Each column becomes one 0/1 column per level, named ``<column>_<level>``, placed last.

    A NULL gives all zeros. No level is left out.
    """
    kept = [c for c in df.columns if c not in vocabulary]
    flags = {
        f"{c}_{level}": col(c).eqNullSafe(F.lit(level)).cast("int")
        for c in df.columns
        for level in vocabulary.get(c, ())
    }
    clash = sorted(set(kept) & set(flags))
    if clash:
        raise ValueError(f"encoded names already exist: {', '.join(clash)}")
    return df.select(*[col(c) for c in kept], *[flag.alias(name) for name, flag in flags.items()])


# --- medians --------------------------------------------------------------------


def order_number(value: float) -> int:
    """The place of a double in the order of all doubles: its 64 bits, with the negative ones turned around. -0.0 counts as 0.0."""
    bits = struct.unpack("<q", struct.pack("<d", value + 0.0))[0]
    return bits if bits >= 0 else -(bits & _MAGNITUDE)


def ordered_double(number: int) -> float:
    """The double at a place of that order."""
    size = struct.unpack("<d", struct.pack("<q", abs(number)))[0]
    return -size if number < 0 else size


@dataclass
class _Place:
    """A place (1-based) among the values of a column that lie in ``low..high``."""

    column: int
    low: float
    high: float
    place: int
    value: float | None = None

    def bracket(self) -> tuple[int, float, float]:
        return self.column, self.low, self.high

    def splits(self) -> list[float]:
        """Bounds that cut the doubles of the bracket, as many as there are, into BUCKETS equal parts."""
        low, high = order_number(self.low), order_number(self.high)
        cuts = {ordered_double(low + (high - low + 1) * i // BUCKETS) for i in range(1, BUCKETS)}
        return [-math.inf, *sorted(c for c in cuts if self.low < c <= self.high and not math.isinf(c)), math.inf]


def _narrow(numbers: DataFrame, open_places: Sequence[_Place]) -> None:
    """One pass: counts the buckets of every bracket and moves each place into the bucket that holds it."""
    brackets = list({p.bracket(): p for p in open_places}.values())  # both middle places often share one
    at = {p.bracket(): t for t, p in enumerate(brackets)}
    inside = numbers.select(
        *[F.when(F.col(f"v{p.column}").between(p.low, p.high), F.col(f"v{p.column}")).alias(f"x{t}") for t, p in enumerate(brackets)]
    )
    inside = inside.filter(F.coalesce(*[F.col(c) for c in inside.columns]).isNotNull())  # few rows have a value near a middle
    cutter = Bucketizer(
        splitsArray=[p.splits() if len(p.splits()) > 2 else [-math.inf, 0.0, math.inf] for p in brackets],
        inputCols=inside.columns,
        outputCols=[f"b{t}" for t in range(len(brackets))],
        handleInvalid="keep",  # missing values stay missing
    )
    cells = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"x{t}").isNotNull(),
                    F.struct(F.lit(t).alias("t"), F.col(f"b{t}").cast("int").alias("b"), F.col(f"x{t}").alias("v")),
                )
                for t in range(len(brackets))
            ]
        )
    )
    counted = (
        cutter.transform(inside)
        .select(F.explode(cells).alias("x"))
        .groupBy("x.t", "x.b")
        .agg(F.count(F.lit(1)).alias("n"), F.min("x.v").alias("low"), F.max("x.v").alias("high"))
    )
    found: dict[int, list] = {}
    for row in counted.collect():  # at most BUCKETS rows per bracket
        found.setdefault(row["t"], []).append(row)
    for p in open_places:
        for row in sorted(found[at[p.bracket()]], key=lambda r: r["b"]):
            if p.place <= row["n"]:
                p.low, p.high = row["low"], row["high"]
                if p.place == 1 or p.low == p.high:
                    p.value = p.low
                elif p.place == row["n"]:
                    p.value = p.high
                break
            p.place -= row["n"]


def fit_medians(
    df: DataFrame, columns: Sequence[str] | None = None, margin: float = MEDIAN_MARGIN
) -> dict[str, float | None]:
    """Exact medians (midpoint of the middle two) of numeric columns, missing values skipped.

    One pass brackets each median between two near quantiles, the next counts what lies below. Then the values inside the
    bracket are counted in buckets, and the bucket that holds the place becomes the next bracket, until its least
    or largest value is the one wanted. Buckets hold equally many of the doubles that there are, not equal distances, so each
    pass settles at least eight of a value's 64 bits: after eight passes all places are known, whatever the values. A quantile that
    missed just starts from the bracket of all doubles. Only cells inside a bracket leave their row, as counts, so no
    task holds a column. A column without values has None.
    """
    columns = list(columns if columns is not None else numeric_columns(df))
    if not columns:
        return {}
    values = {f"v{i}": col(c).cast("double") for i, c in enumerate(columns)}
    numbers = df.select(*[F.when(~F.isnan(v), v + F.lit(0.0)).alias(n) for n, v in values.items()])  # no -0.0
    shares = [0.5 - 2 * margin, 0.5 + 2 * margin]
    brackets = {i: q for i, q in enumerate(numbers.approxQuantile(numbers.columns, shares, margin)) if q}
    if not brackets:
        return dict.fromkeys(columns)
    sizes = numbers.agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in brackets],
        *[F.count_if(F.col(f"v{i}") < low).alias(f"below{i}") for i, (low, _) in brackets.items()],
        *[F.count_if(F.col(f"v{i}") <= high).alias(f"upto{i}") for i, (_, high) in brackets.items()],
    ).first()
    places: list[_Place] = []
    for i, (low, high) in brackets.items():
        n, below = sizes[f"n{i}"], sizes[f"below{i}"]
        for place in ((n + 1) // 2, n // 2 + 1):
            inside = below < place <= sizes[f"upto{i}"]
            known = low if inside and low == high else None  # a bracket of one value, as columns of few values have it
            places.append(_Place(i, low, high, place - below, known) if inside else _Place(i, -math.inf, math.inf, place))
    while open_places := [p for p in places if p.value is None]:
        _narrow(numbers, open_places)
    middle: dict[int, list[float]] = {}
    for p in places:
        middle.setdefault(p.column, []).append(p.value)
    return {c: _between(*middle[i]) if i in middle else None for i, c in enumerate(columns)}


def _between(a: float, b: float) -> float:
    """The midpoint, also where the distance is more than a double holds."""
    return a if a == b else a + (b - a) / 2 if math.isfinite(b - a) else (a + b) / 2


def columns_with_gaps(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that have anything to impute, from one pass of counts."""
    floating = floating_columns(df)
    if not columns:
        return []
    gaps = df.agg(*[F.count_if(is_missing(c, c in floating)).alias(f"g{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if gaps[i] > 0]


def impute_median(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    """Missing numbers become the column's median; a column without a median stays as it is."""
    floating = floating_columns(df)
    filled = []
    for c in df.columns:
        if medians.get(c) is None:
            filled.append(col(c))
        else:
            missing = is_missing(c, c in floating)
            filled.append(F.when(missing, F.lit(float(medians[c]))).otherwise(col(c).cast("double")).alias(c))
    return df.select(*filled)


# --- scaling --------------------------------------------------------------------


def fit_scale(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation; a constant column gets divisor 1."""
    stats = df.agg(
        *[F.avg(col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (stats[f"m{i}"] or 0.0, stats[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def standardize(df: DataFrame, columns: Sequence[str], scale: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    scale = scale or fit_scale(df, columns)
    out = {c: (col(c).cast("double") - F.lit(scale[c][0])) / F.lit(scale[c][1]) for c in columns}
    return df.select(*[out[c].alias(c) if c in out else col(c) for c in df.columns])


def assemble_vector(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="error").transform(df)
