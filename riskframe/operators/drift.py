"""Distribution drift between a reference and a current table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expr import col, is_missing
from riskframe.functions.kolmogorov import asymptotic_p, exact_p
from riskframe.operators.frame import floating_columns, numeric_values, project
from riskframe.operators.ordering import add_slices, as_number, running_totals, slice_offsets, slice_points
from riskframe.operators.sampling import Key, sample_exact
from riskframe.operators.storage import stored

# Fixed values.
P_VALUE_THRESHOLD = 0.05
DATASET_DRIFT_SHARE = 0.1
RETRAIN_SHARE = 0.3
SAMPLE_SEED = 42

COLUMNS_SCHEMA = "column string, ks_statistic double, n_ref bigint, n_cur bigint, p_value double, drift_detected boolean"


def monitored_columns(
    df: DataFrame,
    features: Sequence[str] = (),
    target: str | None = None,
    entity: str | None = None,
    max_features: int | None = None,
) -> list[str]:
    """Requested columns that exist (all if none do), without target and entity, first N by position."""
    other = {target, entity}
    chosen = [c for c in features if c in df.columns and c not in other]
    if not chosen:
        chosen = [c for c in df.columns if c not in other]
    return chosen[:max_features] if max_features and max_features > 0 else chosen


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at most one distinct value, missing counting as a value.

    Needs only min, max and a missing count per column, not distinct counts.
    """
    floating = floating_columns(df)
    parts = []
    for i, c in enumerate(columns):
        absent = is_missing(c, c in floating)
        value = F.when(~absent, col(c))
        parts += [
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
            F.count_if(absent).alias(f"gaps{i}"),
        ]
    row = df.agg(*parts).first() if parts else None
    found = []
    for i, c in enumerate(columns):
        kinds = 0 if row[f"lo{i}"] is None else (1 if row[f"lo{i}"] == row[f"hi{i}"] else 2)
        if kinds + (row[f"gaps{i}"] > 0) <= 1:
            found.append(c)
    return found


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    return numeric_values(col(name)) if isinstance(kind, T.StringType) else numeric_values(as_number(df, name))


def _value_counts(
    df: DataFrame, columns: Sequence[str], points: dict[str, list[float]], by: Sequence[str] = (), **counts: Column
) -> DataFrame:
    """Rows per (column number, slice, value) and ``by``. A cell carries its column's number, not its name."""
    names = list(points)
    numbers = df.select(*[_number(df, c).alias(n) for c, n in zip(columns, names)], *by, *[v.alias(k) for k, v in counts.items()])
    sliced = add_slices(numbers, points)
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("no"), F.col(f"__slice_{i}").alias("slice"), F.col(n).alias("value"))
            for i, n in enumerate(names)
        ]
    )
    return (
        sliced.select(*by, *counts, F.explode(cells).alias("x"))
        .select(*by, *counts, "x.*")
        .filter("value is not null")
        .groupBy("no", "slice", "value", *by)
        .agg(*[F.sum(k).alias(k) for k in counts])
    )


def _largest_gaps(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """From counts per value (ref, cur) to the distance per column."""
    placed = running_totals(counts, "value", "slice", ["ref", "cur"], ["no"])
    gap = F.abs(F.col("ref__upto") / F.col("ref__all") - F.col("cur__upto") / F.col("cur__all"))
    label = F.get(F.array(*[F.lit(c) for c in columns]), F.col("no"))
    return (
        placed.filter("ref__all > 0 and cur__all > 0")
        .groupBy("no")
        .agg(F.max(gap).alias("ks_statistic"), F.max("ref__all").alias("n_ref"), F.max("cur__all").alias("n_cur"))
        .select(label.alias("column"), "ks_statistic", "n_ref", "n_cur")
    )


def ks_statistic(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Largest distance between the two distribution functions, per column.

    Both sides are unpivoted and counted per distinct value (combined on the
    map side), then accumulated slice by slice. A column without a number on
    either side does not appear.
    """
    names = [f"v{i}" for i in range(len(columns))]
    sides = [
        df.select(*[_number(df, c).alias(n) for c, n in zip(columns, names)], F.lit(flag).alias("__ref"))
        for df, flag in ((reference, 1), (current, 0))
    ]
    both = sides[0].unionByName(sides[1])
    counts = _value_counts(both, names, slice_points(both, names), ref=F.col("__ref"), cur=1 - F.col("__ref"))
    return _largest_gaps(counts, columns)


def ks_statistic_by(df: DataFrame, columns: Sequence[str], by: str, is_reference: Column) -> DataFrame:
    """The distance of every group of ``by`` from the same reference rows, per column, from one reading of the table.

    Rows for which ``is_reference`` holds are the reference, the others belong to their group (a NULL group is one). Between two values of a
    group only the reference grows, so it is enough to compare at the group's own values, with and without the value itself.
    """
    names = [f"v{i}" for i in range(len(columns))]
    flag = F.coalesce(is_reference, F.lit(False)).cast("int")
    group = F.when(flag == 0, F.struct(col(by).alias("g")))
    numbers = df.select(*[_number(df, c).alias(n) for c, n in zip(columns, names)], group.alias("__group"), flag.alias("__ref"))
    points = slice_points(numbers, names)
    counts = _value_counts(
        numbers, names, points, ("__group",), ref=F.col("__ref").cast("long"), cur=(1 - F.col("__ref")).cast("long")
    )
    totals = counts.groupBy("no", "slice").agg(F.sum("ref").alias("ref"))
    inside = Window.partitionBy("no", "slice").orderBy("value")
    upto = F.sum("ref").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("ref__before")
    here = F.sum("ref").over(inside.rangeBetween(Window.currentRow, Window.currentRow))
    merged = counts.join(slice_offsets(totals, "slice", ["ref"], ["no"]), ["no", "slice"])
    merged = merged.withColumns({"ref__upto": upto, "ref__here": here}).filter("cur > 0")
    placed = running_totals(merged, "value", "slice", ["cur"], ["no", "__group"])
    share = lambda ref, cur: F.abs(F.try_divide(ref, F.col("ref__all")) - cur / F.col("cur__all"))
    gap = F.greatest(
        share(F.col("ref__upto"), F.col("cur__upto")),
        share(F.col("ref__upto") - F.col("ref__here"), F.col("cur__upto") - F.col("cur")),
    )
    label = F.get(F.array(*[F.lit(c) for c in columns]), F.col("no"))
    return (
        placed.filter("ref__all > 0")
        .groupBy("no", "__group")
        .agg(F.max(gap).alias("ks_statistic"), F.max("ref__all").alias("n_ref"), F.max("cur__all").alias("n_cur"))
        .select(F.col("__group.g").alias(by), label.alias("column"), "ks_statistic", "n_ref", "n_cur")
    )


@dataclass(frozen=True)
class PreparedReference:
    """What every comparison with the same reference shares: its columns, slices and stored counts per value."""

    columns: list[str]
    dropped_constant: list[str]
    not_monitored: list[str]
    points: dict[str, list[float]]
    counts: DataFrame | None


def prepare_reference(
    reference: DataFrame,
    features: Sequence[str] = (),
    target: str | None = None,
    entity: str | None = None,
    max_features: int | None = None,
) -> PreparedReference:
    """Reads the reference once, so that arriving batches need not."""
    columns = monitored_columns(reference, features, target, entity, max_features)
    left_out = [c for c in monitored_columns(reference, (), target, entity) if c not in columns]
    constant = constant_columns(reference, columns)
    tested = [c for c in columns if c not in constant]
    if not tested:
        return PreparedReference([], constant, left_out, {}, None)
    numbers = reference.select(*[_number(reference, c).alias(f"v{i}") for i, c in enumerate(tested)])
    points = slice_points(numbers, numbers.columns)
    counts = stored(_value_counts(reference, tested, points, ref=F.lit(1)), "reference-counts")
    return PreparedReference(tested, constant, left_out, points, counts)


def drift_against(
    prepared: PreparedReference, current: DataFrame, threshold: float = P_VALUE_THRESHOLD, method: str = "asymptotic"
) -> DriftReport:
    """The drift report of a table against a prepared reference; the slices of the reference serve both."""
    if prepared.counts is None:
        empty = current.sparkSession.createDataFrame([], COLUMNS_SCHEMA)
        return DriftReport(empty, drift_summary(empty), prepared.dropped_constant, prepared.not_monitored)
    arrived = _value_counts(current, prepared.columns, prepared.points, cur=F.lit(1))
    both = prepared.counts.withColumn("cur", F.lit(0).cast("long")).unionByName(
        arrived.withColumn("ref", F.lit(0).cast("long"))
    )
    counts = both.groupBy("no", "slice", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    flags = drift_flags(ks_pvalue(_largest_gaps(counts, prepared.columns), method), threshold)
    return DriftReport(flags, drift_summary(flags), prepared.dropped_constant, prepared.not_monitored)


def ks_pvalue(stats: DataFrame, method: str = "asymptotic") -> DataFrame:
    """Adds the two-sided p-value: the limiting form, or the exact one on request.

    Exact work per column: n / (n x distance) terms for equal sizes n, else n x m steps at most.
    """
    args = [F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur")]
    if method == "asymptotic":
        return stats.withColumn("p_value", asymptotic_p(*args))
    if method == "exact":
        return stats.withColumn("p_value", exact_p(*args))
    raise ValueError(f"unknown p-value method {method!r}")


def drift_flags(stats: DataFrame, threshold: float = P_VALUE_THRESHOLD) -> DataFrame:
    return stats.withColumn("drift_detected", F.col("p_value") < threshold)


def drift_summary(flags: DataFrame, dataset_share: float = DATASET_DRIFT_SHARE, by: Sequence[str] = ()) -> DataFrame:
    """Share of drifted columns, unrounded, and the verdict for the whole table; nothing tested gives share 0."""
    drifted = F.coalesce(F.count_if("drift_detected"), F.lit(0))
    counts = flags.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_tested"),
        drifted.alias("n_drifted"),
        F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("column")))).alias("drifted_columns"),
    )
    share = F.col("n_drifted") / F.greatest(F.col("n_tested"), F.lit(1))
    return counts.select(
        *by,
        "n_tested",
        "n_drifted",
        share.alias("share_drifted_columns"),
        ((share >= dataset_share) & (F.col("n_drifted") > 0)).alias("dataset_drift"),
        "drifted_columns",
    )


@dataclass(frozen=True)
class DriftReport:
    columns: DataFrame
    summary: DataFrame
    dropped_constant: list[str]
    not_monitored: list[str]
    enabled: bool = True


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] = (),
    target: str | None = None,
    entity: str | None = None,
    max_features: int | None = None,
    reference_rows: int | None = None,
    current_rows: int | None = None,
    sample_key: Key | None = None,
    threshold: float = P_VALUE_THRESHOLD,
    method: str = "asymptotic",
    enabled: bool = True,
) -> DriftReport:
    """Column choice, constant columns, distances, p-values and summary in one call.

    The row limits are the monitoring feature of comparing a fixed-size sample;
    by default all rows are compared.
    """
    empty = reference.sparkSession.createDataFrame([], COLUMNS_SCHEMA)
    if not enabled:
        return DriftReport(empty, drift_summary(empty), [], [], enabled=False)
    if reference_rows or current_rows:
        key = sample_key or entity
        if key is None:
            raise ValueError("sampling needs a key that identifies a row")
        reference = sample_exact(reference, reference_rows, SAMPLE_SEED, key, clamp=True)
        current = sample_exact(current, current_rows, SAMPLE_SEED, key, clamp=True)
    columns = monitored_columns(reference, features, target, entity, max_features)
    everything = monitored_columns(reference, (), target, entity)
    left_out = [c for c in everything if c not in columns]
    constant = constant_columns(reference, columns)
    tested = [c for c in columns if c not in constant]
    if not tested:
        return DriftReport(empty, drift_summary(empty), constant, left_out)
    stats = ks_statistic(project(reference, tested), project(current, tested), tested)
    flags = drift_flags(ks_pvalue(stats, method), threshold)
    return DriftReport(flags, drift_summary(flags), constant, left_out)


def retrain_decision(
    summary: DataFrame,
    auto_retrain: bool,
    threshold: float = RETRAIN_SHARE,
    force: bool = False,
    command: str | None = None,
) -> DataFrame:
    """Per summary row: retrain or not, and why, judged on the unrounded share. The command is named, never run."""
    drifted = F.col("dataset_drift") & (F.col("share_drifted_columns") >= threshold) & F.lit(auto_retrain)
    reason = (
        F.when(drifted, "dataset_drift").when(F.lit(force), "manual_override").otherwise("threshold_not_met")
    )
    return summary.withColumn("reason", reason).withColumns(
        {
            "triggered": F.col("reason") != "threshold_not_met",
            "command": F.when(F.col("reason") != "threshold_not_met", F.lit(command)),
        }
    )


def drift_metrics_row(summary: DataFrame, reference: str, current: str, generated_at: Column | None = None) -> DataFrame:
    """The summary as a history row, the share rounded to four digits."""
    return summary.select(
        (generated_at if generated_at is not None else F.current_timestamp()).alias("generated_at"),
        F.lit(reference).alias("reference_path"),
        F.lit(current).alias("current_path"),
        *[
            F.round(c, 4).alias(c) if c == "share_drifted_columns" else col(c)
            for c in summary.columns
        ],
    )
