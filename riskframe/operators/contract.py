"""Table contracts: declared once, counted in one aggregate, usable row by row."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.expr import col, is_missing
from riskframe.operators.assemble import duplicate_keys
from riskframe.operators.frame import FLOATING, floating_columns, missing_columns

REPORT_SCHEMA = "table string, column string, check string, failures bigint, passed boolean"


@dataclass(frozen=True)
class Rule:
    """A named condition that every non-missing value must meet."""

    name: str
    holds: Callable[[Column], Column]


NON_NEGATIVE = Rule("non_negative", lambda c: c >= 0)
NON_POSITIVE = Rule("non_positive", lambda c: c <= 0)


def one_of(*values) -> Rule:
    return Rule("one_of", lambda c: c.isin(*values))


def sentinel_or_non_positive(sentinel) -> Rule:
    return Rule("sentinel_or_non_positive", lambda c: (c <= 0) | (c == F.lit(sentinel)))


@dataclass(frozen=True)
class Field:
    kind: str = "double"
    nullable: bool = True
    rules: tuple[Rule, ...] = ()
    unique: bool = False


@dataclass(frozen=True)
class Contract:
    """Columns that must be there and what must hold for them. Other columns are free,
    unless ``strict`` refuses them."""

    name: str
    fields: Mapping[str, Field] = field(default_factory=dict)
    strict: bool = False


def _row_checks(df: DataFrame, contract: Contract) -> dict[tuple[str, str], Column]:
    """(column, check) -> true where a row breaks it. Columns the frame lacks are left out."""
    floating = floating_columns(df)
    checks: dict[tuple[str, str], Column] = {}
    for name, spec in contract.fields.items():
        if name not in df.columns:
            continue
        raw = col(name)
        absent = is_missing(raw, name in floating)
        value = raw.cast("string") if spec.kind == "string" else raw.try_cast(spec.kind)
        checks[name, "type"] = ~absent & value.isNull()
        if not spec.nullable:
            checks[name, "not_null"] = absent
        for rule in spec.rules:
            checks[name, rule.name] = F.coalesce(~absent & ~rule.holds(value), F.lit(False))
    return checks


def run_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per declared check with its number of failing rows. Nothing short-circuits.

    All row checks are counted in a single pass; each unique column adds a
    narrow aggregate on that column alone.
    """
    spark = df.sparkSession
    absent = set(missing_columns(df, contract.fields))
    fixed = [(contract.name, c, "present", int(c in absent), c not in absent) for c in contract.fields]
    if contract.strict:
        extra = [c for c in df.columns if c not in contract.fields]
        fixed += [(contract.name, c, "undeclared", 1, False) for c in extra]
    report = spark.createDataFrame(fixed, REPORT_SCHEMA)
    checks = _row_checks(df, contract)
    if checks:
        counted = df.agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(checks.values())])
        lines = F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.lit(k).alias("check"), F.col(f"n{i}").alias("failures"))
                for i, (c, k) in enumerate(checks)
            ]
        )
        report = report.unionByName(
            counted.select(F.explode(lines).alias("r")).select(
                F.lit(contract.name).alias("table"), "r.*", (F.col("r.failures") == 0).alias("passed")
            )
        )
    for name, spec in contract.fields.items():
        if spec.unique and name not in absent:
            repeats = duplicate_keys(df.filter(col(name).isNotNull()).select(col(name)), name)
            failures = F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0))
            report = report.unionByName(
                repeats.agg(failures.alias("failures")).select(
                    F.lit(contract.name).alias("table"),
                    F.lit(name).alias("column"),
                    F.lit("unique").alias("check"),
                    "failures",
                    (F.col("failures") == 0).alias("passed"),
                )
            )
    return report


def run_contracts(tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> DataFrame:
    """One report over several tables; a table without a contract raises."""
    report = None
    for name, df in tables.items():
        if name not in contracts:
            raise ValueError(f"no contract registered for table '{name}'")
        part = run_contract(df, contracts[name])
        report = part if report is None else report.unionByName(part)
    if report is None:
        raise ValueError("no tables given")
    return report


def broken_checks(df: DataFrame, contract: Contract) -> Column:
    """The ``column:check`` names a row breaks, as an array."""
    named = [F.when(c, F.lit(f"{name}:{check}")) for (name, check), c in _row_checks(df, contract).items()]
    return F.filter(F.array(*named), lambda x: x.isNotNull())


def failure_sample(df: DataFrame, contract: Contract, key: str, n: int = 10) -> DataFrame:
    """Failing values with their checks: the first ``n`` in key order."""
    cases = [
        F.when(
            broken,
            F.struct(F.lit(c).alias("column"), F.lit(k).alias("check"), col(c).cast("string").alias("value")),
        )
        for (c, k), broken in _row_checks(df, contract).items()
    ]
    failing = df.select(col(key), F.explode(F.filter(F.array(*cases), lambda x: x.isNotNull())).alias("f"))
    return failing.select(col(key), "f.*").orderBy(col(key), "column", "check").limit(n)


def enforce(report: DataFrame, label: str, examples: int = 10) -> None:
    """Raises with the first failing checks of a report."""
    broken = report.filter("not passed").orderBy("table", "column", "check").limit(examples).collect()
    if broken:
        lines = "; ".join(f"{r['column']} {r['check']} ({r['failures']})" for r in broken)
        raise ValueError(f"data contract failed for '{label}': {lines}")


def mark_broken(df: DataFrame, contract: Contract) -> DataFrame:
    """All rows with the broken checks in ``reasons``. A declared column the frame lacks raises."""
    absent = missing_columns(df, contract.fields)
    if absent:
        raise ValueError(f"{contract.name} lacks declared columns: {', '.join(absent[:10])}")
    return df.withColumn("reasons", broken_checks(df, contract))


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without ``reasons``, and rejected rows with them."""
    return marked.filter(F.size("reasons") == 0).drop("reasons"), marked.filter(F.size("reasons") > 0)


def quarantine(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with the broken checks in ``reasons``. Works on streams as well."""
    return split_marked(mark_broken(df, contract))


# --- checks of whole layers -------------------------------------------------------


def feature_store_contract(target: str, entity: str) -> Contract:
    return Contract(
        "feature_store",
        {
            entity: Field(nullable=False, rules=(NON_NEGATIVE,), unique=True),
            target: Field(nullable=False, rules=(one_of(0, 1),)),
            "missing_count": Field(nullable=False, rules=(NON_NEGATIVE,)),
        },
    )


def check_features_present(df: DataFrame, features: Sequence[str], label: str = "feature store") -> None:
    absent = sorted(set(missing_columns(df, features)))
    if absent:
        raise ValueError(f"{label} lacks {len(absent)} of the wanted features: {', '.join(absent[:10])}")


def split_contract(target: str, entity: str, name: str = "split") -> Contract:
    return Contract(
        name,
        {
            entity: Field(nullable=False, rules=(NON_NEGATIVE,), unique=True),
            target: Field(nullable=False, rules=(one_of(0, 1),)),
        },
    )


def matrix_check(df: DataFrame, columns: Sequence[str], label: str = "matrix") -> DataFrame:
    """Absent columns, cells that are NULL or NaN, and infinite cells, in one pass."""
    spark = df.sparkSession
    absent = sorted(set(missing_columns(df, columns)))
    present = [c for c in columns if c in df.columns]
    head = spark.createDataFrame(
        [(label, ", ".join(absent[:10]) or None, "columns_present", len(absent), not absent)], REPORT_SCHEMA
    )
    if not present:
        return head
    kinds = {f.name: f.dataType for f in df.schema}
    gaps = [F.count_if(is_missing(c, isinstance(kinds[c], FLOATING))) for c in present]
    bounds = [F.count_if(F.abs(col(c)) == float("inf")) for c in present if isinstance(kinds[c], FLOATING)]
    counts = df.agg(
        sum(gaps[1:], gaps[0]).alias("missing_cells"),
        (sum(bounds[1:], bounds[0]) if bounds else F.lit(0)).cast("long").alias("infinite_cells"),
    )
    return head.unionByName(
        counts.unpivot([], ["missing_cells", "infinite_cells"], "check", "failures").select(
            F.lit(label).alias("table"),
            F.lit(None).cast("string").alias("column"),
            "check",
            "failures",
            (F.col("failures") == 0).alias("passed"),
        )
    )


def request_check(df: DataFrame, columns: Sequence[str], entity: str | None) -> DataFrame:
    """``matrix_check`` plus repeated entity ids."""
    report = matrix_check(df, columns, "request")
    if not entity or entity not in df.columns:
        return report
    repeats = duplicate_keys(df, entity).agg(F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("failures"))
    return report.unionByName(
        repeats.select(
            F.lit("request").alias("table"),
            F.lit(entity).alias("column"),
            F.lit("unique").alias("check"),
            "failures",
            (F.col("failures") == 0).alias("passed"),
        )
    )
