"""CSV and Parquet tables in and out."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expr import col
from riskframe.operators.frame import floating_columns
from riskframe.operators.sampling import Key, sample_exact

LOGGER = logging.getLogger(__name__)

# Cell texts that mean "missing" besides an empty cell.
NA_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _load(spark: SparkSession, fmt: str, path: str, options: Mapping[str, str]) -> DataFrame:
    try:
        return spark.read.options(**options).format(fmt).load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc.getCondition()):
            raise FileNotFoundError(f"no table at {path}") from exc
        raise


def read_csv_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    na_tokens: Sequence[str] = NA_TOKENS,
    lenient: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """A headed CSV (plain, gzip or bzip2) with typed columns; columns are matched by name.

    Empty cells and the NA tokens become NULL in every column. Any other text
    that does not fit the declared type raises when read, or becomes NULL with
    ``lenient``. Columns outside the schema stay text. ``multi_line`` allows
    line breaks in quoted cells; such a file is then read by one task.
    """
    raw = _load(spark, "csv", path, {"header": "true", "escape": '"', "multiLine": str(multi_line).lower()})
    declared = {f.name: f.dataType for f in schema}
    absent = [c for c in declared if c not in raw.columns]
    if absent:
        raise ValueError(f"{path} lacks columns: {', '.join(absent)}")
    out = []
    for name in raw.columns:
        text = F.when(~col(name).isin(*na_tokens) & (col(name) != ""), col(name))
        if name in declared:
            kind = declared[name]
            text = text.try_cast(kind) if lenient else text.cast(kind)
        out.append(text.alias(name))
    return raw.select(*out)


@dataclass(frozen=True)
class TableSpec:
    """Where a table lies. Without a path an optional table is None and a required one an error."""

    path: str | None
    schema: T.StructType | None = None
    required: bool = True
    sample_rows: int | None = None
    sample_key: Key | None = None


def read_tables(spark: SparkSession, specs: Mapping[str, TableSpec]) -> dict[str, DataFrame | None]:
    """Lazy plans for all tables: CSV where a schema is given, Parquet otherwise."""
    out: dict[str, DataFrame | None] = {}
    for label, spec in specs.items():
        if not spec.path:
            if spec.required:
                raise ValueError(f"{label} is required")
            out[label] = None
            continue
        df = read_csv_table(spark, spec.path, spec.schema) if spec.schema else read_parquet_table(spark, spec.path)
        if spec.sample_rows:
            df = sample_exact(df, spec.sample_rows, 42, spec.sample_key or df.columns)
        out[label] = df
    return out


def nan_to_null(df: DataFrame) -> DataFrame:
    """From here on NaN does not stand for "missing"."""
    floating = floating_columns(df)
    return df.select(*[F.when(~F.isnan(col(c)), col(c)).alias(c) if c in floating else col(c) for c in df.columns])


def read_parquet_table(spark: SparkSession, path: str, keep_nan: bool = False) -> DataFrame:
    """A Parquet table, its NaN turned into NULL unless they are asked for."""
    df = _load(spark, "parquet", path, {})
    return df if keep_nan else nan_to_null(df)


def _write_counted(df: DataFrame, label: str, write) -> int:
    """Runs a write and returns its row count, taken during the write itself."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    LOGGER.info("wrote %s rows x %s columns to %s", seen.get["rows"], len(df.columns), label)
    return seen.get["rows"]


def write_parquet_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> int:
    return _write_counted(df, path, lambda d: d.write.mode(mode).partitionBy(*partition_by).parquet(path))


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    """Scored rows as Parquet or headed CSV."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"predictions are written as parquet or csv, not {fmt!r}")
    options = {"header": "true"} if fmt == "csv" else {}
    return _write_counted(df, path, lambda d: d.write.mode(mode).options(**options).format(fmt).save(path))


def append_report(df: DataFrame, path: str, run_date: str, fmt: str = "parquet", run_id: str | None = None) -> str:
    """Adds a report to a history table, in a folder of its run date and run id; returns the id.

    Writing a run's report again, after a failure or by a retry, replaces it. Without an id the report's content
    is its id, whatever the order of its rows: the same report is kept once, another one of the same date beside it.
    """
    if run_id is None:
        total = F.sum(F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).cast("decimal(38,0)"))
        found = df.agg(F.count(F.lit(1)), total).first()
        run_id = "content-{}-{}".format(found[0], found[1] or 0)
    marked = df.withColumns({"run_date": F.lit(run_date), "run_id": F.lit(run_id)})
    writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_date", "run_id").format(fmt).save(path)
    return run_id
