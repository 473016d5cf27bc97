"""Table profiles, lineage and fingerprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expr import col, is_missing
from riskframe.functions.hashing import FINGERPRINT_MODULUS, hash_number
from riskframe.operators.frame import FLOATING, floating_columns


def profile_table(df: DataFrame, name: str = "table") -> DataFrame:
    """One row per column: rows, columns, position and missing fraction, from a single aggregate."""
    floating = floating_columns(df)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(is_missing(c, c in floating)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column"),
                F.coalesce(F.try_divide(F.col(f"m{i}").cast("double"), F.col("n_rows").cast("double")), F.lit(0.0)).alias(
                    "missing_fraction"
                ),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select(
        F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.explode(lines).alias("x")
    ).select("table", "n_rows", "n_columns", "x.*")


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: distinct values, and the same with "missing" as one more value. Exact, in one shuffle.

    Values are told apart by their text, counted once per task before they are shuffled.
    """
    floating = floating_columns(df)
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("no"), F.when(~is_missing(c, c in floating), col(c).cast("string")).alias("value"))
            for i, c in enumerate(columns)
        ]
    )
    kinds = df.select(F.explode(cells).alias("x")).select("x.*").distinct()
    name = F.get(F.array(*[F.lit(c) for c in columns]), F.col("no"))
    return kinds.groupBy("no").agg(
        F.count("value").alias("n_distinct"), F.count(F.lit(1)).alias("n_distinct_with_missing")
    ).select(name.alias("column"), "n_distinct", "n_distinct_with_missing")


def top_missing(df: DataFrame, n: int = 10, name: str = "table") -> DataFrame:
    """The ``n`` columns with the largest missing fraction above zero."""
    return (
        profile_table(df, name)
        .filter("missing_fraction > 0")
        .orderBy(F.desc("missing_fraction"), "column")
        .limit(n)
        .select("table", "column", F.round("missing_fraction", 4).alias("missing_fraction"))
    )


def file_facts(df: DataFrame, name: str) -> DataFrame:
    """Files, folders, first folder, bytes and last change of the files a DataFrame reads; NULLs where it reads none directly."""
    try:
        files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    except AnalysisException:  # a joined or computed table has no files of its own
        empty = "file_path string, file_size bigint, file_modification_time timestamp"
        files = df.sparkSession.createDataFrame([], empty)
    folder = F.regexp_extract("file_path", "^(.*)/[^/]+$", 1)
    return files.agg(
        F.nullif(F.count("file_path"), F.lit(0).cast("long")).alias("n_files"),
        F.nullif(F.count_distinct(folder), F.lit(0).cast("long")).alias("n_folders"),
        F.min(folder).alias("source_path"),
        F.sum("file_size").alias("file_size_bytes"),
        F.max("file_modification_time").alias("file_modified_at"),
    ).withColumn("table", F.lit(name))


def lineage(raw: Mapping[str, DataFrame], features: DataFrame, feature_name: str = "feature_store") -> DataFrame:
    """One row per table: shape, column names, largest missing fractions, its files, and which tables fed it."""
    rows = None
    for name, df in [*raw.items(), (feature_name, features)]:
        profile = profile_table(df, name)
        worst = F.slice(
            F.array_sort(
                F.collect_list(
                    F.when(
                        F.col("missing_fraction") > 0,
                        F.struct((-F.round("missing_fraction", 4)).alias("neg"), F.col("column").alias("column")),
                    )
                )
            ),
            1,
            10,
        )
        shaped = profile.groupBy("table", "n_rows", "n_columns").agg(
            F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("position", "column"))), lambda s: s["column"])).alias(
                "column_names"
            ),
            F.concat_ws(",", F.transform(worst, lambda s: s["column"])).alias("most_missing"),
            F.concat_ws(",", F.transform(worst, lambda s: (-s["neg"]).cast("decimal(10,4)").cast("string"))).alias(
                "missing_fractions"
            ),
        )
        sources = ",".join(raw) if name == feature_name else None
        shaped = shaped.withColumn("source_tables", F.lit(sources).cast("string"))
        shaped = shaped.join(F.broadcast(file_facts(df, name)), "table", "left")  # one row
        rows = shaped if rows is None else rows.unionByName(shaped)
    return rows


def table_fingerprint(df: DataFrame, columns: Sequence[str], decimals: int = 6) -> DataFrame:
    """Row count and a digest that ignores row order. Doubles enter as rounded decimals.

    The digest is a sum, so it is combined on the map side and one number per
    task is shuffled, whatever the table size.
    """
    parts = []
    for field in (df.schema[c] for c in columns):
        c = col(field.name)
        if isinstance(field.dataType, FLOATING):
            c = F.round(c, decimals).cast(T.DecimalType(28, decimals))
        parts.append(F.coalesce(c.cast("string"), F.lit("<null>")))
    digest = F.sum(hash_number(F.concat_ws("|", *parts)).cast("decimal(28,0)"))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.pmod(digest, F.lit(FINGERPRINT_MODULUS)).cast("long"), F.lit(0)).alias("digest"),
    )
