"""One-hot encoding without a bound on the number of levels: a place in a sparse vector instead of a column.

Levels are counted and numbered in Spark and stay there as a table (column, value, n, place). Only facts per column and per
partition reach the driver. Rows find their levels by joins: columns with few levels (counted first) by broadcasting those,
the others by a shuffle, in which the most frequent levels take no part. Those are at most ``1 / HOT_SHARE`` in a column, so
they are broadcast too, and the rows that carry them are spread evenly instead of meeting in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expr import col
from riskframe.operators.frame import string_columns
from riskframe.operators.storage import store, stored

#: Columns with at most this many levels are encoded by a broadcast.
FEW_LEVELS = 10_000
#: Levels with at least this share of all rows do not take part in the shuffle.
HOT_SHARE = 0.01
_SPREAD = 1 << 20
#: Rows per partition that ``monotonically_increasing_id`` tells apart.
_ROW_BITS = 33
_LEVELS = "column string, value string, n long, place long"


@dataclass
class Levels:
    """A numbered vocabulary: its table, the number of levels per column, and how many rows it was fitted on."""

    table: DataFrame
    sizes: dict[str, int]
    n_rows: int

    @property
    def width(self) -> int:
        return sum(self.sizes.values())

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(f"{path}/levels")
        spark = self.table.sparkSession
        facts = [(i, c, n, self.n_rows) for i, (c, n) in enumerate(self.sizes.items())]
        facts = spark.createDataFrame(facts, "at int, column string, levels long, n_rows long")
        facts.coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Levels:
        facts = spark.read.parquet(f"{path}/columns").orderBy("at").collect()  # one row per column
        sizes = {r["column"]: r["levels"] for r in facts}
        return cls(spark.read.schema(_LEVELS).parquet(f"{path}/levels"), sizes, facts[0]["n_rows"] if facts else 0)


def fit_levels(df: DataFrame, columns: Sequence[str] | None = None) -> Levels:
    """Numbers the distinct values of each column from 0 on: column after column, in ascending order of the values.

    NULL is no level. The order is that of a distributed sort: what comes before a partition is a total over
    a table of partitions, so no task sees all levels.
    """
    columns = list(columns if columns is not None else string_columns(df))
    if len(set(columns)) < len(columns):
        raise ValueError("a column is listed twice")
    spark = df.sparkSession
    place_of = {c: i for i, c in enumerate(columns)}
    if not columns:
        return Levels(spark.createDataFrame([], _LEVELS), {}, df.count())
    pairs = F.array(*[F.struct(F.lit(i).alias("at"), col(c).cast("string").alias("value")) for c, i in place_of.items()])
    counted = df.select(F.explode(pairs).alias("p")).groupBy("p.at", "p.value").agg(F.count(F.lit(1)).alias("n"))
    counted = stored(counted, "level-counts")
    per_column = {r["at"]: r for r in counted.groupBy("at").agg(F.count("value").alias("levels"), F.sum("n").alias("n")).collect()}
    sizes = {c: per_column[i]["levels"] if i in per_column else 0 for c, i in place_of.items()}
    n_rows = per_column[0]["n"] if per_column else 0
    if sum(sizes.values()) > 2**31 - 1:
        raise ValueError("a vector has at most 2^31 - 1 places")

    known = counted.filter("value is not null")
    ordered = stored(known.orderBy("at", "value").withColumn("row", F.monotonically_increasing_id()), "levels")
    part, inside = F.shiftright("row", _ROW_BITS), F.col("row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    totals = sorted(tuple(r) for r in ordered.groupBy(part.alias("part")).count().collect())  # one row per partition
    before, upto = [], 0
    for number, n in totals:
        before.append((number, upto))
        upto += n
    offsets = F.broadcast(spark.createDataFrame(before, "part long, before long"))
    names = F.array(*[F.lit(c) for c in columns])
    numbered = ordered.withColumn("part", part).join(offsets, "part")
    table = numbered.select(F.get(names, F.col("at")).alias("column"), "value", "n", (F.col("before") + inside).alias("place"))
    return Levels(stored(table, "numbered-levels"), sizes, n_rows)


def _with_place(df: DataFrame, levels: Levels, column: str, output: str, extra: Column | None, few: int) -> DataFrame:
    """Adds the place of the row's level (NULL if it has none) by a broadcast or by a shuffle without the hot levels."""
    found = F.struct("place", *([extra.alias("weight")] if extra is not None else []))
    own = levels.table.filter(F.col("column") == column).select(F.col("value").alias("__value"), "n", found.alias(output))
    value = col(column).cast("string")
    if levels.sizes[column] <= few:
        return df.join(F.broadcast(own.drop("n")), value == F.col("__value"), "left").drop("__value")
    least = max(1.0, HOT_SHARE * levels.n_rows)
    hot = own.filter(F.col("n") >= least).select(F.col("__value").alias("__hot"), F.col(output).alias("__hot_found"))
    marked = df.join(F.broadcast(hot), value == F.col("__hot"), "left").drop("__hot")
    idle = F.col("__hot_found").isNotNull() | value.isNull()  # rows that need nothing from the shuffle
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(_SPREAD)) + 1
    marked = marked.withColumn("__spread", F.when(idle, spread).otherwise(F.lit(0).cast("long")))
    marked = marked.withColumn("__key", F.when(idle, F.lit("")).otherwise(value))
    rare = own.filter(F.col("n") < least).select(F.col("__value").alias("__key"), F.lit(0).cast("long").alias("__spread"), output)
    joined = marked.join(rare.hint("merge"), ["__key", "__spread"], "left")  # rows of a level come one after the other
    joined = joined.withColumn(output, F.coalesce("__hot_found", F.col(output)))
    return joined.drop("__key", "__spread", "__hot_found")


def encode_levels(
    df: DataFrame, levels: Levels, output: str = "levels", weight: Column | None = None, few_levels: int = FEW_LEVELS
) -> DataFrame:
    """Adds an array of structs with the ``place`` of each level of the row, ascending, and its ``weight`` if one is given.

    ``weight`` is an expression over the vocabulary's columns. NULL and values unknown to the vocabulary have no entry.
    """
    columns, kept = list(levels.sizes), df.columns
    helpers = {"__value", "__hot", "__hot_found", "__key", "__spread", *[f"__place_{i}" for i in range(len(columns))]}
    clash = sorted(set(kept) & {*helpers, output})
    if clash:
        raise ValueError(f"names already exist: {', '.join(clash)}")
    for i, c in enumerate(columns):
        df = _with_place(df, levels, c, f"__place_{i}", weight, few_levels)
    kind = "struct<place:bigint,weight:double>" if weight is not None else "struct<place:bigint>"
    places = F.array(*[F.col(f"__place_{i}") for i in range(len(columns))]).cast(f"array<{kind}>")
    return df.select(*[col(c) for c in kept], F.array_compact(places).alias(output))


def deviation(levels: Levels) -> Column:
    """Population deviation of a level's 0/1 column, 1 where it is constant; an expression over the vocabulary."""
    share = F.col("n") / F.lit(float(max(levels.n_rows, 1)))
    spread = F.sqrt(share * (1 - share))
    return F.when(spread > 0, spread).otherwise(1.0)


def sparse_structs(
    df: DataFrame, levels: Levels, output: str, scaled: bool, leading: Sequence[str] = (), few_levels: int = FEW_LEVELS
) -> DataFrame:
    """Adds the vector in the form that Spark ML's vectors have in a table."""
    weight = 1.0 / deviation(levels) if scaled else None
    listed = encode_levels(df, levels, output, weight, few_levels)
    value = (lambda x: x["weight"]) if scaled else (lambda x: F.lit(1.0))
    first = len(leading)
    if first + levels.width > 2**31 - 1:
        raise ValueError("a vector has at most 2^31 - 1 places")

    def number(c: str) -> Column:
        cell = col(c).cast("double")
        error = F.raise_error(F.lit(f"column {c} holds NULL or NaN")).cast("double")
        return F.when(cell.isNull() | F.isnan(cell), error).otherwise(cell)

    indices, values = F.transform(output, lambda x: x["place"].cast("int") + F.lit(first)), F.transform(output, value)
    if leading:
        indices = F.concat(F.array(*[F.lit(i) for i in range(first)]), indices)
        values = F.concat(F.array(*[number(c) for c in leading]), values)
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(first + levels.width).alias("size"), indices.alias("indices"), values.alias("values")
    )
    return listed.withColumn(output, vector)


def _with_vectors(schema: T.StructType, output: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, VectorUDT() if f.name == output else f.dataType) for f in schema])


def sparse_vectors(
    df: DataFrame,
    levels: Levels,
    output: str = "features",
    scaled: bool = False,
    few_levels: int = FEW_LEVELS,
    leading: Sequence[str] = (),
) -> DataFrame:
    """Adds a sparse vector with a 1 at the place of each level of the row; ``scaled`` divides by the level's deviation.

    Nothing is centred, so that vectors stay sparse; a model with an intercept is the same either way. The numbers of the
    ``leading`` columns come before the levels; NULL and NaN among them are errors. A ``VectorAssembler`` would name every
    place in the schema, which each plan and task then carries.
    """
    shaped = sparse_structs(df, levels, output, scaled, leading, few_levels)
    # the batches pass through unchanged, under plain names; this only gives the struct the type that Spark ML asks for
    plain = [f"c{i}" for i in range(len(shaped.columns))]
    kinds = _with_vectors(shaped.schema, output)
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(plain, kinds)])
    return shaped.toDF(*plain).mapInArrow(lambda batches: batches, schema).toDF(*shaped.columns)


def stored_vectors(
    df: DataFrame, levels: Levels, output: str, scaled: bool, leading: Sequence[str] = (), few_levels: int = FEW_LEVELS
) -> DataFrame:
    """The rows of ``sparse_vectors``, written once."""
    shaped = sparse_structs(df, levels, output, scaled, leading, few_levels)
    return df.sparkSession.read.schema(_with_vectors(shaped.schema, output)).parquet(store(shaped, "vectors"))
