"""Synthetic minority rows on the segments to near minority neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.expr import col
from riskframe.functions.hashing import hash_order, unit_draw
from riskframe.operators.forest import forest_neighbours
from riskframe.operators.local_state import MAX_CLASSES, read_classes
from riskframe.operators.neighbours import distinct_vectors, nearest_neighbours
from riskframe.operators.sampling import class_counts, exact_cutoff
from riskframe.operators.storage import stored

ROWS_PER_CHUNK = 1000
HUB_SHARE = 0.01


def rows_to_add(n_minority: int, n_majority: int, ratio: float) -> int:
    """How many rows lift minority/majority to ``ratio``."""
    extra = int(n_majority * ratio - n_minority)
    if extra < 0:
        raise ValueError("the minority already exceeds the asked ratio")
    return extra


def neighbour_lists(distinct: DataFrame, k: int, trees: int | None = None, **search) -> DataFrame:
    """Per distinct vector its k nearest rows as ids, a vector's own copies first.

    A neighbour that occurs several times fills several places, as it would if
    all copies had been compared. With ``trees`` the search is that of a forest, approximate and of bounded work per vector.
    """
    points = distinct.select("id", "vec")
    found = forest_neighbours(points, k, trees, **search) if trees else nearest_neighbours(points, k, **search)
    near = (
        found.join(distinct.select(F.col("id").alias("neighbour"), F.col("copies").alias("times")), "neighbour")
        .groupBy("id")
        # at most k entries per group
        .agg(F.array_sort(F.collect_list(F.struct("rank", "neighbour", "times"))).alias("near"))
    )
    repeated = F.flatten(
        F.transform("near", lambda x: F.array_repeat(x["neighbour"], F.least(x["times"], F.lit(k)).cast("int")))
    )
    own = F.array_repeat(F.col("id"), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    return distinct.join(near, "id", "left").withColumn(
        "places", F.slice(F.concat(own, F.coalesce(repeated, F.array().cast("array<bigint>"))), 1, k)
    )


def _hubs(drawn: DataFrame, n_new: int, share: float = HUB_SHARE) -> list[int]:
    """Neighbours at which at least this share of all rows ends: at most 1 / share of them."""
    counts = drawn.groupBy("neighbour").count().filter((F.col("count") >= share * n_new) & (F.col("count") > ROWS_PER_CHUNK))
    return [r["neighbour"] for r in counts.collect() if r["neighbour"] is not None]


def synthetic_rows(points: DataFrame, n_new: int, k: int, seed: int, **search) -> DataFrame:
    """``points`` (id long, vec array<double>) -> (seed_id, ordinal, neighbour, gap, vec).

    Every point seeds the same number of rows; the remainder goes to the points
    first in hash order. Neighbour and gap are drawn from the seed's id, so the
    result does not depend on partitioning. ``search`` are options of ``nearest_neighbours``,
    or with ``trees`` of ``forest_neighbours``.
    """
    n = points.count()
    if n <= k:
        raise ValueError(f"{n} minority rows are too few for {k} neighbours")
    base, rest = divmod(n_new, n)
    cut = exact_cutoff(points, rest, seed, "id")
    more = F.sum((hash_order(seed, "id") <= F.lit(cut)).cast("long"))
    distinct = stored(distinct_vectors(points, {"extras": more}), "distinct")
    lists = neighbour_lists(distinct, k, **search).withColumn("n_rows", F.col("copies") * base + F.col("extras"))
    lists = stored(lists, "neighbours")
    chunked = (
        lists.filter("n_rows > 0")
        .withColumn("chunk", F.explode(F.expr(f"sequence(0L, (n_rows - 1) div {ROWS_PER_CHUNK})")))
        .repartition("id", "chunk")
    )
    first = F.col("chunk") * ROWS_PER_CHUNK
    last = F.least(first + ROWS_PER_CHUNK, F.col("n_rows")) - 1
    name = F.concat_ws(":", F.lit(str(seed)), F.col("seed_id").cast("string"), F.col("ordinal").cast("string"))
    drawn = chunked.select(
        F.col("id").alias("seed_id"), F.col("vec").alias("x"), "places", F.explode(F.sequence(first, last)).alias("ordinal")
    ).withColumns(
        {
            "gap": unit_draw(F.concat(name, F.lit(":gap"))),
            "place": F.floor(unit_draw(F.concat(name, F.lit(":place"))) * F.size("places")).cast("int"),
        }
    )
    drawn = drawn.withColumn("neighbour", F.get("places", F.col("place")))
    ends = distinct.select(F.col("id").alias("neighbour"), F.col("vec").alias("y"))
    hubs = _hubs(drawn, n_new)
    is_hub = F.coalesce(F.col("neighbour").isin(hubs), F.lit(False))
    picked = drawn.filter(~is_hub).join(ends, "neighbour")
    if hubs:  # a few vectors, broadcast to the many rows that end at them
        picked = picked.unionByName(drawn.filter(is_hub).join(F.broadcast(ends.filter(F.col("neighbour").isin(hubs))), "neighbour"))
    between = F.zip_with("x", "y", lambda x, y: x + F.col("gap") * (y - x))
    return picked.select("seed_id", "ordinal", "neighbour", "gap", between.alias("vec"))


def smote(
    df: DataFrame, features: Sequence[str], target: str, key: str, ratio: float, k: int = 5, seed: int = 42,
    max_classes: int = MAX_CLASSES, **search,
) -> DataFrame:
    """The frame with synthetic minority rows added; ``row_key`` names every row.

    Only minority rows enter the neighbour search. The key must be a whole number.
    ``search`` are options of ``nearest_neighbours``.
    """
    sizes = sorted((r[1], str(r[0]), r[0]) for r in read_classes(class_counts(df, target), target, max_classes))
    if len(sizes) < 2:
        raise ValueError("two classes are needed")
    (n_min, _, minority), (n_max, _, _) = sizes[0], sizes[-1]
    n_new = rows_to_add(n_min, n_max, ratio)
    kept = df.select(
        *[col(c).cast("double").alias(c) for c in features], col(target), col(key).cast("string").alias("row_key")
    )
    if n_new == 0:
        return kept
    vec = F.array(*[col(c).cast("double") for c in features])
    points = df.filter(col(target) == F.lit(minority)).select(col(key).cast("long").alias("id"), vec.alias("vec"))
    made = synthetic_rows(points, n_new, k, seed, **search).select(
        *[F.get("vec", F.lit(i)).alias(c) for i, c in enumerate(features)],
        F.lit(minority).cast(df.schema[target].dataType).alias(target),
        F.concat_ws(":", F.lit("synthetic"), F.col("seed_id"), F.col("ordinal")).alias("row_key"),
    )
    return kept.unionByName(made)
