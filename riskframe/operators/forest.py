"""Approximate nearest neighbours by a forest of random projections, for vectors whose distances rule nothing out.

Each tree halves the vectors again and again: those of a node are projected on a random direction and cut at the median. Two
vectors are compared if some tree leaves them in the same cell, by their exact distance, and the k best of all trees
stay. A vector meets at most ``trees * 2 * leaf_rows`` others, however many there are; every vector is in every tree.

Medians come from a sample of bounded size (``sample_rows``, the first in hash order). Where a node has too few sampled vectors the
median of its level is used, and a cell that is too large all the same is cut by hash. Directions and medians are broadcast: a table
of ``trees * sample_rows / 16`` numbers at most. Directions are drawn from the seed, so a recomputed task finds the same cells.

Recall is measured by ``recall`` against the exact search. On the 64-wide test embeddings, which have many independent directions,
figures are in the README; they fall as the table grows unless trees or leaves grow with it. With ``target`` leaves grow: the true
neighbours of ``PROBES`` vectors are found by comparing those with all, and trees are cut off at the deepest level that leaves
enough of them in a common cell. Cells above ``BLOCK_ROWS`` are then compared part with part, so nothing is lost by their size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.neighbours import BLOCK_ROWS, _merge, _nearest
from riskframe.operators.storage import stored

TREES = 32
LEAF_ROWS = 1024
SAMPLE_ROWS = 32_768
#: Sampled vectors from which on a node has a median of its own.
NODE_SAMPLE = 32
#: Vectors whose true neighbours decide how deep the trees are, if a recall is asked for.
PROBES = 512


@dataclass
class Forest:
    """Directions per tree and level; medians per node of the upper levels and per level below."""

    directions: np.ndarray  # trees, levels, width
    medians: list[list[np.ndarray]]  # per tree and level, by path
    flat: np.ndarray  # trees, levels

    @classmethod
    def fit(cls, sample: np.ndarray, trees: int, levels: int, seed: int) -> Forest:
        directions = np.random.default_rng(seed).normal(size=(trees, levels, sample.shape[1]))
        upper = min(levels, max(0, int(math.log2(max(1, len(sample) / NODE_SAMPLE)))))
        flat, medians = np.zeros((trees, levels)), []
        for t in range(trees):
            along = sample @ directions[t].T
            flat[t] = np.median(along, axis=0) if levels else 0
            path, own = np.zeros(len(sample), np.int64), []
            for level in range(upper):
                cuts = np.full(1 << level, flat[t, level])
                order = np.argsort(path, kind="stable")
                bounds = np.searchsorted(path[order], np.arange((1 << level) + 1))
                for node, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    if b - a >= NODE_SAMPLE:
                        cuts[node] = np.median(along[order[a:b], level])
                own.append(cuts)
                path = 2 * path + (along[:, level] > cuts[path])
            medians.append(own)
        return cls(directions, medians, flat)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """For each vector its cell in each tree."""
        trees, levels = self.flat.shape
        out = np.zeros((len(x), trees), np.int64)
        for t in range(trees):
            along = x @ self.directions[t].T
            path = np.zeros(len(x), np.int64)
            for level in range(levels):
                own = self.medians[t]
                cut = own[level][path] if level < len(own) else self.flat[t, level]
                path = 2 * path + (along[:, level] > cut)
            out[:, t] = path
        return out


def _true_pairs(points: DataFrame, probes: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The probes' vectors, each repeated for its k nearest among all points, and those neighbours' vectors."""
    own = np.array([r["id"] for r in probes], np.int64)
    asked = points.sparkSession.sparkContext.broadcast(np.array([r["vec"] for r in probes], float))

    def scan(batches):
        best, who = np.full((len(own), k), np.inf), np.full((len(own), k), np.iinfo(np.int64).max)
        for batch in batches:
            found = _nearest(asked.value, own, np.stack(batch["vec"].to_list()), batch["id"].to_numpy(), k)
            best, who = _merge(best, who, *found, k)
        row, place = np.nonzero(np.isfinite(best))
        yield pd.DataFrame({"probe": row, "id": who[row, place], "distance": best[row, place]})

    order = Window.partitionBy("probe").orderBy("distance", "id")  # at most k rows a task
    near = points.select("id", "vec").mapInPandas(scan, "probe long, id long, distance double")
    near = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).join(points.select("id", "vec"), "id")
    rows = near.select("probe", "vec").collect()  # bounded: PROBES * k
    width = asked.value.shape[1]
    return asked.value[[r["probe"] for r in rows]].reshape(-1, width), np.array([r["vec"] for r in rows], float).reshape(-1, width)


def _depth(forest: Forest, pairs: tuple[np.ndarray, np.ndarray], target: float) -> int:
    """The deepest level at which some tree still has that share of the pairs in one cell."""
    levels = forest.flat.shape[1]
    a, b = (forest.cells(x) for x in pairs)
    kept = [((a >> (levels - depth)) == (b >> (levels - depth))).any(axis=1).mean() for depth in range(levels + 1)]
    return max(depth for depth, share in enumerate(kept) if share >= target)


def forest_neighbours(
    points: DataFrame,
    k: int,
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 42,
    target: float | None = None,
) -> DataFrame:
    """``points`` (id long, vec array<double>, all vectors distinct) -> (id, rank, neighbour, distance), approximately.

    With at most ``leaf_rows`` vectors there is one cell, and the result is exact. Equal distances go by id. ``target`` is the recall
    that the probes must reach; leaves then grow as far as that takes.
    """
    if trees < 1 or leaf_rows <= k:
        raise ValueError("at least one tree, and more rows in a leaf than neighbours")
    if target is not None and not 0 < target <= 1:
        raise ValueError("a recall lies above 0 and is at most 1")
    spark = points.sparkSession
    n = points.count()
    levels = max(0, math.ceil(math.log2(max(1, n / leaf_rows))))
    # bounded: sample_rows vectors
    rows = points.select("id", "vec").orderBy(F.md5(F.col("id").cast("string"))).limit(sample_rows).collect()
    sample = np.array([r["vec"] for r in rows], float).reshape(len(rows), -1)
    fitted = Forest.fit(sample, trees if levels else 1, levels, seed)
    above = 0  # lowest levels that are not used
    if target is not None and levels:
        above = levels - _depth(fitted, _true_pairs(points, rows[:PROBES], k), target)
    forest = spark.sparkContext.broadcast(fitted)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def cells(vec: pd.Series) -> pd.Series:
        return pd.Series(list(forest.value.cells(np.stack(vec.to_list())) >> above))

    placed = stored(points.select("id", "vec", cells("vec").alias("cells")), "forest")
    counts = placed.select(F.posexplode("cells").alias("tree", "cell")).groupBy("tree", "cell").count()
    parts = F.ceil(F.col("count") / F.lit(2 * leaf_rows if target is None else BLOCK_ROWS)).cast("int")
    large = counts.select("tree", "cell", parts.alias("parts")).filter("parts > 1")
    spread = placed.select("id", "vec", F.posexplode("cells").alias("tree", "cell")).join(large, ["tree", "cell"], "left")
    part = F.pmod(F.xxhash64("id", "tree"), F.coalesce("parts", F.lit(1))).cast("int")
    spread = spread.withColumn("part", part)
    if target is None:  # a row asks and is asked in its own part
        meetings = spread.withColumns({"other": F.col("part"), "asks": F.lit(True), "answers": F.lit(True)})
    else:  # it asks all parts of its cell, and answers to all
        others = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
        pairs = spread.withColumn("with", others)
        same = F.col("part") == F.col("with")
        asking = pairs.withColumns({"other": F.col("with"), "asks": F.lit(True), "answers": same})
        answering = pairs.filter(~same).withColumns({"other": F.col("part"), "part": F.col("with"), "asks": F.lit(False), "answers": F.lit(True)})
        meetings = asking.unionByName(answering)

    def inside(group: pd.DataFrame) -> pd.DataFrame:
        x, ids = np.stack(group["vec"].to_list()), group["id"].to_numpy()
        asks, answers = group["asks"].to_numpy(bool), group["answers"].to_numpy(bool)
        if not (asks.any() and answers.any()):
            return pd.DataFrame({"id": [], "neighbour": [], "distance": []})
        best, who = _nearest(x[asks], ids[asks], x[answers], ids[answers], k)
        row, place = np.nonzero(np.isfinite(best))
        return pd.DataFrame({"id": ids[asks][row], "neighbour": who[row, place], "distance": best[row, place]})

    grouped = meetings.select("id", "vec", "tree", "cell", "part", "other", "asks", "answers").groupBy("tree", "cell", "part", "other")
    found = grouped.applyInPandas(inside, "id bigint, neighbour bigint, distance double")
    once = found.groupBy("id", "neighbour").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("id").orderBy("distance", "neighbour")  # at most trees * parts * k rows each
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("id", "rank", "neighbour", "distance")


def recall(found: DataFrame, exact: DataFrame, every: int = 20) -> DataFrame:
    """One row: how many of the exact neighbours of each ``every``-th id were found; n_queries, n_neighbours, n_found, recall.

    Neighbours at the same distance as the last exact one count as found, whichever of them was listed.
    """
    asked = F.pmod(F.col("id"), F.lit(every)) == 0
    edge = exact.filter(asked).groupBy("id").agg(F.count(F.lit(1)).alias("wanted"), F.max("distance").alias("edge"))
    got = found.filter(asked).select("id", "distance").join(edge.select("id", "edge"), "id")
    hits = got.filter(F.col("distance") <= F.col("edge") * (1 + 1e-12)).groupBy("id").agg(F.count(F.lit(1)).alias("hits"))
    both = edge.join(hits, "id", "left")
    return both.agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.coalesce(F.sum("wanted"), F.lit(0)).alias("n_neighbours"),
        F.coalesce(F.sum("hits"), F.lit(0)).alias("n_found"),
    ).withColumn("recall", F.try_divide("n_found", "n_neighbours"))
