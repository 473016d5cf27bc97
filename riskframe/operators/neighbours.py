"""Exact nearest neighbours as Spark jobs.

Equal vectors are first reduced to one row with a count, so copies cost
nothing. The distinct vectors are put into cells around a bounded number of
pivot vectors and each cell is cut by hash into blocks of bounded size. A first
pass looks inside a vector's own block and thereby knows an upper bound on the
distance of its k-th neighbour. By the triangle inequality only blocks whose
ball reaches into that distance can hold a nearer one; the vector visits
exactly those. Visitors of a busy block are cut into chunks, each meeting its
own copy of the block, so no task sees more than one block and one chunk; inside
a task a running list of the k best passes over tiles, so a vector is sent once per
block and k candidates come back. The pruning never loses a neighbour; it only
saves work, and on many independent features it saves little: there the search
compares all blocks, unless the caller asks for the approximate form.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.storage import store, stored

#: Rows that meet in one task: a block of residents and a chunk of its visitors have at most about this many each.
BLOCK_ROWS = 16_384
#: Most pivots (their table is broadcast). Fewer make larger cells, which are cut into blocks all the same.
MAX_PIVOTS = 4096
SLACK = 1e-9
#: Distances that are held at once, and spare candidates of the preselection.
TILE_CELLS = 4_000_000
SPARE = 16


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))


def _batches(a: np.ndarray, b: np.ndarray):
    step = max(1, TILE_CELLS // max(1, b.size))
    for start in range(0, len(a), step):
        yield start, _distances(a[start : start + step], b)


def _nearest(q: np.ndarray, own: np.ndarray, r: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the k nearest residents other than itself: distances (infinite where there are fewer) and ids.

    Residents come in tiles. |a|^2 + |b|^2 - 2ab preselects a few per tile, exact distances rank those against the best so
    far, equal distances by id. Rows in which rounding could hide a near one are compared with the whole tile.
    """
    best = np.full((len(q), k), np.inf)
    who = np.full((len(q), k), np.iinfo(np.int64).max)
    square_q, square_r = (q * q).sum(axis=1), (r * r).sum(axis=1)
    wide = max(1, min(len(r), 8192))
    step = max(1, TILE_CELLS // wide)
    for left in range(0, len(r), wide):
        tile, names = r[left : left + wide], ids[left : left + wide]
        for top in range(0, len(q), step):
            rows = slice(top, top + step)
            rough = square_q[rows, None] + square_r[None, left : left + wide] - 2 * q[rows] @ tile.T
            rough[own[rows, None] == names[None, :]] = np.inf
            take = min(len(tile), k + SPARE)
            chosen = np.argpartition(rough, take - 1, axis=1)[:, :take] if take < len(tile) else np.tile(np.arange(take), (len(rough), 1))
            exact = np.sqrt(((q[rows, None, :] - tile[chosen]) ** 2).sum(axis=2))
            exact[own[rows, None] == names[chosen]] = np.inf
            best[rows], who[rows] = _merge(best[rows], who[rows], exact, names[chosen], k)
            if take < len(tile):
                error = SLACK * (square_q[rows] + square_r[left : left + wide].max())
                edge = np.take_along_axis(rough, chosen, 1).max(axis=1)
                unsure = np.flatnonzero(edge <= best[rows][:, -1] ** 2 + error)
                for i in unsure:  # many at nearly the same distance
                    line = _distances(q[top + i][None, :], tile)
                    line[0, names == own[top + i]] = np.inf
                    old = _without(best[top + i], who[top + i], names)
                    best[top + i], who[top + i] = (x[0] for x in _merge(*old, line, names[None, :], k))
    return best, who


def _without(best: np.ndarray, who: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best so far, without those of a tile that is compared again."""
    return np.where(np.isin(who, names), np.inf, best)[None, :], who[None, :]


def _merge(best: np.ndarray, who: np.ndarray, more: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest of both sides per row, equal distances by id."""
    distance = np.concatenate([best, more], axis=1)
    ids = np.concatenate([who, np.broadcast_to(names, more.shape)], axis=1)
    by_id = np.argsort(ids, axis=1, kind="stable")
    distance, ids = np.take_along_axis(distance, by_id, 1), np.take_along_axis(ids, by_id, 1)
    order = np.argsort(distance, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(distance, order, 1), np.take_along_axis(ids, order, 1)


def _lists(best: np.ndarray, who: np.ndarray) -> list[list[dict]]:
    return [
        [{"distance": float(d), "neighbour": int(j)} for d, j in zip(ds, js) if np.isfinite(d)] for ds, js in zip(best, who)
    ]


def distinct_vectors(points: DataFrame, extra: dict | None = None) -> DataFrame:
    """One row per distinct vector: smallest id, number of copies, and any ``extra`` aggregates."""
    aggregates = [c.alias(n) for n, c in (extra or {}).items()]
    return points.groupBy("vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), *aggregates)


def nearest_neighbours(
    points: DataFrame, k: int, block_rows: int = BLOCK_ROWS, max_pivots: int = MAX_PIVOTS, cells: int | None = None, every: int = 1
) -> DataFrame:
    """``points`` (id long, vec array<double>, all vectors distinct) -> (id, rank, neighbour, distance).

    Exact, unless ``cells`` is given: then a vector visits only the blocks of that many nearest cells (and its own
    block), which bounds the work where distances rule nothing out. The choice never depends on the size of the table.
    With ``every`` only the ids divisible by it search, among all rows.
    """
    spark = points.sparkSession
    n = points.count()
    n_pivots = max(1, min(max_pivots, math.ceil(n / block_rows)))
    seeds = points.select("vec").orderBy(F.md5(F.col("id").cast("string"))).limit(n_pivots).collect()
    pivots = spark.sparkContext.broadcast(np.array([r["vec"] for r in seeds], dtype=float))

    @F.pandas_udf("cell int, reach double")
    def locate(vec: pd.Series) -> pd.DataFrame:
        x = np.stack(vec.to_list())
        found = [(d.argmin(axis=1), d.min(axis=1)) for _, d in _batches(x, pivots.value)]
        return pd.DataFrame({"cell": np.concatenate([c for c, _ in found]).astype("int32"), "reach": np.concatenate([r for _, r in found])})

    placed = stored(points.select("id", "vec", locate("vec").alias("p")).select("id", "vec", "p.*"), "placed")
    # bounded: one row per pivot
    sizes = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    cuts = spark.createDataFrame([(c, math.ceil(m / block_rows)) for c, m in sizes.items()], "cell int, cuts int")
    blocked = placed.join(F.broadcast(cuts), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"))
    # one row (cell, part, radius) per block of block_rows vectors
    balls = blocked.groupBy("cell", "part").agg(F.max("reach").alias("radius")).orderBy("cell", "part").collect()
    number = spark.createDataFrame([(b["cell"], b["part"], i) for i, b in enumerate(balls)], "cell int, part int, block int")
    blocked = blocked.join(F.broadcast(number), ["cell", "part"]).select("id", "vec", "block")

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids = np.stack(pdf["vec"].to_list()), pdf["id"].to_numpy()
        asked = ids % every == 0
        best, who = np.full((len(x), k), np.inf), np.zeros((len(x), k), np.int64)
        best[asked], who[asked] = _nearest(x[asked], ids[asked], x, ids, k)
        return pdf[["id", "vec", "block"]].assign(bound=best[:, -1], near=_lists(best, who))

    near_type = "array<struct<distance:double,neighbour:bigint>>"
    path = store(
        blocked.groupBy("block").applyInPandas(
            inside, f"id bigint, vec array<double>, block int, bound double, near {near_type}"
        ),
        "own-block",
    )
    first = spark.read.parquet(path)
    candidates = first.select("id", F.explode("near").alias("c")).select("id", "c.*")
    if len(balls) > 1:
        candidates = candidates.unionByName(_visits(spark, path, balls, pivots, k, block_rows, cells, every))
    order = Window.partitionBy("id").orderBy("distance", "neighbour")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _visits(
    spark: SparkSession, path: str, balls: list, pivots, k: int, block_rows: int, cells: int | None, every: int
) -> DataFrame:
    """Candidates from the blocks that a vector's first bound does not rule out."""
    queries, there = spark.read.parquet(path).filter(F.pmod("id", F.lit(every)) == 0), spark.read.parquet(path)
    centre = spark.sparkContext.broadcast(
        (np.array([b["cell"] for b in balls]), np.array([b["radius"] for b in balls]))
    )

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def reachable(vec: pd.Series, bound: pd.Series, block: pd.Series) -> pd.Series:
        cell_of, radii = centre.value
        x = np.stack(vec.to_list())
        out = []
        for start, dist in _batches(x, pivots.value):
            for i, row in enumerate(dist):
                limit = bound.iloc[start + i] * (1 + SLACK) + SLACK
                near = row[cell_of] - radii <= limit
                if cells:
                    near &= row[cell_of] <= np.partition(row, min(cells, len(row)) - 1)[min(cells, len(row)) - 1]
                hit = np.flatnonzero(near)
                out.append([int(b) for b in hit if b != block.iloc[start + i]])
        return pd.Series(out)

    visits = queries.select("id", "vec", F.explode(reachable("vec", "bound", "block")).alias("block"))
    counted = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("chunks"))
    # one row per block
    busy = counted.collect()

    def chunks() -> DataFrame:
        return F.broadcast(spark.createDataFrame(busy, "block int, chunks int"))

    visitors = visits.join(chunks(), "block").withColumn(
        "chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    )
    residents = (
        there.select("id", "vec", "block")
        .join(chunks(), "block")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    )

    def meet(visiting: pd.DataFrame, resident: pd.DataFrame) -> pd.DataFrame:
        if not (len(visiting) and len(resident)):
            return pd.DataFrame({"id": [], "distance": [], "neighbour": []})
        q, r = np.stack(visiting["vec"].to_list()), np.stack(resident["vec"].to_list())
        ids = visiting["id"].to_numpy()
        best, who = _nearest(q, ids, r, resident["id"].to_numpy(), k)
        row, place = np.nonzero(np.isfinite(best))
        return pd.DataFrame({"id": ids[row], "distance": best[row, place], "neighbour": who[row, place]})

    return (
        visitors.groupBy("block", "chunk")
        .cogroup(residents.groupBy("block", "chunk"))
        .applyInPandas(meet, "id bigint, distance double, neighbour bigint")
    )
