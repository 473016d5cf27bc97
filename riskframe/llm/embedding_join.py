"""Exact metric range join of embeddings for near-duplicate removal.

Unit vectors at cosine c are sqrt(2 - 2c) apart, so linking by cosine is a range join
in a metric space. Each label with many vectors gets pivots; a vector's home cell is its
nearest pivot. By the triangle inequality a partner of x can only live in a cell j with
d(x, p_j) - d(x, p_i) <= 2r, and within r of that cell's radius; x is replicated to just
those. Cells then join independently: each vector counts its links in its home cell. A
cell with many rows is cut into tiles of home rows and members, so that no task holds
more than two tiles' rows. Pairs stay inside the tile; counts and a spanning
star leave it.

Pivots are limited in number (their table is broadcast); a limit changes the size of the
cells, never the result. Equal vectors of a label are one row with a count.

In data without structure (independent directions in many dimensions) no exact metric
method prunes: every boundary holds all points, and the work is that of all pairs within a label.

Defined results: NULL labels, and vectors that are NULL, empty, zero or hold a NULL or
non-finite component, link with nothing; vectors of unequal length are never linked;
repeated ids are repeated rows; a NULL id has no component and stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import plain, stored
from riskframe.llm.components import connected_components
from riskframe.llm.jaccard_join import roots_of

COSINE = 0.93
#: Rows of a tile; also the cell size that the number of pivots aims at.
TILE_ROWS = 1024
#: Most pivots over all labels together.
MAX_PIVOTS = 4096
#: Room for rounding in the bounds of the partition; the links themselves are tested exactly.
SLACK = 1e-6
_OUT = "id long, links long, root long"


def _unit(rows: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of unit vectors, the norm in double precision."""
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(len(rows), -1)
    scale = np.abs(matrix).max(axis=1, keepdims=True)  # keeps very large and very small ones in range
    matrix = matrix / scale
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _valid_vectors(table: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    cells = table.select(
        plain(vec_id).alias("vec_id"),
        plain(label).cast("string").alias("label"),
        plain(embedding).cast("array<double>").alias("vec"),
    )
    sound = (
        F.col("label").isNotNull()
        & (F.size("vec") > 0)
        & F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
        & F.exists("vec", lambda v: v != 0)
    )
    return cells.withColumn("sound", F.coalesce(sound, F.lit(False)))


def _cells_of(pivots: dict[str, np.ndarray], radius: float):
    """Home cell and replicas of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pivots.value
        for batch in batches:
            spaces = np.array(batch.column("space").to_pylist(), object)
            for space in dict.fromkeys(spaces):
                part = batch.filter(pa.array(spaces == space))
                points = known.get(space)
                if points is None:
                    home = np.zeros((part.num_rows, 1), bool) | True
                    chosen = home
                else:
                    vectors = _unit(part.column("vec"))
                    away = np.sqrt(np.maximum(0, 2 - 2 * vectors @ points.T))
                    nearest = away.argmin(axis=1)
                    least = away[np.arange(len(away)), nearest]
                    home = np.arange(len(points)) == nearest[:, None]
                    chosen = away - least[:, None] <= 2 * radius + SLACK
                row, cell = np.nonzero(chosen)
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [taken.column("space"), pa.array(cell.astype(np.int32)), pa.array(home[row, cell]),
                     taken.column("id"), taken.column("n"), taken.column("vec")],
                    ["space", "cell", "home", "id", "n", "vec"],
                )

    return run


def _links(home: list[tuple], members: list[tuple], least: float) -> pa.RecordBatch | None:
    h_id, m_id = (np.array([r[0] for r in rows], np.int64) for rows in (home, members))
    copies = np.array([r[1] for r in members], np.int64)
    h, m = (_unit(pa.array([r[2] for r in rows], pa.list_(pa.float64()))) for rows in (home, members))
    near = h @ m.T >= least
    near &= h_id[:, None] != m_id[None, :]
    row, col = np.nonzero(near)
    if not len(row):
        return None
    ids, place = np.unique(np.concatenate([h_id, m_id]), return_inverse=True)
    a, b = place[row], place[len(h_id) + col]
    root = roots_of(len(ids), a, b)
    linked = np.unique(np.concatenate([a, b]))
    links = np.bincount(a, copies[col], len(ids)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[linked]), pa.array(links[linked]), pa.array(ids[root[linked]])], ["id", "links", "root"]
    )


def _join_tiles(least: float):
    """Rows arrive sorted by tile, home rows and members of one tile together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, home, members = None, [], []
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("space", "cell", "i", "j")])
            sides, ids, counts = (batch.column(c).to_pylist() for c in ("as_home", "id", "n"))
            vectors = batch.column("vec")
            for k, key in enumerate(keys):
                if key != of:
                    if home and members and (out := _links(home, members, least)):
                        yield out
                    of, home, members = key, [], []
                (home if sides[k] else members).append((ids[k], counts[k], vectors[k].values.to_numpy(zero_copy_only=False)))
        if home and members and (out := _links(home, members, least)):
            yield out

    return run


def _choose_pivots(rows: DataFrame, tile_rows: int, max_pivots: int) -> dict[str, np.ndarray]:
    """Pivots of the spaces that need more than one cell: a hash sample, bounded in number over all spaces."""
    total = rows.count()
    per_pivot = max(tile_rows, -(-total // max_pivots))
    counts = {r["space"]: r["count"] for r in rows.groupBy("space").count().filter(F.col("count") > per_pivot).collect()}
    if not counts:
        return {}
    sizes = rows.sparkSession.createDataFrame(list(counts.items()), "space string, size long")
    draw = F.pmod(F.xxhash64("id", F.lit("pivot")), F.lit(1 << 31)) / F.lit(float(1 << 31))
    sampled = rows.join(F.broadcast(sizes), "space").filter(draw < F.lit(float(per_pivot)) ** -1)
    vectors: dict[str, list] = {}
    for r in sampled.select("space", "id", "vec").orderBy("space", "id").collect():  # about max_pivots rows at most
        vectors.setdefault(r["space"], []).append(r["vec"])
    return {s: _unit(pa.array(v, pa.list_(pa.float64()))) for s, v in vectors.items() if len(v) > 1}


def near_duplicates(
    table: DataFrame,
    cosine: float = COSINE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    tile_rows: int = TILE_ROWS,
    max_pivots: int = MAX_PIVOTS,
) -> DataFrame:
    """Per input row: vec_id, n_links, component_id (least id reachable) and kept."""
    spark = table.sparkSession
    rows = stored(_valid_vectors(table, vec_id, embedding, label), "vectors")
    sound = rows.filter("sound")
    distinct = sound.groupBy("label", "vec").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    space = F.concat_ws(":", F.size("vec"), F.col("label"))
    distinct = stored(distinct.withColumns({"id": F.monotonically_increasing_id(), "space": space}), "distinct")

    slim = distinct.select("space", "id", "n", "vec")
    radius = float(np.sqrt(2 - 2 * cosine))
    pivots = spark.sparkContext.broadcast(_choose_pivots(slim, tile_rows, max_pivots))
    cells = slim.mapInArrow(
        _cells_of(pivots, radius), "space string, cell int, home boolean, id long, n long, vec array<double>"
    )
    cells = stored(cells, "cells")
    sizes = cells.groupBy("space", "cell").agg(F.count("*").alias("size"), F.count_if("home").alias("homes"))
    blocks = lambda c: F.ceil(F.col(c) / tile_rows).cast("int")
    sizes = sizes.filter("homes > 0").select("space", "cell", blocks("homes").alias("ni"), blocks("size").alias("nj"))
    dealt = cells.join(sizes, ["space", "cell"])
    block = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    columns = ["space", "cell", "i", "j", "as_home", "id", "n", "vec"]
    homes = dealt.filter("home").withColumn("i", block("ni", "i")).withColumn("j", F.explode(upto("nj")))
    members = dealt.withColumn("j", block("nj", "j")).withColumn("i", F.explode(upto("ni")))
    tiles = homes.withColumn("as_home", F.lit(True)).select(*columns).unionByName(
        members.withColumn("as_home", F.lit(False)).select(*columns)
    )
    tiles = tiles.repartition("space", "cell", "i", "j").sortWithinPartitions("space", "cell", "i", "j")
    found = stored(tiles.mapInArrow(_join_tiles(cosine), _OUT), "links")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = (
        distinct.select("label", "vec", "id", "n", "least")
        .join(links, "id", "left")
        .join(groups.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    named = stored(named, "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = named.join(least, "component").select(
        "label", "vec", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    alone = rows.filter("not sound").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    linked = rows.filter("sound").join(facts, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    linked = linked.withColumn("component_id", F.when(F.col("vec_id").isNotNull(), F.col("component_id")))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return alone.unionByName(linked).withColumn("kept", kept)


def keep_one_of_each(table: DataFrame, vec_id: str = "vec_id", **options) -> DataFrame:
    """The rows with all columns, one vector of each component; rows with a NULL id stay."""
    names = table.columns
    gone = near_duplicates(table, vec_id=vec_id, **options).filter("not kept").select(F.col("vec_id").alias("__id"))
    return table.join(gone.distinct(), plain(vec_id) == F.col("__id"), "left_anti").select(*[plain(n) for n in names])
