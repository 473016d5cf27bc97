"""Gradient boosting with penalties on leaf weights and columns drawn per tree.

Rows are binned once. Each level of a tree is one pass: every task adds up gradients and second derivatives per node, column and
bin, and Spark sums these histograms, whose size does not depend on the rows. Splits are found on the sums, and one
row per node comes back. Sums are of whole numbers (fixed point), and draws come from hashes, so the trees do not depend on the order or
partitioning of the rows, and a lost executor changes nothing.

Margins are written every ``keep_every`` trees; passes between add the trees since. Bin edges are quantiles of a sample of
bounded size (``sample_rows``, the first in hash order); if a column has at most ``bins`` distinct values, which is counted over all
rows, each has its own bin. The first sums (``first_histograms``) also come with a bin per value, however many there are.

A missing value goes to the left, as the smallest. ``weight`` scales a row's gradient; without it all rows weigh the same.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expr import col
from riskframe.operators.frame import require_columns
from riskframe.operators.ordering import running_totals
from riskframe.operators.storage import stored

#: Gradients are summed as whole multiples of 1 / FIXED.
FIXED = 1 << 20
SAMPLE_ROWS = 65_536
#: Rows per partition that ``monotonically_increasing_id`` tells apart.
_ROW_BITS = 33


@dataclass(frozen=True)
class Boosting:
    """How trees are grown; fixed values are the training defaults."""

    rounds: int = 500
    rate: float = 0.05
    depth: int = 5
    row_share: float = 0.8
    column_share: float = 0.8
    l2: float = 1.0
    l1: float = 0.0
    least_gain: float = 0.0
    least_hessian: float = 1.0
    bins: int = 64
    seed: int = 42
    keep_every: int = 25


@dataclass
class Tree:
    """Nodes in heap order: the children of i are 2i + 1 and 2i + 2. A column of -1 marks a leaf."""

    column: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n))

    def leaves(self, x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The node that each row ends in; a row goes right if its cell is above the cut of the node."""
        node = np.zeros(len(x), np.int64)
        for _ in range(len(self.column).bit_length() - 1):
            own = self.column[node]
            inner = np.flatnonzero(own >= 0)
            if not len(inner):
                break
            at = node[inner]
            node[inner] = 2 * at + 1 + (x[inner, own[inner]] > cuts[at])
        return node


@dataclass
class BoostedTrees:
    """A fitted model: columns, starting margin, trees."""

    columns: list[str]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.value[tree.leaves(x, tree.threshold)]
        return out

    def probability(self) -> Column:
        """An expression over the model's columns, to be used like any known formula (``add_scores``)."""

        def score(*cells: pa.Array) -> pa.Array:
            x = np.stack([_numbers(c) for c in cells], axis=1)
            return pa.array(1.0 / (1.0 + np.exp(-self.margins(x))))

        return F.arrow_udf(score, T.DoubleType())(*[col(c).cast("double") for c in self.columns])

    def save(self, spark: SparkSession, path: str) -> None:
        lines = [json.dumps({"columns": self.columns, "base": self.base})]
        lines += [json.dumps({k: v.tolist() for k, v in vars(t).items()}) for t in self.trees]
        rows = spark.createDataFrame(list(enumerate(lines)), "at int, line string")
        rows.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        head, *trees = [json.loads(r["line"]) for r in spark.read.parquet(path).orderBy("at").collect()]  # a row per tree
        return cls(**head, trees=[Tree(**{k: np.array(v) for k, v in t.items()}) for t in trees])


def _numbers(cells: pa.Array) -> np.ndarray:
    """Doubles with missing values as the smallest of all."""
    values = cells.to_numpy(zero_copy_only=False).astype(float)
    return np.where(np.isnan(values), -np.inf, values)


def _first_values(width: int, limit: int):
    """Per task and column the distinct values, at most ``limit`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.empty(0)] * width
        for batch in batches:
            for i in range(width):
                if len(seen[i]) < limit:
                    values = batch.column(f"x{i}").to_numpy(zero_copy_only=False).astype(float)
                    seen[i] = np.unique(np.concatenate([seen[i], values[~np.isnan(values)]]))[:limit]
        at = np.repeat(np.arange(width), [len(s) for s in seen])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.concatenate(seen))], ["at", "x"])

    return run


def few_values(cells: DataFrame, bins: int) -> dict[int, np.ndarray]:
    """All distinct values, ascending, of those columns that have at most ``bins``; exact, from one pass.

    A task hands on at most one value more than that per column, which shows that there are too many.
    """
    found = cells.mapInArrow(_first_values(len(cells.columns), bins + 1), "at long, x double").distinct()
    lists = found.groupBy("at").agg(F.slice(F.sort_array(F.collect_list("x")), 1, bins + 1).alias("x")).collect()  # a row per column
    values = {r["at"]: np.unique(np.array(r["x"], float)) for r in lists}
    none = np.empty(0)
    return {i: values.get(i, none) for i in range(len(cells.columns)) if len(values.get(i, none)) <= bins}


def _first_in_hash_order(cells: DataFrame, rows: int) -> DataFrame:
    """The hash is a column of its own: as a mere sort expression it would be computed anew in every comparison of two rows."""
    place = F.md5(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cells.columns]))
    return cells.withColumn("__place", place).orderBy("__place").limit(rows)


def bin_edges(df: DataFrame, columns: Sequence[str], bins: int, sample_rows: int = SAMPLE_ROWS) -> list[np.ndarray]:
    """Ascending upper edges of all bins but the last, per column."""
    cells = df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    few = few_values(cells, bins)
    edges = {i: distinct[:-1] for i, distinct in few.items()}
    wide = [i for i in range(len(columns)) if i not in few]
    if wide:
        taken = _first_in_hash_order(cells, sample_rows).select(*[f"x{i}" for i in wide])
        x = np.array([tuple(r) for r in taken.collect()], float).reshape(-1, len(wide))  # bounded
        for i, values in zip(wide, x.T):
            known = np.sort(values[~np.isnan(values)])
            edges[i] = np.unique(known[np.arange(1, bins) * len(known) // bins]) if len(known) else known
    return [edges[i] for i in range(len(columns))]


def _binned(edges: list[np.ndarray], base: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.searchsorted(e, _numbers(batch.column(f"x{i}")), "left") for i, e in enumerate(edges)]
            rows = np.ascontiguousarray(np.stack(x, axis=1).astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in rows], pa.binary()), batch.column("y"), batch.column("weight"),
                 batch.column("draw"), pa.array(np.full(len(rows), base))],
                ["x", "y", "weight", "draw", "margin"],
            )

    return run


_ROWS = "x binary, y double, weight double, draw long, margin double"


def _cells(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), np.uint8).reshape(-1, width).astype(np.int64)


def _add(batch: pa.RecordBatch, x: np.ndarray, trees: list[Tree]) -> np.ndarray:
    margin = batch.column("margin").to_numpy().copy()
    for tree in trees:
        margin += tree.value[tree.leaves(x, tree.bin)]
    return margin


def _kept(trees: list[Tree], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = pa.array(_add(batch, _cells(batch, width), trees))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("x", "y", "weight", "draw")], margin], ["x", "y", "weight", "draw", "margin"])

    return run


def _drawn(draw: np.ndarray, turn: int, share: float) -> np.ndarray:
    """Which rows take part in a tree: by a hash of the row's number and the turn."""
    x = draw.view(np.uint64) + np.uint64(turn + 1) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(40)).astype(float) < share * (1 << 24)


def _histograms(since: list[Tree], tree: Tree, nodes: list[int], columns: np.ndarray, width: int, bins: int, turn: int, share: float):
    """Per node, column and bin the sums of gradients and second derivatives over a task's rows."""
    place = np.full(len(tree.column), -1)
    place[nodes] = np.arange(len(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(nodes) * bins
        total = np.zeros((2, len(columns), size), np.int64)
        for batch in batches:
            x = _cells(batch, width)
            p = 1.0 / (1.0 + np.exp(-_add(batch, x, since)))
            weight = batch.column("weight").to_numpy() * FIXED
            g = np.rint((p - batch.column("y").to_numpy()) * weight)
            h = np.rint(p * (1.0 - p) * weight)
            own = place[tree.leaves(x, tree.bin)]
            rows = np.flatnonzero((own >= 0) & _drawn(batch.column("draw").to_numpy(), turn, share))
            own, g, h = own[rows], g[rows], h[rows]
            for k, c in enumerate(columns):
                code = own * bins + x[rows, c]
                total[0, k] += np.bincount(code, g, size).astype(np.int64)
                total[1, k] += np.bincount(code, h, size).astype(np.int64)
        column, code = np.nonzero(total.any(axis=0))
        g, h = total[:, column, code]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(nodes, np.int64)[code // bins]), pa.array(columns[column]), pa.array(code % bins), pa.array(g), pa.array(h)],
            ["node", "feature", "bin", "g", "h"],
        )

    return run


_SUMS = "node long, feature long, bin long, g long, h long"


def split_gains(sums: DataFrame, l2: float = 1.0, l1: float = 0.0) -> DataFrame:
    """Sums per (node, feature, bin) -> what a split behind each bin gains.

    Adds g_left, h_left, g_all, h_all and gain: half of what the squared, shrunk gradients over ``h + l2`` grow by.
    Bins that lie in slices (column ``slice``, ascending with the bins) are added up slice by slice.
    """
    real = lambda c: c / F.lit(float(FIXED))
    if "slice" in sums.columns:
        running = running_totals(sums, "bin", "slice", ["g", "h"], ["node", "feature"])
        helpers = [f"{m}__{k}" for m in ("g", "h") for k in ("before", "upto", "all")]
        added = running.withColumns(
            {f"{m}_{name}": real(F.col(f"{m}__{k}")) for k, name in (("upto", "left"), ("all", "all")) for m in ("g", "h")}
        ).drop(*helpers)
    else:
        upto = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy("node", "feature")  # at most one row per bin
        added = sums.withColumns(
            {
                "g_left": real(F.sum("g").over(upto)), "h_left": real(F.sum("h").over(upto)),
                "g_all": real(F.sum("g").over(whole)), "h_all": real(F.sum("h").over(whole)),
            }
        )

    def quality(g: Column, h: Column) -> Column:
        shrunk = F.greatest(F.abs(g) - F.lit(float(l1)), F.lit(0.0))
        return shrunk * shrunk / (h + F.lit(float(l2)))

    g, h, left_g, left_h = F.col("g_all"), F.col("h_all"), F.col("g_left"), F.col("h_left")
    parts = quality(left_g, left_h) + quality(g - left_g, h - left_h) - quality(g, h)
    return added.withColumn("gain", F.lit(0.5) * parts)


def best_splits(gains: DataFrame, least_gain: float, least_hessian: float) -> DataFrame:
    """One row per node: its sums, and its best split (NULL if none gains). Of equal gains the first column and bin."""
    enough = (F.col("h_left") >= least_hessian) & (F.col("h_all") - F.col("h_left") >= least_hessian)
    split = F.struct(F.col("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"), "g_left", "h_left")
    best = F.max(F.when(enough & (F.col("gain") > least_gain), split)).alias("best")
    return gains.groupBy("node").agg(F.first("g_all").alias("g"), F.first("h_all").alias("h"), best).select(
        "node", "g", "h", "best.gain", (-F.col("best.feature")).alias("feature"), (-F.col("best.bin")).alias("bin"),
        "best.g_left", "best.h_left",
    )


def leaf_weight(g: float, h: float, l2: float, l1: float) -> float:
    return float(-np.sign(g) * max(abs(g) - l1, 0.0) / (h + l2)) if h + l2 > 0 else 0.0


def _start(df: DataFrame, y: Column, w: Column) -> float:
    """The margin of all rows before any tree."""
    mean = df.agg(F.try_divide(F.sum(y * w), F.sum(w))).first()[0]
    if mean is None or not 0 < mean < 1:
        raise ValueError("two classes are needed")
    return float(np.log(mean / (1 - mean)))


def _prepared(
    df: DataFrame, columns: Sequence[str], target: str, weight: str | None, key: str | None, bins: int
) -> tuple[DataFrame, list[np.ndarray], float]:
    require_columns(df, [*columns, target, *([weight] if weight else []), *([key] if key else [])], "training table")
    if not 2 <= bins <= 256:
        raise ValueError("from 2 to 256 bins")
    y, w = col(target).cast("double"), (col(weight).cast("double") if weight else F.lit(1.0))
    base = _start(df, y, w)
    edges = bin_edges(df, columns, bins)
    draw = F.xxhash64(col(key)) if key else F.xxhash64(*[col(c) for c in [*columns, target]])
    cells = [col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    slim = df.select(*cells, y.alias("y"), w.alias("weight"), draw.alias("draw"))
    return stored(slim.mapInArrow(_binned(edges, base), _ROWS), "binned"), edges, base


def _value_sums(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Per column and distinct value the root's sums (feature, x, g, h); missing values count with the smallest."""
    y = col(target).cast("double")
    p = float(1.0 / (1.0 + np.exp(-_start(df, y, F.lit(1.0)))))
    known = F.when(y.isNull(), F.raise_error(F.lit(f"column {target} holds NULL")).cast("double")).otherwise(y)
    g = F.rint((F.lit(p) - known) * F.lit(float(FIXED))).cast("long").alias("g")
    numbers = [col(c).cast("double") for c in columns]
    cells = F.array(*[F.struct(F.lit(i).cast("long").alias("feature"), F.when(~F.isnan(x), x).alias("x")) for i, x in enumerate(numbers)])
    counted = df.select(g, F.explode(cells).alias("c")).groupBy("c.feature", "c.x").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("n"))
    counted = stored(counted, "value-sums")
    least = F.broadcast(counted.groupBy("feature").agg(F.min("x").alias("least")))  # a row per column
    x = F.coalesce("x", "least", F.lit(float("-inf"))).alias("x")
    each = int(np.rint(p * (1.0 - p) * FIXED))
    return counted.join(least, "feature").groupBy("feature", x).agg(F.sum("g").alias("g"), (F.sum("n") * each).alias("h"))


def _numbered_values(sums: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bins 0, 1, ... of each column's values in ascending order, in slices, and the upper edges of all bins but the last.

    The order is that of a distributed sort, whose partitions are the slices; only counts per partition reach the driver.
    """
    ordered = stored(sums.orderBy("feature", "x").withColumn("row", F.monotonically_increasing_id()), "values")
    part, inside = F.shiftright("row", _ROW_BITS), F.col("row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = ordered.groupBy(part.alias("slice"), "feature").count().collect()  # a row per partition, and per column
    starts, sizes, inner = [], {}, {}
    for slice_no, feature, n in sorted(tuple(r) for r in counts):
        # the place of the partition's first row of the column: among the column's rows, less its place in the partition
        starts.append((slice_no, feature, sizes.get(feature, 0) - inner.get(slice_no, 0)))
        sizes[feature] = sizes.get(feature, 0) + n
        inner[slice_no] = inner.get(slice_no, 0) + n
    spark = sums.sparkSession
    starts = spark.createDataFrame([(*s, sizes[s[1]] - 1) for s in starts], "slice long, feature long, start long, last long")
    numbered = ordered.withColumn("slice", part).join(F.broadcast(starts), ["slice", "feature"]).withColumn("bin", F.col("start") + inside)
    edges = numbered.filter("bin < last").select("feature", "bin", F.col("x").alias("upto"))
    return numbered.select(F.lit(0).cast("long").alias("node"), "feature", "bin", "g", "h", "slice"), edges


def first_histograms(df: DataFrame, columns: Sequence[str], target: str, bins: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The root's sums before any tree, over all rows and columns, and the upper edges (feature, bin, upto) of all bins but the last.

    Without ``bins`` every distinct value has its own bin, however many there are.
    """
    if bins is None:
        require_columns(df, [*columns, target], "training table")
        return _numbered_values(_value_sums(df, columns, target))
    rows, edges, _ = _prepared(df, columns, target, None, None, bins)
    found = rows.mapInArrow(_histograms([], Tree.empty(0), [0], np.arange(len(columns)), len(columns), bins, 0, 1.0), _SUMS)
    tops = [(f, b, float(v)) for f, own in enumerate(edges) for b, v in enumerate(own)]
    tops = df.sparkSession.createDataFrame(tops, "feature long, bin long, upto double")
    return found.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")), tops


def train_boosted(
    df: DataFrame, columns: Sequence[str], target: str, how: Boosting = Boosting(), weight: str | None = None, key: str | None = None
) -> BoostedTrees:
    """Fits the trees. ``key`` names the rows in the draws; without it equal rows are drawn together."""
    columns, width = list(columns), len(columns)
    rows, edges, base = _prepared(df, columns, target, weight, key, how.bins)
    model, since = BoostedTrees(columns, base), []
    rng = np.random.default_rng(how.seed)
    for turn in range(how.rounds):
        drawn = np.sort(rng.choice(width, max(1, int(round(how.column_share * width))), replace=False))
        tree, nodes = Tree.empty(how.depth), [0]
        for _ in range(how.depth):
            counted = rows.mapInArrow(_histograms(since, tree, nodes, drawn, width, how.bins, turn, how.row_share), _SUMS)
            sums = counted.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            found = best_splits(split_gains(sums, how.l2, how.l1), how.least_gain, how.least_hessian).collect()  # a row per node
            nodes = []
            for r in found:
                at = r["node"]
                tree.value[at] = how.rate * leaf_weight(r["g"], r["h"], how.l2, how.l1)
                if r["gain"] is not None:
                    tree.column[at], tree.bin[at] = r["feature"], r["bin"]
                    tree.threshold[at] = edges[r["feature"]][r["bin"]]
                    for child, g, h in ((1, r["g_left"], r["h_left"]), (2, r["g"] - r["g_left"], r["h"] - r["h_left"])):
                        tree.value[2 * at + child] = how.rate * leaf_weight(g, h, how.l2, how.l1)
                        nodes.append(2 * at + child)
            if not nodes:
                break
        model.trees.append(tree)
        since.append(tree)
        if len(since) >= how.keep_every and turn + 1 < how.rounds:
            rows, since = stored(rows.mapInArrow(_kept(since, width), _ROWS), "margins"), []
    return model

