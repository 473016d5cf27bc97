"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text form a group that is never split. Groups, sorted by size, enter the
bin with the tightest sufficient room; bins are kept in a balanced tree by room. The
capacity is the smallest found at which the packing needs no more than the wanted
number of shards, so shards are near equal in bytes.

The packing itself runs on the driver over a bounded number of units: a group of at
least one unit of bytes (1 / ``UNITS`` of a shard) is packed by itself, and there are
at most shards x UNITS of those; smaller groups are first bundled, in Spark, to about
one unit. So the plan has the same size for a megabyte and for 100 TB.

Defined results: a NULL text is an empty one (size 8, CRC 0) and shares the group of
empty texts; NULL and repeated ids are just passengers; a group larger than an even
share gets a shard that is as large as it must be; an empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import content_key, stored, text_of
from riskframe.session import shuffle_parallelism

#: Units of packing per shard; groups below one unit are bundled first.
UNITS = 4096
ROW_BYTES = 8


class RoomTree:
    """Balanced tree (a treap) of (room, bin) pairs that finds the tightest sufficient room."""

    def __init__(self) -> None:
        self._root: list | None = None
        self._random = random.Random(7)

    @staticmethod
    def _merge(a, b):
        if not a or not b:
            return a or b
        if a[1] > b[1]:
            a[3] = RoomTree._merge(a[3], b)
            return a
        b[2] = RoomTree._merge(a, b[2])
        return b

    @staticmethod
    def _split(node, key):
        """Nodes below the key, and the others."""
        if not node:
            return None, None
        if node[0] < key:
            left, right = RoomTree._split(node[3], key)
            node[3] = left
            return node, right
        left, right = RoomTree._split(node[2], key)
        node[2] = right
        return left, node

    def add(self, key: tuple[int, int]) -> None:
        left, right = self._split(self._root, key)
        self._root = self._merge(self._merge(left, [key, self._random.random(), None, None]), right)

    def take(self, room: int) -> tuple[int, int] | None:
        """Removes and returns the smallest pair with at least this room."""
        left, right = self._split(self._root, (room, -1))
        if not right:
            self._root = left
            return None
        node, parent = right, None
        while node[2]:
            node, parent = node[2], node
        if parent:
            parent[2] = node[3]
        else:
            right = node[3]
        self._root = self._merge(left, right)
        return node[0]


def best_fit_decreasing(sizes: Iterable[int], capacity: int) -> tuple[list[int], int]:
    """Bin of each item, and the number of bins. Items larger than the capacity are refused."""
    sizes = list(sizes)
    bins, count, tree = [0] * len(sizes), 0, RoomTree()
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        if sizes[i] > capacity:
            raise ValueError(f"an item of {sizes[i]} does not fit a bin of {capacity}")
        room, chosen = tree.take(sizes[i]) or (capacity, count)
        count = max(count, chosen + 1)
        bins[i] = chosen
        tree.add((room - sizes[i], chosen))
    return bins, count


def pack_into(sizes: list[int], shards: int) -> tuple[list[int], int]:
    """Packs into at most ``shards`` bins, with the smallest capacity a bisection finds. Returns bins and capacity."""
    if not sizes:
        return [], 0
    low = max(-(-sum(sizes) // shards), max(sizes))
    best, high = None, low + max(sizes)  # at this capacity some bin always has room
    while low < high or best is None:
        middle = (low + high) // 2
        bins, count = best_fit_decreasing(sizes, middle)
        if count <= shards:
            best, high = (bins, middle), middle
        else:
            low = middle + 1
        if best and high - low <= high // 100_000:
            break
    return best


def shard_documents(
    docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text", units: int = UNITS
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    slices = shuffle_parallelism(spark)
    slim = text_of(docs, doc_id, text).select(
        "doc_id",
        (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        content_key("text").alias("key"),
    )
    slim = stored(slim, "sizes")
    total = slim.agg(F.sum("size")).first()[0] or 0
    unit = max(1, -(-total // (shards * units)))
    # At most total / unit groups reach the unit, so both lists below are bounded by shards x units (+ slices).
    large = slim.groupBy("key").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") >= unit).collect()
    large_keys = spark.createDataFrame([(bytes(r["key"]),) for r in large], "key binary")
    small = slim.join(F.broadcast(large_keys), "key", "left_anti")
    in_slice = Window.partitionBy("slice").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    small = small.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(slices)).cast("int"))
    small = small.withColumn("bundle", F.floor(F.sum("size").over(in_slice) / F.lit(unit)).cast("long"))
    small = stored(small, "bundles")
    bundles = small.groupBy("slice", "bundle").agg(F.sum("size").alias("bytes")).collect()

    units_of = [(r["bytes"], bytes(r["key"]), None) for r in large] + [
        (r["bytes"], b"", (r["slice"], r["bundle"])) for r in bundles
    ]
    units_of.sort(key=lambda u: (-u[0], u[1], u[2] or (-1, -1)))
    bins, _ = pack_into([u[0] for u in units_of], shards)
    plan_large = spark.createDataFrame(
        [(u[1], b) for u, b in zip(units_of, bins) if u[2] is None], "key binary, shard int"
    )
    plan_small = spark.createDataFrame(
        [(*u[2], b) for u, b in zip(units_of, bins) if u[2] is not None], "slice int, bundle long, shard int"
    )
    columns = ["doc_id", "size", "text_crc32", "key", "shard"]
    placed = slim.join(F.broadcast(plan_large), "key").select(*columns)
    placed = placed.unionByName(small.join(F.broadcast(plan_small), ["slice", "bundle"]).select(*columns))
    return _number(placed, slices).select("doc_id", "size", "text_crc32", "shard", "slot")


def _number(placed: DataFrame, slices: int) -> DataFrame:
    """Adds slots: each shard is numbered in slices side by side, from offsets that their counts give."""
    placed = placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "key"), F.lit(slices)).cast("int"))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))  # shards x slices rows
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "key")
    numbered = placed.withColumn("inside", F.row_number().over(inside))
    return numbered.join(F.broadcast(offsets), ["shard", "part"]).withColumn(
        "slot", F.col("before") + F.col("inside") - 1
    )
