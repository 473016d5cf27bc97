"""Exact-size sampling, splitting and rebalancing.

"The n rows with the smallest hash" is an exact, repeatable random sample. No
global sort is needed to find them: rows are counted per hash prefix, the prefix
in which the n-th row falls is known from the counts, and that prefix alone is
counted again by its next digits, until the cut falls between two prefixes. No
row is ever ranked. The result of the search is one hash value per class;
taking the sample is then a filter on a single scan.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expr import col
from riskframe.functions.hashing import hash_order
from riskframe.operators.local_state import MAX_CLASSES, attach_classes, read_classes
from riskframe.operators.storage import stored

PREFIX_LENGTH = 4
HASH_LENGTH = 32
NONE_OF_CLASS, ALL_OF_CLASS = "", "~"

Key = str | Sequence[str]


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(col(target)).agg(F.count(F.lit(1)).alias("n_rows"))


def _prepare(df: DataFrame, seed: int, key: Key, target: str | None) -> DataFrame:
    stratum = col(target) if target else F.lit(0)
    return df.withColumns({"__hash": hash_order(seed, key), "__stratum": stratum})


def _prefix_counts(hashed: DataFrame) -> DataFrame:
    """Rows per class and hash prefix. Written once: class sizes and cut-offs both come from
    this table of at most 65536 rows per class, so the data is counted in one pass."""
    counts = (
        hashed.select("__stratum", F.substring("__hash", 1, PREFIX_LENGTH).alias("__prefix"))
        .groupBy("__stratum", "__prefix")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return stored(counts, "prefix-counts")


def _sizes(counts: DataFrame, label: str, max_classes: int = MAX_CLASSES) -> dict:
    return {r[0]: r[1] for r in read_classes(counts.groupBy("__stratum").agg(F.sum("n")), label, max_classes)}


def _edges(counted: DataFrame, wanted: list[tuple]) -> list:
    """Per stratum: the prefix in which the wanted place falls, its row count and the place inside it."""
    upto = Window.partitionBy("__stratum").orderBy("__prefix").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("upto", F.sum("n").over(upto))
    counted = attach_classes(counted, "__stratum", wanted, [T.StructField("wanted", T.LongType())])
    return counted.filter("upto - n < wanted and wanted <= upto").selectExpr(
        "__stratum", "__prefix", "n", "wanted - (upto - n) as place"
    ).collect()  # one row per class


def _cutoffs(hashed: DataFrame, counts: DataFrame, wanted: Mapping, sizes: Mapping, ties: dict | None = None) -> dict:
    """Per stratum, the largest hash that still belongs to the sample.

    The prefix that holds the cut-off is split by its next digits, by counts only, until the cut falls
    between two prefixes. Rows that share a whole hash are one key: a cut inside them raises, unless ``ties``
    collects (hash, rows to take), because such rows are interchangeable.
    """
    found = {s: ALL_OF_CLASS if n >= sizes[s] else NONE_OF_CLASS for s, n in wanted.items()}
    searched = [(s, n) for s, n in wanted.items() if 0 < n < sizes[s]]
    length = PREFIX_LENGTH
    while searched:
        edges = _edges(counts, searched)
        inside = []
        for e in edges:
            if e["place"] == e["n"]:
                found[e["__stratum"]] = e["__prefix"] + ALL_OF_CLASS
            elif length >= HASH_LENGTH:
                if ties is None:
                    raise ValueError("the sampling key does not identify a row: equal keys meet at the cut-off")
                ties[e["__stratum"]] = (e["__prefix"], e["place"])
            else:
                inside.append(e)
        searched = [(e["__stratum"], e["place"]) for e in inside]
        if searched:
            length += PREFIX_LENGTH
            prefixes = [(e["__stratum"], e["__prefix"]) for e in inside]
            deeper = attach_classes(
                hashed.select("__stratum", "__hash"), "__stratum", prefixes, [T.StructField("edge", T.StringType())]
            ).filter(F.col("__hash").startswith(F.col("edge")))
            counts = (
                deeper.select("__stratum", F.substring("__hash", 1, length).alias("__prefix"))
                .groupBy("__stratum", "__prefix")
                .agg(F.count(F.lit(1)).alias("n"))
            )
    return found


def _with_cutoff(hashed: DataFrame, cutoffs: Mapping, stratified: bool) -> DataFrame:
    if not stratified:
        return hashed.withColumn("__cut", F.lit(cutoffs[0]))
    return attach_classes(hashed, "__stratum", list(cutoffs.items()), [T.StructField("__cut", T.StringType())])


def _drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop("__hash", "__stratum", "__cut")


def exact_cutoff(df: DataFrame, n: int, seed: int, key: Key, clamp: bool = False, ties: dict | None = None) -> str:
    """The hash up to which exactly ``n`` rows lie."""
    hashed = _prepare(df, seed, key, None)
    counts = _prefix_counts(hashed)
    total = sum(_sizes(counts, "the sample").values())
    if n > total and not clamp:
        raise ValueError(f"cannot take {n} rows from {total}")
    return _cutoffs(hashed, counts, {0: n}, {0: total}, ties)[0]


def sample_exact(df: DataFrame, n: int | None, seed: int, key: Key, clamp: bool = False) -> DataFrame:
    """Exactly ``n`` rows without replacement; no ``n`` keeps everything.

    More rows than there are raise, unless ``clamp`` asks for all of them then.
    Where the key is the whole row, equal rows at the cut-off are
    interchangeable, and as many of them are taken as are missing.
    """
    if not n:
        return df
    keys = [key] if isinstance(key, str) else list(key)
    ties: dict | None = {} if set(keys) == set(df.columns) else None
    cut = exact_cutoff(df, n, seed, key, clamp, ties)
    order = hash_order(seed, key)
    if not ties:
        return df.filter(order <= F.lit(cut))
    tied, missing = ties[0]
    return df.filter(order < F.lit(tied)).unionByName(df.filter(order == F.lit(tied)).limit(missing))


def allot(sizes: Mapping, total: int) -> dict:
    """Shares ``total`` out in proportion to the class sizes: whole parts first, then
    the largest remainders (equal remainders in class order)."""
    rows = sum(sizes.values())
    exact = {s: (total * n) // rows for s, n in sizes.items()}
    left = total - sum(exact.values())
    by_remainder = sorted(sizes, key=lambda s: (-((total * sizes[s]) % rows), s is None, s if s is not None else 0))
    for s in by_remainder[:left]:
        exact[s] += 1
    return exact


def split(
    df: DataFrame, test_size: float, seed: int, key: Key, stratify: str | None = None, max_classes: int = MAX_CLASSES
) -> tuple[DataFrame, DataFrame]:
    """Train and test parts of exact size; ``stratify`` keeps the class shares."""
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")
    hashed = _prepare(df, seed, key, stratify)
    counts = _prefix_counts(hashed)
    sizes = _sizes(counts, stratify or "the table", max_classes)
    wanted = allot(sizes, math.ceil(sum(sizes.values()) * test_size))
    marked = _with_cutoff(hashed, _cutoffs(hashed, counts, wanted, sizes), bool(stratify))
    train, test = marked.filter("__hash > __cut"), marked.filter("__hash <= __cut")
    return _drop_helpers(train), _drop_helpers(test)


def features_target(
    df: DataFrame, target: str, drop: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    return df.drop(target, *drop), df.select(col(target))


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames stacked by column name."""
    return reduce(DataFrame.unionByName, frames)


def downsample_majority(
    df: DataFrame, target: str, seed: int, key: Key, max_classes: int = MAX_CLASSES
) -> DataFrame:
    """Every class cut to the size of the smallest one."""
    hashed = _prepare(df, seed, key, target)
    counts = _prefix_counts(hashed)
    sizes = _sizes(counts, target, max_classes)
    cut = _cutoffs(hashed, counts, {s: min(sizes.values()) for s in sizes}, sizes)
    return _drop_helpers(_with_cutoff(hashed, cut, True).filter("__hash <= __cut"))


def shuffle(df: DataFrame, seed: int, key: Key) -> DataFrame:
    """A repeatable random row order, for exports."""
    return df.orderBy(hash_order(seed, key))


def class_weights(
    df: DataFrame, target: str, name: str = "weight", max_classes: int = MAX_CLASSES
) -> DataFrame:
    """Adds the balanced weight ``rows / (classes * rows of the class)``."""
    sizes = {r[0]: r[1] for r in read_classes(class_counts(df, target), target, max_classes)}
    rows = sum(sizes.values())
    weights = [(s, rows / (len(sizes) * n)) for s, n in sizes.items()]
    return attach_classes(df, target, weights, [T.StructField(name, T.DoubleType())])
