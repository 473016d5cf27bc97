"""N-gram Jaccard self-join with Bayesian candidate pruning.

Documents are sets of five-word shingles (64-bit numbers). MinHash bands put documents
that could be similar into common buckets; each bucket is linked as a star, and the
connected components of the stars hold every candidate pair without listing one. A component is
cut into blocks, each pair of blocks is one group, and inside a group MinHash values are
compared a few at a time: a pair is dropped as soon as the posterior probability of
reaching the threshold, given the matches so far and a uniform prior, falls below
``TOLERANCE``. What is left is verified exactly on the shingle sets. Only counts and a
spanning star per group leave it, so a group of n near copies gives n rows, not n^2.

Equal shingle sets are one class and travel once, however many copies there are. With
40 bands of 5 values a pair exactly at 0.8 shares no bucket with probability 1.3e-7, and
is pruned wrongly with probability below 1e-8.

Defined results: a text of one to four words is one shingle of all its words; NULL
and word-free texts link with nothing and stay; repeated rows link with each other; rows
with a NULL id link as others do, and if a whole group has no id, its class is NULL
and all of it stays; rows that share a group's least id all stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import words as W
from riskframe.llm.common import plain, releasing, stored, text_of
from riskframe.llm.components import connected_components
from riskframe.llm.packing import joined_buffer, opened, packed

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 5
TOLERANCE = 1e-9
#: Numbers of MinHash values after which pairs are judged.
STEPS = (16, 32, 64, 128, BANDS * ROWS)
BLOCK_ROWS = 512
U64 = np.uint64
_FACTORS = W.mix(np.arange(1001, 1001 + BANDS * ROWS, dtype=U64)) | U64(1)


def posterior(matches: int, compared: int, threshold: float = THRESHOLD) -> float:
    """Probability that the similarity is at least the threshold, given the matches and a uniform prior."""
    n = compared + 1
    return sum(comb(n, k) * threshold**k * (1 - threshold) ** (n - k) for k in range(matches + 1))


def least_matches(compared: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """The fewest matches at which a pair is kept."""
    return next(m for m in range(compared + 1) if posterior(m, compared, threshold) >= tolerance)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle numbers of each text (sorted), and where each text's begin (one more at the end)."""
    words = W.find_words(data, offsets, W.ALNUM, W.LOWER)
    numbers = W.window_numbers(words.numbers, SHINGLE)
    at = W.window_starts(words, SHINGLE)
    text = np.searchsorted(words.first, at, "right") - 1
    found = [numbers[at]]
    owner = [text]
    counts = np.diff(words.first)
    for length in range(1, SHINGLE):  # short texts
        short = np.flatnonzero(counts == length)
        if len(short):
            found.append(W.window_numbers(words.numbers, length)[words.first[short]])
            owner.append(short)
    value, text = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[fresh], text[fresh]
    return value, np.searchsorted(text, np.arange(len(offsets)))


def signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values, one row per text that has shingles."""
    full = first[:-1][np.diff(first) > 0]
    out = np.zeros((len(full), BANDS * ROWS), U64)
    if len(full):
        for k, factor in enumerate(_FACTORS):
            out[:, k] = np.minimum.reduceat(values * factor, full)
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: a 128-bit key of its shingle set, and its band numbers."""
    for batch in batches:
        data, offsets = W.text_buffer(batch.column("text"))
        for low, high in W.pieces(offsets):
            values, first = shingle_sets(data, offsets[low : high + 1])
            sizes = np.diff(first)
            full = sizes > 0
            marks = signatures(values, first)
            bands = np.zeros((len(marks), BANDS), U64)
            for b in range(BANDS):
                row = np.full(len(marks), b + 1, U64)
                for k in range(b * ROWS, (b + 1) * ROWS):
                    row = W.mix(row * U64(0x9E3779B97F4A7C15) + marks[:, k])
                bands[:, b] = row
            keys = np.zeros((2, high - low), U64)
            if len(marks):
                starts = first[:-1][full]
                keys[0, full] = np.add.reduceat(W.mix(values), starts)
                keys[1, full] = np.add.reduceat(W.mix(values ^ U64(0x5851F42D4C957F2D)), starts)
            ends = np.concatenate([[0], np.cumsum(np.where(full, BANDS, 0))]).astype(np.int32)
            part = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(keys[0].view(np.int64)),
                 pa.array(keys[1].view(np.int64)), pa.array(sizes.astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel().view(np.int64)))],
                ["doc_id", "k1", "k2", "c1", "c2", "n_shingles", "bands"],
            )


def _pairs(marks_a: np.ndarray, marks_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, same: bool, cuts):
    """Pairs of rows that survive the size bound and the pruning."""
    small, large = np.minimum.outer(sizes_a, sizes_b), np.maximum.outer(sizes_a, sizes_b)
    open_ = 5 * small >= 4 * large
    if same:
        open_ &= np.triu(np.ones(open_.shape, bool), 1)
    left, right = np.nonzero(open_)
    hits, done = np.zeros(len(left), np.int64), 0
    for step, least in zip(STEPS, cuts):
        for k in range(done, step):
            hits += marks_a[left, k] == marks_b[right, k]
        alive = hits >= least
        left, right, hits, done = left[alive], right[alive], hits[alive], step
    return left, right


def _verified(left, right, codes, first, first_b):
    """The pairs whose exact similarity reaches the threshold; codes are dense shingle numbers."""
    sizes = np.diff(first)
    mark = np.zeros(int(codes.max()) + 1 if len(codes) else 1, bool)
    good = np.zeros(len(left), bool)
    bounds = np.searchsorted(left, np.arange(len(sizes) + 1))
    for i in np.unique(left):
        low, high = bounds[i], bounds[i + 1]
        own = codes[first[i] : first[i + 1]]
        mark[own] = True
        others = right[low:high] + first_b
        lengths = sizes[others]
        begin = np.cumsum(lengths) - lengths
        at = np.repeat(first[others] - begin, lengths) + np.arange(int(lengths.sum()))
        shared = np.add.reduceat(mark[codes[at]].astype(np.int64), begin)
        good[low:high] = 9 * shared >= 4 * (len(own) + lengths)
        mark[own] = False
    return left[good], right[good]


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least reachable row number for each of n rows, given edges."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(rows: list[tuple[int, int, int, bytes]], cuts) -> pa.RecordBatch | None:
    """Links among the rows of one group. A row: id, copies, side (0 and 1 are compared, 2 with itself), packed text."""
    rows.sort(key=lambda r: (r[2], r[0]))
    ids, copies, side = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    values, first = shingle_sets(*joined_buffer(opened([r[3] for r in rows])))
    marks, sizes = signatures(values, first), np.diff(first)
    codes = np.unique(values, return_inverse=True)[1]
    same = bool(side[0] == 2)
    cut = 0 if same else int(np.searchsorted(side, 1))
    top = len(rows) if same else cut
    left, right = _pairs(marks[:top], marks[cut:], sizes[:top], sizes[cut:], same, cuts)
    left, right = _verified(left, right, codes, first, cut)
    right = right + cut
    if not len(left):
        return None
    links = np.bincount(left, copies[right], len(rows)) + np.bincount(right, copies[left], len(rows))
    root = roots_of(len(rows), left, right)
    linked = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[linked]), pa.array(links[linked].astype(np.int64)), pa.array(ids[root[linked]])],
        ["id", "links", "root"],
    )


def _compare_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by group; a group has at most two blocks of rows."""
    cuts = [least_matches(n) for n in STEPS]
    held, of = [], None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("component", "i", "j", "id", "n", "side", "z")]
        for component, i, j, *row in zip(*columns):
            if (component, i, j) != of:
                if len(held) > 1 and (out := _compare(held, cuts)):
                    yield out
                held, of = [], (component, i, j)
            held.append(tuple(row))
    if len(held) > 1 and (out := _compare(held, cuts)):
        yield out


def _blocks(members: DataFrame, block_rows: int) -> DataFrame:
    """Adds each member's group keys (i <= j) and its side in the group."""
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    cut = members.join(sizes, "component").withColumn("blocks", F.ceil(F.col("size") / block_rows).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cut.select(
        "component",
        "id",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )


def jaccard_join(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Per input row: doc_id, k1, k2 (its text's key), n_links, class_id (least id reachable) and kept."""
    keyed = text_of(docs, doc_id, text).select(
        "doc_id", F.xxhash64("text").alias("k1"), F.hash("text").alias("k2"), "text"
    )
    kind = keyed.schema["doc_id"].dataType.simpleString()
    described = stored(
        keyed.mapInArrow(
            releasing(_describe), f"doc_id {kind}, k1 long, k2 int, c1 long, c2 long, n_shingles long, bands array<long>"
        ),
        "shingles",
    )
    rows = described.select("doc_id", "k1", "k2", "c1", "c2", "n_shingles")
    classes = (
        described.filter("n_shingles > 0")
        .groupBy("c1", "c2")
        .agg(
            F.min("doc_id").alias("least"), F.count("*").alias("n"),
            F.min(F.struct("k1", "k2")).alias("of"), F.first("bands").alias("bands"),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )
    classes = stored(classes, "classes")
    band_rows = classes.select("id", F.explode("bands").alias("band"))
    centres = band_rows.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    stars = band_rows.join(centres, "band").filter("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b"))
    candidates = stored(connected_components(stars).withColumnRenamed("node", "id"), "candidates")

    keys = classes.select("id", "n", F.col("of.k1").alias("k1"), F.col("of.k2").alias("k2"))
    grouped = keys.join(candidates, "id").select("id", "n", "k1", "k2")
    texts = keyed.select("k1", "k2", packed("text").alias("z")).groupBy("k1", "k2").agg(F.first("z").alias("z"))
    held = stored(grouped.join(texts, ["k1", "k2"]).select("id", "n", "z"), "texts")
    work = _blocks(candidates, block_rows).join(held, "id")
    work = work.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    found = stored(work.mapInArrow(releasing(_compare_groups), "id long, links long, root long"), "links")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = (
        classes.select("c1", "c2", "id", "n", "least")
        .join(links, "id", "left")
        .join(groups.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    named = stored(named, "named")
    class_ids = named.groupBy("component").agg(F.min("least").alias("class_id"))
    facts = named.join(class_ids, "component").select(
        "c1", "c2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "class_id"
    )
    alone = rows.filter("n_shingles = 0").select(
        "doc_id", "k1", "k2", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id")
    )
    linked = rows.filter("n_shingles > 0").join(facts, ["c1", "c2"]).select("doc_id", "k1", "k2", "n_links", "class_id")
    stays = F.col("class_id").isNull() | (F.col("n_links") == 0) | F.col("doc_id").eqNullSafe(F.col("class_id"))
    return alone.unionByName(linked).withColumn("kept", stays)


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with all columns, one of each group of linked ones (that with the least id)."""
    names = docs.columns
    gone = jaccard_join(docs, doc_id, text).filter("not kept").select("doc_id", "k1", "k2").distinct()
    gone = gone.select(*[F.col(c).alias(f"__{c}") for c in gone.columns])
    content = F.coalesce(plain(text).cast("string"), F.lit(""))
    match = (
        plain(doc_id).eqNullSafe(F.col("__doc_id"))
        & (F.xxhash64(content) == F.col("__k1"))
        & (F.hash(content) == F.col("__k2"))
    )
    return docs.join(gone, match, "left_anti").select(*[plain(n) for n in names])
