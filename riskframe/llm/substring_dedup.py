"""Exact substring deduplication by level-wise doubling.

A word goes when a window of ``size`` consecutive words covers it whose word sequence
also starts anywhere else. Windows are tested at about a quarter of the size, then at
twice that length, and so on up to the size itself; only starts whose shorter windows
were repeated are extended; when none is left, the levels that follow have nothing to count.

At every length but the last, one shorter window stands for a start: of those inside
the full window, the one with the smallest number. Equal full windows have equal
representatives at equal places, so nothing repeated is lost, and a few percent of the
positions are shuffled. What comes back from a count are the representatives that are
*not* repeated: each occurs once, so the count itself carries its place, and a passage
that a third of all documents share is one pre-aggregated row and no join key. The
last length compares 96-bit numbers of the whole windows, not their texts.

Equal texts are brought together first and count with their multiplicity.

Defined results: NULL and word-free texts have no words and lose none; texts of fewer
words than a window lose none; repeated rows repeat each other; ids are passengers,
so NULL and repeated ids give one row per input row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import words as W
from riskframe.llm.common import stored, text_of
from riskframe.llm.packing import joined_buffer, open_groups, packed

WINDOW = 35
TOP32 = np.uint64(32)


def levels_of(size: int) -> list[int]:
    """Window lengths, each at most twice the one before, the last one the full size."""
    out = [size]
    while len(out) < 3 and out[0] > 1:
        out.insert(0, -(-out[0] // 2))
    return out


class Starts:
    """Full-window starts of several texts that are still candidates after some levels."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int) -> None:
        self.words = W.find_words(data, offsets, W.NON_SPACE)
        self.size = size
        n = len(self.words.numbers)
        self.alive = np.zeros(max(0, n - size + 1), bool)
        self.alive[W.window_starts(self.words, size)] = True

    def places(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all windows of this length, and each start's representative among them."""
        numbers = W.window_numbers(self.words.numbers, length)
        inside = self.size - length + 1
        n = len(self.alive)
        if inside == 1 or not n:
            return numbers, np.arange(n)
        out = np.zeros(n, np.int64)
        for low in range(0, n, 1 << 16):
            part = sliding_window_view(numbers[low : min(n, low + (1 << 16)) + inside - 1], inside)
            out[low : low + len(part)] = np.argmin(part, axis=1)
        return numbers, out + np.arange(n)

    def narrow(self, length: int, single: list[np.ndarray | None]) -> None:
        """``single``: per text, the places of this length that are not repeated."""
        alone = np.zeros(len(self.words.numbers), bool)
        for first, places in zip(self.words.first, single):
            if places is not None and len(places):
                alone[first + places] = True
        _, of = self.places(length)
        self.alive &= ~alone[of]

    def emitted(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number, second number, text and place of the representatives of the living starts."""
        numbers, of = self.places(length)
        chosen = np.unique(of[self.alive])
        text = np.searchsorted(self.words.first, chosen, "right") - 1
        second = W.window_numbers(self.words.numbers, length, 1) if length == self.size else numbers
        return numbers[chosen], second[chosen] >> TOP32, text, chosen - self.words.first[text]

    def covered(self) -> np.ndarray:
        edge = np.zeros(len(self.words.numbers) + 1, np.int64)
        at = np.flatnonzero(self.alive)
        np.add.at(edge, at, 1)
        np.subtract.at(edge, at + self.size, 1)
        return np.cumsum(edge[:-1]) > 0


def _singles(batch: pa.RecordBatch, column: str, low: int, high: int) -> list[np.ndarray | None]:
    return [None if v.as_py() is None else np.array(v.as_py(), np.int64) for v in batch.column(column)[low:high]]


def _first_places(size: int, length: int):
    """Representatives of the shortest windows of all rows: number, text key, place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_buffer(batch.column("text"))
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            for low, high in W.pieces(offsets):
                number, _, text, place = Starts(data, offsets[low : high + 1], size).emitted(length)
                row = text + low
                loc = (k2[row].astype(np.int64) << 32) | place
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number.view(np.int64)), pa.array(k1[row]), pa.array(loc)], ["h", "k1", "loc"]
                )

    return run


def _first_narrowing(size: int, length: int):
    """Keeps the packed text where candidates are left, and settles the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in open_groups(batch, "z"):
                starts = Starts(*joined_buffer(texts), size)
                singles = [None if s is None else s & 0xFFFFFFFF for s in _singles(batch, "single", low, high)]
                starts.narrow(length, singles)
                alive = _alive_texts(starts)
                n_words = np.diff(starts.words.first)
                part = batch.slice(low, high - low)
                sums = [
                    None if a else hashlib.sha256(b" ".join(t.split())).hexdigest() for a, t in zip(alive, texts)
                ]
                z = pa.array([p.as_py() if a else None for a, p in zip(alive, part.column("z"))], pa.binary())
                kept = [s if a else None for a, s in zip(alive, singles)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("k1"), part.column("k2"), part.column("m"), pa.array(n_words, pa.int64()),
                     pa.array(sums, pa.string()), z, pa.array(kept, pa.list_(pa.int64()))],
                    ["k1", "k2", "m", "n_words", "kept_sha256", "z", "s0"],
                )

    return run


def _alive_texts(starts: Starts) -> list[bool]:
    at = np.flatnonzero(starts.alive)
    text = np.searchsorted(starts.words.first, at, "right") - 1
    return (np.bincount(text, minlength=len(starts.words.first) - 1) > 0).tolist()


def _narrowed(batch: pa.RecordBatch, low: int, high: int, texts: list[bytes], size: int, done: list[int]) -> Starts:
    starts = Starts(*joined_buffer(texts), size)
    for i, length in enumerate(done):
        starts.narrow(length, _singles(batch, f"s{i}", low, high))
    return starts


def _places(size: int, done: list[int], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            weights = np.minimum(batch.column("m").to_numpy(zero_copy_only=False), 2)
            for low, high, texts in open_groups(batch, "z"):
                number, second, text, place = _narrowed(batch, low, high, texts, size, done).emitted(length)
                row = text + low
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number.view(np.int64)), pa.array(second.astype(np.int64)), pa.array(ids[row]),
                     pa.array(place), pa.array(weights[row])],
                    ["h", "h2", "id", "place", "w"],
                )

    return run


def _removal(size: int, levels: list[int], with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in open_groups(batch, "z"):
                starts = _narrowed(batch, low, high, texts, size, levels)
                gone = starts.covered()
                removed, sums, kept_texts = [], [], []
                for i, text in enumerate(texts):
                    mask = ~gone[starts.words.first[i] : starts.words.first[i + 1]]
                    kept = b" ".join(compress(text.split(), mask))
                    removed.append(int(len(mask) - mask.sum()))
                    sums.append(hashlib.sha256(kept).hexdigest())
                    kept_texts.append(kept.decode() if with_text and removed[-1] else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k1").slice(low, high - low), batch.column("k2").slice(low, high - low),
                     pa.array(np.diff(starts.words.first), pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(sums, pa.string()), pa.array(kept_texts, pa.string())],
                    ["k1", "k2", "n_words", "n_removed", "kept_sha256", "kept_text"],
                )

    return run


def _single_places(places: DataFrame) -> DataFrame:
    """Per text id, the places whose window occurs once."""
    counts = places.groupBy("h", "h2").agg(
        F.sum("w").alias("n"), F.min("id").alias("id"), F.min("place").alias("place")
    )
    return counts.filter(F.col("n") == 1).groupBy("id").agg(F.collect_list("place").alias("single"))


def repeated_text(docs: DataFrame, size: int = WINDOW, text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per distinct text: k1, k2 (its key), n_words, n_removed, kept_sha256, kept_text.

    ``kept_text`` is filled on request and where something went: the kept words with one blank between.
    """
    levels = levels_of(size)
    base = text_of(docs, doc_id=text, text=text).select(*text_key("text"), "text")
    first = base.mapInArrow(_first_places(size, levels[0]), "h long, k1 long, loc long")
    counts = first.groupBy("h").agg(F.count("*").alias("n"), F.min("k1").alias("k1"), F.min("loc").alias("loc"))
    single = counts.filter(F.col("n") == 1).withColumn("k2", F.shiftright("loc", 32).cast("int"))
    single = single.groupBy("k1", "k2").agg(F.collect_list("loc").alias("single"))
    texts = base.select("k1", "k2", packed("text").alias("z")).groupBy("k1", "k2").agg(F.first("z").alias("z"), F.count("*").alias("m"))
    settled = texts.join(single, ["k1", "k2"], "left").mapInArrow(
        _first_narrowing(size, levels[0]),
        "k1 long, k2 int, m long, n_words long, kept_sha256 string, z binary, s0 array<long>",
    )
    settled = stored(settled.withColumn("id", F.monotonically_increasing_id()), "repeats")
    result = ["k1", "k2", "n_words", "n_removed", "kept_sha256", "kept_text"]
    done = settled.filter(F.col("z").isNull()).select(
        "k1", "k2", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256",
        F.lit(None).cast("string").alias("kept_text"),
    )
    left = settled.filter(F.col("z").isNotNull()).drop("kept_sha256", "n_words")
    for i, length in enumerate(levels[1:], 1):
        found = left.mapInArrow(_places(size, levels[:i], length), "h long, h2 long, id long, place long, w long")
        left = left.join(_single_places(found), "id", "left").withColumnRenamed("single", f"s{i}")
        if length < size:
            left = stored(left, "repeats")
    last = left.mapInArrow(
        _removal(size, levels, with_text),
        "k1 long, k2 int, n_words long, n_removed long, kept_sha256 string, kept_text string",
    )
    return done.select(*result).unionByName(last.select(*result))


def text_key(text: str) -> list:
    """A 96-bit key of the text in two fixed-width columns."""
    return [F.xxhash64(text).alias("k1"), F.hash(text).alias("k2")]


def count_repeats(docs: DataFrame, size: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per input row: doc_id, n_words, n_removed, kept_sha256."""
    rows = text_of(docs, doc_id, text).select("doc_id", *text_key("text"))
    found = repeated_text(docs, size, text).drop("kept_text")
    return rows.join(found, ["k1", "k2"]).select("doc_id", "n_words", "n_removed", "kept_sha256")


def remove_repeats(docs: DataFrame, size: int = WINDOW, text: str = "text") -> DataFrame:
    """All documents; where something repeats, the text is the kept words with one blank between."""
    names = docs.columns
    found = repeated_text(docs, size, text, with_text=True).select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("kept_text").alias("__kept")
    )
    key1, key2 = text_key(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    keyed = docs.withColumns({"__k1": key1, "__k2": key2})
    joined = keyed.join(found.filter(F.col("__kept").isNotNull()), ["__k1", "__k2"], "left")
    return joined.withColumn(text, F.coalesce("__kept", f"`{text}`")).select(*[f"`{n}`" for n in names])
