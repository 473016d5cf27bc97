"""Benchmark decontamination: a broadcast set of test windows, a scan of the text's windows, verified hits.

Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. A
window is ``size`` consecutive words of a benchmark item; an item with fewer words,
but not none, is one shorter window. A window number found in the broadcast set is
only a hit when the words themselves are equal.

Defined results: a NULL or word-free text has no words and no hits; a NULL item text
adds no window; a NULL item id adds its windows but no id; repeated items count once;
an empty benchmark hits nothing. Each input row gives one output row, whatever its id,
and is handled by itself: no shuffle, so no key can be hot.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm import words as W
from riskframe.llm.common import plain, stored

WINDOW = 13
#: Least share of hit words, as one in so many, from which a document is contaminated.
ONE_IN = 20
#: Most bytes of benchmark text in one broadcast; a larger benchmark is scanned for in several blocks. What is broadcast is the
#: text, 24 bytes per window and the filters: 110 MB for 16 MB of text in 6.4 bytes a word, 250 MB if all words had one letter.
BLOCK_BYTES = 16 << 20
#: Buckets of benchmark text per block, from which blocks are put together, and longest part of an item, as a share of a block.
FINER = 64

SPAN = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])
MARKS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)
_SPAN_ARROW = pa.struct([("first", pa.int64()), ("last", pa.int64())])
_MARKS_ARROW = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(_SPAN_ARROW))]
)

@dataclass
class _Known:
    """Distinct windows of one length, sorted by number; those of entry e belong to ``owners[first[e]:first[e + 1]]``."""

    numbers: np.ndarray
    begin: np.ndarray  # bytes in the text of all items
    end: np.ndarray
    first: np.ndarray
    owners: np.ndarray
    filter: np.ndarray  # by a number's highest bits
    shift: np.uint64


class WindowSet:
    """Windows of a block of benchmark items: a bit filter, sorted numbers, and the exact words behind each number.

    All of it is flat arrays: the items' words once, 24 bytes per distinct window (4 more for each further item that has it), and
    a filter of 16 to 32 bytes per window, at most 32 MB for each length.
    """

    def __init__(self, items: list[tuple[str | None, str]], size: int = WINDOW) -> None:
        self.items = sorted({item for item, _ in items if item is not None})
        place = {item: k for k, item in enumerate(self.items)}
        owners = np.array([place.get(item, -1) for item, _ in items], np.int32)
        data, offsets = W.text_buffer(pa.array([text for _, text in items], pa.large_string()))
        texts: list[bytes] = []
        found: dict[int, list[tuple[np.ndarray, ...]]] = {}
        base = 0
        for lo, hi in W.pieces(offsets):
            words = W.find_words(data, offsets[lo : hi + 1], W.ALNUM, W.LOWER)
            counts = np.diff(words.first)
            text, begin, end = _joined(data, words)
            stop, n = words.stop, len(words.numbers)
            per_word = np.repeat(np.minimum(counts, size), counts)  # words in a window of its item
            owner = np.repeat(owners[lo:hi], counts)
            for length in np.unique(per_word).tolist():
                at = np.flatnonzero((per_word == length) & (np.arange(n) + length <= stop))
                numbers = W.window_numbers(words.numbers, length)[at]
                ends = end[at + length - 1]
                found.setdefault(length, []).append(
                    (numbers, (begin[at] + base).astype(np.uint32), (ends + base).astype(np.uint32), owner[at])
                )
            texts.append(text)
            base += len(text)
        self.text = b"".join(texts)
        self.known = {length: self._sorted([np.concatenate(c) for c in zip(*parts)]) for length, parts in found.items()}

    def _sorted(self, columns: list[np.ndarray]) -> _Known:
        order = np.argsort(columns[0], kind="stable")
        numbers, begin, end, owner = [c[order] for c in columns]
        new = np.ones(len(numbers), bool)
        for i in (np.flatnonzero(numbers[1:] == numbers[:-1]) + 1).tolist():  # the same words, but for a collision
            new[i] = self.text[begin[i] : end[i]] != self.text[begin[i - 1] : end[i - 1]]
        head, entry = np.flatnonzero(new), np.cumsum(new) - 1
        pairs = np.unique((entry[owner >= 0] << 32) | owner[owner >= 0])
        first = np.searchsorted(pairs >> 32, np.arange(len(head) + 1)).astype(np.uint32)
        bits = min(25, max(12, len(head).bit_length() + 4))
        shift = np.uint64(64 - bits)
        known = np.zeros(1 << bits, bool)
        known[numbers[head] >> shift] = True
        return _Known(numbers[head], begin[head], end[head], first, (pairs & 0xFFFFFFFF).astype(np.int32), known, shift)

    def mark(self, texts: pa.Array) -> list[dict]:
        """For each text: the number of words, and which words lie in a window, of which items."""
        data, offsets = W.text_buffer(texts)
        out = []
        for lo, hi in W.pieces(offsets):
            words = W.find_words(data, offsets[lo : hi + 1], W.ALNUM, W.LOWER)
            spans: dict[int, list[tuple[int, int]]] = {}
            owners: dict[int, set[int]] = {}
            for length, known in self.known.items():
                seen: dict[int, set[int]] = {}
                for at, row, entry in self._hits(data, words, length, known):
                    begin = int(at - words.first[row])
                    spans.setdefault(row, []).append((begin, begin + length - 1))
                    seen.setdefault(row, set()).add(entry)
                for row, entries in seen.items():
                    for e in entries:
                        owners.setdefault(row, set()).update(known.owners[known.first[e] : known.first[e + 1]].tolist())
            for row, count in enumerate(np.diff(words.first)):
                merged = merge_spans(spans.get(row, []))
                out.append(
                    {
                        "n_words": int(count),
                        "n_hit": sum(b - a + 1 for a, b in merged),
                        "items": [self.items[k] for k in sorted(owners.get(row, ()))],
                        "spans": [{"first": a, "last": b} for a, b in merged],
                    }
                )
        return out

    def _hits(self, data: np.ndarray, words: W.Words, length: int, known: _Known) -> Iterator[tuple[int, int, int]]:
        """First word, text and entry of each window of the texts whose words are those of the entry."""
        numbers = W.window_numbers(words.numbers, length)
        at = np.flatnonzero(known.filter[numbers >> known.shift])
        entry = np.searchsorted(known.numbers, numbers[at])
        row = np.searchsorted(words.first, at, "right") - 1
        same = known.numbers[np.minimum(entry, len(known.numbers) - 1)] == numbers[at]
        real = same & (at + length <= words.first[row + 1])
        for a, r, e in zip(at[real].tolist(), row[real].tolist(), entry[real].tolist()):
            phrase = b" ".join(W.LOWER[data[words.starts[k] : words.ends[k]]].tobytes() for k in range(a, a + length))
            while e < len(known.numbers) and known.numbers[e] == numbers[a]:
                if self.text[known.begin[e] : known.end[e]] == phrase:
                    yield a, r, e
                e += 1


def _joined(data: np.ndarray, words: W.Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words, lowered, with a blank behind each, and where each begins and ends in that."""
    lengths = words.ends - words.starts
    begin = np.cumsum(lengths + 1) - lengths - 1
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    text = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
    text[np.repeat(begin, lengths) + inside] = W.LOWER[data[np.repeat(words.starts, lengths) + inside]]
    return text.tobytes(), begin, begin + lengths


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _merge(old: dict | None, new: dict) -> dict:
    if not old:
        return new
    spans = merge_spans([(s["first"], s["last"]) for s in [*old["spans"], *new["spans"]]])
    return {
        "n_words": new["n_words"],
        "n_hit": sum(b - a + 1 for a, b in spans),
        "items": sorted({*old["items"], *new["items"]}),
        "spans": [{"first": a, "last": b} for a, b in spans],
    }


def _marker(windows, earlier: bool):
    def first(texts: pa.Array) -> pa.Array:
        return pa.array(windows.value.mark(texts), _MARKS_ARROW)

    def again(texts: pa.Array, marks: pa.Array) -> pa.Array:
        return pa.array([_merge(o, n) for o, n in zip(marks.to_pylist(), windows.value.mark(texts))], _MARKS_ARROW)

    return F.arrow_udf(again if earlier else first, MARKS)


def mark_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    item_id: str = "item_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    output: str = "marks",
) -> DataFrame:
    """Adds one struct column: n_words, n_hit, items (sorted ids) and spans (first and last hit word).

    The benchmark's size is measured first. It is broadcast whole when it has at most
    ``block_bytes``; otherwise its items, long ones in overlapping parts, are put together to blocks
    of that size (a bucket of parts that is larger is a block of its own), and
    the documents are scanned once per block, with the marks so far written between.
    """
    spark = docs.sparkSession
    items = benchmark.select(plain(item_id).cast("string").alias("item"), plain(text).cast("string").alias("text"))
    items = items.filter(F.col("text").isNotNull()).distinct()
    blocks = _blocks(items, size, block_bytes)
    for number, block in enumerate(blocks):
        windows = spark.sparkContext.broadcast(WindowSet([(r["item"], r["text"]) for r in block.collect()], size))
        inputs = [plain(text).cast("string"), *([plain(output)] if number else [])]
        docs = docs.withColumn(output, _marker(windows, number > 0)(*inputs))
        if number + 1 < len(blocks):
            docs = stored(docs, "marks")
    return docs


def _blocks(items: DataFrame, size: int, block_bytes: int) -> list[DataFrame]:
    """The items (item, text), in tables of at most ``block_bytes`` of text each."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= block_bytes:
        return [items]
    buckets = FINER * -(-total // block_bytes)
    parts = items.mapInArrow(_parts(size, max(1, block_bytes // FINER)), "item string, text string").distinct()
    parts = stored(parts.withColumn("bucket", F.pmod(F.xxhash64("item", "text"), F.lit(buckets))), "benchmark")
    sizes = parts.groupBy("bucket").agg(F.sum(F.octet_length("text")).alias("n")).orderBy("bucket").collect()
    ranges: list[list[int]] = []
    held = 0
    for r in sizes:  # at most ``buckets`` rows
        if not ranges or held + r["n"] > block_bytes:
            ranges.append([r["bucket"], r["bucket"]])
            held = 0
        ranges[-1][1] = r["bucket"]
        held += r["n"]
    return [parts.filter(F.col("bucket").between(low, high)) for low, high in ranges]


def _parts(size: int, part_bytes: int):
    """Items longer than ``part_bytes`` in parts that overlap by ``size - 1`` words, so that no window is lost or new."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item"), batch.column("text")):
                data, offsets = W.text_buffer(pa.array([text.as_py()], pa.large_string()))
                if len(data) <= part_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()], pa.string()), pa.array([text.as_py()])], ["item", "text"])
                    continue
                words = W.find_words(data, offsets, W.ALNUM, W.LOWER)
                n, low, high = len(words.starts), 0, 0
                while high < n:
                    high = int(np.searchsorted(words.ends, words.starts[low] + part_bytes, "right"))
                    high = min(n, max(high, low + size))
                    part = data[words.starts[low] : words.ends[high - 1]].tobytes().decode()
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()], pa.string()), pa.array([part])], ["item", "text"])
                    low = high - size + 1

    return run


def is_contaminated(n_hit: Column, n_words: Column, one_in: int = ONE_IN) -> Column:
    return (n_hit > 0) & (F.lit(one_in) * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", one_in: int = ONE_IN) -> DataFrame:
    """Documents that are not contaminated, with their own columns."""
    marked = mark_contamination(docs, benchmark, text=text, output="__marks")
    bad = is_contaminated(F.col("__marks.n_hit"), F.col("__marks.n_words"), one_in)
    return marked.filter(~bad).drop("__marks")


def _cut(texts: pa.Array, marks: pa.Array) -> pa.Array:
    out = []
    for text, mark in zip(texts.to_pylist(), marks.to_pylist()):
        if text and mark["spans"]:
            places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
            kept, at = [], 0
            for span in mark["spans"]:
                kept.append(text[at : places[span["first"]][0]])
                at = places[span["last"]][1]
            text = "".join([*kept, text[at:]])
        out.append(text)
    return pa.array(out, pa.string())


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """All documents, with the hit words cut from the text; NULL stays NULL."""
    marked = mark_contamination(docs, benchmark, text=text, output="__marks")
    cut = F.arrow_udf(_cut, T.StringType())
    return marked.withColumn(text, cut(plain(text).cast("string"), F.col("__marks"))).drop("__marks")
