"""Runs of words that repeat with a period, found with longest common extensions (LCE).

Words of the texts of a unit become numbers, one after the other, with a number of its own behind each text.
How far the words from two places agree is asked of a difference cover: a set of residues modulo ``MODULUS`` such that any
two places reach, within fewer than ``MODULUS`` words, two places that both lie on the cover. Only suffixes that
begin on the cover are sorted; a question compares the few words before the cover is reached, and
the rest is the minimum of a range of common prefixes of neighbours in that order (a sparse table).

A run of period q and at least ``exponent`` times its length holds a long enough stretch of words that equal the ones q further,
so a grid of places as far apart as that stretch hits each such run. All grids of a text together have about
n log n / 3 places. From a place the stretch is extended to the right by one question, to the left by a
search of halving steps, at most to the next place of the grid. A stretch found for a multiple of the period has
the same words as that of the period itself, which alone stays.

Every text is handled by itself in one task; a unit is some texts of ``UNIT_WORDS`` words or one longer text, and needs
memory in proportion to its words. No shuffle, so no key can be hot.

Defined results: a NULL text has no words and no runs and collapses to an empty text; other columns are passengers, NULL and
repeated ones too; overlapping runs are all listed, and a word goes if any of them contains it after its first period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import plain, text_of

#: Every difference modulo 31 is one of two of these residues (a perfect difference set: 6 * 5 = 30 differences).
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
MIN_WORDS, EXPONENT = 6, 4
UNIT_WORDS = 200_000
#: Grid places that are looked at together.
TOGETHER = 1 << 20

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_RUN_ARROW = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def _cover_steps() -> np.ndarray:
    """For two residues, how many words further both places are on the cover."""
    on = np.zeros(MODULUS, bool)
    on[list(COVER)] = True
    steps = np.full((MODULUS, MODULUS), -1)
    a, b = np.meshgrid(np.arange(MODULUS), np.arange(MODULUS), indexing="ij")
    for d in reversed(range(MODULUS)):
        steps[on[(a + d) % MODULUS] & on[(b + d) % MODULUS]] = d
    return steps


_ON_COVER = np.isin(np.arange(MODULUS), COVER)
_STEPS = _cover_steps()


def _refine(rank: np.ndarray, key: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Orders suffixes of equal rank by their keys, in place; returns those that still share a rank.

    A rank is the number of smaller suffixes, so that other groups keep theirs."""
    by = np.lexsort((key, rank[open_]))
    suffixes, keys = open_[by], key[by]
    old = rank[suffixes]
    fresh = np.concatenate([[True], old[1:] != old[:-1]])
    parts = fresh | np.concatenate([[True], keys[1:] != keys[:-1]])
    place = np.arange(len(by))
    start = np.maximum.accumulate(np.where(parts, place, 0))
    rank[suffixes] = old + start - np.maximum.accumulate(np.where(fresh, place, 0))
    sizes = np.bincount(start, minlength=len(by))[start]
    return suffixes[sizes > 1]


class Extensions:
    """LCE questions over a sequence of numbers in which every text ends with a number of its own."""

    def __init__(self, x: np.ndarray) -> None:
        self.n = len(x)
        self.x = np.concatenate([x, np.zeros(2 * MODULUS, x.dtype)])
        self.places = np.flatnonzero(_ON_COVER[np.arange(self.n) % MODULUS])
        self.index = np.full(self.n, -1, np.int32)
        self.index[self.places] = np.arange(len(self.places), dtype=np.int32)
        self._sort()

    def _sort(self) -> None:
        m = len(self.places)
        rank, open_ = np.zeros(m, np.int64), np.arange(m)
        bits = max(1, int(self.x.max()).bit_length())
        together = max(1, 62 // bits)
        for low in range(0, MODULUS, together):
            key = np.zeros(len(open_), np.int64)
            for t in range(low, min(low + together, MODULUS)):
                key = key << bits | self.x[self.places[open_] + t]
            open_ = _refine(rank, key, open_)
            if not len(open_):
                break
        self.levels = [rank.astype(np.int32)]  # equal if the first MODULUS * 2^k words are
        reach = MODULUS
        while len(open_):
            at = self.places[open_] + reach
            key = np.where(at < self.n, rank[self.index[np.minimum(at, self.n - 1)]], -1)
            open_ = _refine(rank, key, open_)
            self.levels.append(rank.astype(np.int32))
            reach *= 2
        self.rank = self.levels[-1]
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        self.table = [self._neighbours(self.places[order]).astype(np.int32)]
        while 2 << len(self.table) - 1 <= max(m - 1, 0):
            last, half = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[:-half], last[half:]))
        del self.levels

    def _neighbours(self, order: np.ndarray) -> np.ndarray:
        """Common prefixes of suffixes that follow each other in the order."""
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        some = np.arange(len(a))
        for k in reversed(range(len(self.levels))):
            level, inside = self.levels[k], np.maximum(a, b) < self.n
            same = some[inside]
            same = same[level[self.index[a[same]]] == level[self.index[b[same]]]]
            step = MODULUS << k
            a[same] += step
            b[same] += step
            common[same] += step
        return common + self._compare(a, b, np.full(len(a), MODULUS))

    def _compare(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words agree, one by one, up to the given number (below ``MODULUS`` or that)."""
        found = most.copy()
        left = np.arange(len(a))
        for t in range(MODULUS):
            left = left[most[left] > t]
            differ = self.x[a[left] + t] != self.x[b[left] + t]
            found[left[differ]] = t
            left = left[~differ]
            if not len(left):
                break
        return found

    def ask(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree from two different places of the same text."""
        steps = _STEPS[a % MODULUS, b % MODULUS]
        found = self._compare(a, b, steps)
        far = np.flatnonzero(found == steps)
        if len(far):
            r, s = self.rank[self.index[a[far] + steps[far]]], self.rank[self.index[b[far] + steps[far]]]
            low, high = np.minimum(r, s).astype(np.int64), np.maximum(r, s).astype(np.int64)
            level = np.frexp(high - low)[1] - 1
            for k in np.unique(level):
                own = level == k
                row = self.table[k]
                found[far[own]] += np.minimum(row[low[own]], row[high[own] - (1 << k)])
        return found


def _grid(first: np.ndarray, lengths: np.ndarray, shortest: int, exponent: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Grid places of all periods of all texts: text, period, stretch, place."""
    periods = np.where(lengths >= shortest, lengths // exponent, 0)
    for lo, hi in _slices(periods):
        text = np.repeat(np.arange(lo, hi), periods[lo:hi])
        ends = np.cumsum(periods[lo:hi])
        period = np.arange(len(text)) - np.repeat(ends - periods[lo:hi], periods[lo:hi]) + 1
        stretch = np.maximum(shortest, exponent * period) - period
        counts = -(-(lengths[text] - period) // stretch)
        for low, high in _slices(counts):
            own = np.repeat(np.arange(low, high), counts[low:high])
            step = np.arange(len(own)) - np.repeat(np.cumsum(counts[low:high]) - counts[low:high], counts[low:high])
            yield text[own], period[own], stretch[own], first[text[own]] + step * stretch[own]


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``TOGETHER`` in all, or of one row."""
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + TOGETHER, "right")))
        yield low, high
        low = high


def runs_of(
    x: np.ndarray, first: np.ndarray, lengths: np.ndarray, shortest: int = MIN_WORDS, exponent: int = EXPONENT
) -> tuple[np.ndarray, ...]:
    """Text, start (in its text), length and period of all runs, sorted so.

    ``x`` are positive numbers of the words; text t has ``lengths[t]`` of them from ``first[t]`` on, and one more that
    occurs nowhere else behind them.
    """
    lce: Extensions | None = None
    found: list[tuple[np.ndarray, ...]] = []
    for text, period, stretch, place in _grid(first, lengths, shortest, exponent):
        hit = np.flatnonzero(x[place] == x[place + period])
        if not len(hit):
            continue
        text, period, stretch, place = text[hit], period[hit], stretch[hit], place[hit]
        back = np.minimum(place - first[text], stretch)
        known, left = np.full(len(hit), -1), np.arange(len(hit))
        for t in range(1, 9):  # most stretches end within a few words
            at = np.maximum(place[left] - t, 0)
            ended = (back[left] < t) | (x[at] != x[at + period[left]])
            known[left[ended]] = t - 1
            left = left[~ended]
        lce = lce or Extensions(x)
        ahead = lce.ask(place, place + period)
        left = left[ahead[left] + back[left] >= stretch[left]]
        known[left] = _reach_back(lce, place[left], period[left], back[left])
        keep = (known >= 0) & (known < stretch) & (known + ahead >= stretch)
        known, ahead, place, period, text = known[keep], ahead[keep], place[keep], period[keep], text[keep]
        found.append((text, place - known - first[text], known + ahead + period, period))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    text, start, length, period = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    new = np.ones(len(text), bool)  # of the same words, the least period
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[new], start[new], length[new], period[new]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def _reach_back(lce: Extensions, place: np.ndarray, period: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words before the places, at most so many, equal the ones a period further."""
    low, high = np.zeros(len(place), np.int64), most.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        at = place - middle
        enough = lce.ask(at, at + period) >= middle
        low, high = np.where(enough, middle, low), np.where(enough, high, middle - 1)
    return low


def _units(texts: list[str]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of texts, some ``UNIT_WORDS`` at a time, with the number of the first text."""
    low, held, total = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.encode().split())
        total += len(held[-1])
        if total >= UNIT_WORDS:
            yield low, held
            low, held, total = i + 1, [], 0
    if held:
        yield low, held


def runs_of_words(texts: list[list[bytes]], shortest: int = MIN_WORDS, exponent: int = EXPONENT) -> tuple[np.ndarray, ...]:
    """Text, start, length and period of all runs of several texts."""
    lengths = np.array([len(w) for w in texts], np.int64)
    first = np.cumsum(lengths + 1) - lengths - 1
    number: dict[bytes, int] = {}
    x = np.empty(int((lengths + 1).sum()), np.int64)
    for words, at in zip(texts, first.tolist()):
        x[at : at + len(words)] = [number.setdefault(w, len(number) + 1) for w in words]
    x[first + lengths] = len(number) + 1 + np.arange(len(texts))
    return runs_of(x, first, lengths, shortest, exponent)


def _find(shortest: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in _units(batch.column("text").to_pylist()):
                text, *columns = runs_of_words(texts, shortest, exponent)
                bounds = np.searchsorted(text, np.arange(len(texts) + 1))
                collapsed = []
                for words, a, b in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist()):
                    if a < b:
                        start, length, period = (c[a:b] for c in columns)
                        edge = np.bincount(start + period, minlength=len(words) + 1)
                        edge = edge - np.bincount(start + length, minlength=len(words) + 1)
                        words = [w for w, over in zip(words, np.cumsum(edge).tolist()) if not over]
                    collapsed.append(b" ".join(words).decode())
                runs = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_RUN_ARROW))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs)
                n = pa.array([len(w) for w in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(low, len(texts)), n, lists, pa.array(collapsed, pa.string())],
                    ["row", "n_words", "runs", "collapsed"],
                )

    return run


def find_runs(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    shortest: int = MIN_WORDS,
    exponent: int = EXPONENT,
) -> DataFrame:
    """The kept columns, n_words, runs (start, length and period, by start, then period) and collapsed.

    ``exponent`` is the least number of periods in a run, from 2 on. ``collapsed`` is the text without what runs repeat.
    """
    if exponent < 2 or shortest < exponent:
        raise ValueError("runs have at least two periods, and their least length as many words")
    row = F.struct(*[plain(c).alias(f"c{i}") for i, c in enumerate(keep)])
    slim = text_of(docs.select(row.alias("row"), plain(text).alias("text")), "row").withColumnRenamed("doc_id", "row")
    out = T.StructType().add("row", slim.schema["row"].dataType).add("n_words", "long")
    found = slim.mapInArrow(_find(shortest, exponent), out.add("runs", T.ArrayType(RUN)).add("collapsed", "string"))
    return found.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)], "n_words", "runs", "collapsed")


def most_repeated(runs: str = "runs") -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first, then that of the least period."""
    more = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    # a plain maximum of the quotient would round
    return F.reduce(runs, F.get(F.col(runs), F.lit(0)), lambda best, r: F.when(more(best, r), r).otherwise(best))


def repeat_words(text: str, number: Column) -> Column:
    """The text's words with a part repeated, as the number's digits say: a known case for tests of whole tables.

    Of a number h, g = h // 10; if h % 10 = 0, every word i from a = g % n on becomes word a + (i - a) % p,
    p = 1 + (n - a) // (3 + g % 8). Other texts, and those whose number is NULL, stay as they are.
    """

    def repeat(texts: pa.Array, numbers: pa.Array) -> pa.Array:
        out = []
        for t, h in zip(texts.to_pylist(), numbers.to_pylist()):
            words = t.encode().split() if t and h is not None and h % 10 == 0 else []
            if words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                t = b" ".join([*words[:a], *(words[a + i % p] for i in range(n - a))]).decode()
            out.append(t)
        return pa.array(out, pa.string())

    return F.arrow_udf(repeat, T.StringType())(plain(text), number)
