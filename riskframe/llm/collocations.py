"""Phrase collocations: how much more often words follow each other than chance would have it.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and pieces into words at blanks and tabs. Every
n-gram within a piece gets a fingerprint from prefix polynomials over its words' polynomials (Rabin-Karp),
mixed with its group (language). Fingerprints are counted level by level: words first, then pairs
whose words are frequent, then longer phrases whose pairs are all frequent. Their counts per block of text meet in a shuffle,
many of them in a row, four bytes each beside the bits that say in which part of all fingerprints they are counted.

A fingerprint only says where to look. What comes back from a level is a bit filter of fixed size over the
frequent fingerprints, so its broadcast does not grow with the data; a full filter lets more through and changes no result.
A last reading follows, block by block, the pointer of each fingerprint that passes (the place of its first
occurrence), compares every other occurrence with the text there, byte by byte, and gives each different text a
row of its own; a task hands on each text once, packed by parts of all texts. Counts are summed by text, so fingerprints that collide cannot add up, and only phrases
that are frequent, or collide with one, are ever written out as text.

Candidates are cut after every word into two phrases, whose counts are joined; scores are exact (whole numbers of up to 38 digits).
The best of each group are chosen in two steps, salted first, so a hot group never meets in one task.

Defined results: a NULL text has no words; a NULL group is ``und``, as is that name itself; repeated rows count each; an empty table,
or one without frequent phrases, gives no rows. A very long text is worked on in parts that end between pieces.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm import words as W
from riskframe.llm.common import clean_text, plain, release_memory, stored

MOST_WORDS = 5
LEAST_COUNT = 100
TOP = 2000
SCALE = 1000
UNKNOWN = "und"
#: Bits of a filter of frequent fingerprints (8 MB). A larger one lets less through on larger data, with the same result.
FILTER_BITS = 26
#: A fingerprint is the part it is counted in, and 32 bits more.
PART_BITS = 12
FINGERPRINT_BITS = PART_BITS + 32
#: Bits in each row of the filter's table, as Spark's bitmap functions make them.
_ROW_BITS = 1 << 15
BLOCK_BYTES = 4 << 20
#: Distinct fingerprints that a task gathers before it hands them on.
GATHERED = 2_000_000
#: Phrases whose counts a task holds before it hands them on.
HELD_PHRASES = 400_000
#: Parts that phrases are dealt to; a task adds up those of its parts, of which only phrases that may be frequent are left.
PHRASE_PARTS = 4096
SALTS = 64

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_WORD = ~_BREAK
_WORD[list(b" \t")] = False


@dataclass
class Block:
    """Words of some pieces of text: their bytes, numbers, groups, and the piece that each belongs to."""

    data: np.ndarray
    words: W.Words
    piece: np.ndarray
    group: np.ndarray  # of each word, as a place in ``names``
    names: list[str]

    def places(self, length: int) -> np.ndarray:
        """Words at which so many words of one piece begin."""
        n = len(self.piece) - length + 1
        return np.flatnonzero(self.piece[: max(n, 0)] == self.piece[length - 1 :]) if n > 0 else np.zeros(0, np.int64)

    @functools.cached_property
    def salts(self) -> np.ndarray:
        """A number per word that stands for its group."""
        buffer, offsets = W.text_buffer(pa.array(self.names))
        whole = np.ones(256, bool)
        numbers = [W.find_words(buffer, offsets[i : i + 2], whole).numbers for i in range(len(self.names))]
        return W.mix(np.array([n[0] if len(n) else 0 for n in numbers], W.U64))[self.group]

    def fingerprints(self, length: int) -> np.ndarray:
        """Of the words from each place on, whatever pieces they belong to."""
        numbers = W.window_numbers(self.words.numbers, length)
        return W.mix(numbers ^ self.salts[: len(numbers)]) >> W.U64(64 - FINGERPRINT_BITS)


def _parts(data: np.ndarray, offsets: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of texts, long ones in parts that end behind a break, and the text that each part is of."""
    bounds, owner = [], []
    for text in range(len(offsets) - 1):
        at, end = int(offsets[text]), int(offsets[text + 1])
        while end - at > limit:
            reach, size = at + limit, limit
            breaks = np.flatnonzero(_BREAK[data[at:reach]])
            while not len(breaks) and reach < end:
                size *= 2
                reach = min(end, at + size)
                breaks = np.flatnonzero(_BREAK[data[at:reach]])
            if not len(breaks):
                break
            bounds.append(at)
            owner.append(text)
            at += int(breaks[-1]) + 1
        bounds.append(at)
        owner.append(text)
    return np.array([*bounds, int(offsets[-1])], np.int64), np.array(owner, np.int64)


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of about so many bytes of text from batches of group and text."""
    for batch in batches:
        data, offsets = W.text_buffer(batch.column("text"))
        coded = batch.column("lang").dictionary_encode()
        names, group = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        offsets, owner = _parts(data, offsets, limit)
        for lo, hi in W.pieces(offsets, limit):
            start, stop = int(offsets[lo]), int(offsets[hi])
            part, own = W.LOWER[data[start:stop]], offsets[lo : hi + 1] - start
            words = W.find_words(part, own, _WORD)
            if len(words.numbers):
                ends = np.searchsorted(words.starts, np.flatnonzero(_BREAK[part]))  # words before each break
                piece = np.cumsum(np.bincount(np.concatenate([ends, words.first[1:]]), minlength=len(words.starts) + 1))
                piece = piece[: len(words.starts)]
                yield Block(part, words, piece, np.repeat(group[owner[lo:hi]], np.diff(words.first)), names)


class FrequentFilter:
    """A bit per value of the first bits of a fingerprint: whether a frequent one begins so."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.bytes = np.zeros(max(1, 1 << bits >> 3), np.uint8)

    def holds(self, fingerprints: np.ndarray) -> np.ndarray:
        at = (fingerprints >> W.U64(FINGERPRINT_BITS - self.bits)).astype(np.int64)
        return (self.bytes[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    @classmethod
    def of(cls, frequent: DataFrame, bits: int) -> FrequentFilter:
        """From a column ``fp`` of frequent fingerprints. Only the filter's own rows, 4 kB for each 2^15 bits, reach the driver."""
        at = F.shiftright("fp", FINGERPRINT_BITS - bits) + 1
        numbered = frequent.select(F.bitmap_bucket_number(at).alias("row"), F.bitmap_bit_position(at).alias("bit"))
        out = cls(bits)
        for r in numbered.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
            first = (r["row"] - 1) * (_ROW_BITS // 8)
            own = np.frombuffer(bytes(r["bits"]), np.uint8)
            size = min(len(own), len(out.bytes) - first)
            out.bytes[first : first + size] = own[:size]
        return out


def _candidates(block: Block, length: int, passed: dict[int, np.ndarray]) -> np.ndarray:
    """Places of phrases whose words, or pairs if they are longer, are all frequent."""
    places = block.places(length)
    if length > 1:
        step = min(length - 1, 2)
        for k in range(length - step + 1):
            places = places[passed[step][places + k]]
    return places


def _passed(block: Block, filters: dict[int, FrequentFilter], upto: int) -> dict[int, np.ndarray]:
    """For words and pairs, whether the one at each place may be frequent."""
    out = {}
    for length in range(1, upto + 1):
        out[length] = np.zeros(len(block.piece), bool)
        places = _candidates(block, length, out)
        out[length][places] = filters[length].holds(block.fingerprints(length)[places])
    return out


def _count(lengths: range, filters: Broadcast):
    """Fingerprints of candidates and how often each occurs, some blocks at a time."""

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        fp, n = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(fp, kind="stable")
        fp, n = fp[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
        return fp[first], np.add.reduceat(n, first)

    def rows(fp: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        """A row per part: its fingerprints travel together, without the bits that the part stands for."""
        part = (fp >> W.U64(32)).astype(np.int32)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        bounds = pa.array(np.concatenate([first, [len(fp)]]), pa.int32())
        lists = [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in (fp.astype(np.uint32).view(np.int32), n.astype(np.int32))]
        return pa.RecordBatch.from_arrays([pa.array(part[first]), *lists], ["part", "low", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for block in blocks(batches):
            passed = _passed(block, filters.value, min(lengths[0] - 1, 2))
            found = [block.fingerprints(m)[_candidates(block, m, passed)] for m in lengths]
            fp, n = np.unique(np.concatenate(found), return_counts=True)
            if len(fp):
                held.append((fp, n.astype(np.int32)))
                size += len(fp)
            if size > 2 * GATHERED:
                held = [merged(held)]
                size = len(held[0][0])
                if size > GATHERED:
                    yield rows(*held[0])
                    held, size = [], 0
            release_memory()
        if held:
            yield rows(*merged(held))

    return run


def _same_text(block: Block, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the words from two places on are the same, byte by byte."""
    starts, ends = block.words.starts, block.words.ends
    same = np.ones(len(a), bool)
    for k in range(length):
        left = np.flatnonzero(same)
        s, t = starts[a[left] + k], starts[b[left] + k]
        size = ends[a[left] + k] - s
        equal = size == ends[b[left] + k] - t
        left, s, t, size = left[equal], s[equal], t[equal], size[equal]
        same[:] = False
        if len(left):
            head = np.cumsum(size) - size
            inside = np.arange(int(size.sum())) - np.repeat(head, size)
            alike = block.data[np.repeat(s, size) + inside] == block.data[np.repeat(t, size) + inside]
            same[left[np.logical_and.reduceat(alike, head)]] = True
    return same


def _texts(most: int, filters: Broadcast):
    """Phrases that may be frequent, as text, with their group and count in a block; the empty phrase counts all words."""

    def rows(held: dict[str, dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        """A row per part and group: its phrases, packed, and their counts."""
        for group, own in held.items():
            parts: dict[int, list[tuple[bytes, int]]] = {}
            for phrase, n in own.items():
                parts.setdefault(zlib.crc32(phrase) % PHRASE_PARTS, []).append((phrase, n))
            packer = zstandard.ZstdCompressor()
            packed = [packer.compress(b"\n".join(phrase for phrase, _ in found)) for found in parts.values()]
            counts = pa.array([[n for _, n in found] for found in parts.values()], pa.list_(pa.int64()))
            columns = [pa.array(list(parts), pa.int32()), pa.array([group] * len(parts)), pa.array(packed, pa.binary()), counts]
            yield pa.RecordBatch.from_arrays(columns, ["part", "lang", "phrases", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, int]] = {}
        for block in blocks(batches):
            passed = _passed(block, filters.value, min(most, 2))
            for group, n in enumerate(np.bincount(block.group, minlength=len(block.names)).tolist()):
                own = held.setdefault(block.names[group], {})
                own[b""] = own.get(b"", 0) + n
            for length in range(1, most + 1):
                places = np.flatnonzero(passed[length]) if length < 3 else _candidates(block, length, passed)
                fp = block.fingerprints(length)[places]
                if length > 2:
                    found = filters.value[3].holds(fp)
                    places, fp = places[found], fp[found]
                while len(places):
                    order = np.lexsort((places, fp))
                    places, fp = places[order], fp[order]
                    first = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
                    sizes = np.diff(np.concatenate([first, [len(fp)]]))
                    pointer = np.repeat(places[first], sizes)
                    same = _same_text(block, places, pointer, length) & (block.group[places] == block.group[pointer])
                    _written(held, block, places[first], np.add.reduceat(same.astype(np.int64), first), length)
                    places, fp = places[~same], fp[~same]  # other texts with the same fingerprint
            if sum(map(len, held.values())) > HELD_PHRASES:
                yield from rows(held)
                held = {}
            release_memory()
        yield from rows(held)

    return run


def _add_up(least: int):
    """All packed phrases of a part are in one task, which keeps the frequent ones, and each group's number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener, total = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for lang, phrases, counts in zip(*[batch.column(c) for c in ("lang", "phrases", "n")]):
                own = total.setdefault(lang.as_py(), {})
                found = opener.decompress(phrases.as_py()).split(b"\n")
                for phrase, n in zip(found, counts.values.to_pylist()):
                    own[phrase] = own.get(phrase, 0) + n
        for lang, own in total.items():
            kept = [(phrase.decode(), n) for phrase, n in own.items() if n >= least or not phrase]
            columns = [pa.array([lang] * len(kept)), pa.array([p for p, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])

    return run


def _written(held: dict, block: Block, places: np.ndarray, counts: np.ndarray, length: int) -> None:
    """Adds the phrases at the places, as text, to the counts of their groups."""
    starts, ends, data = block.words.starts, block.words.ends, block.data.tobytes()
    texts = [data[s:e] for s, e in zip(starts[places].tolist(), ends[places].tolist())]
    for k in range(1, length):
        further = zip(texts, starts[places + k].tolist(), ends[places + k].tolist())
        texts = [b"%b %b" % (text, data[s:e]) for text, s, e in further]
    of = [held[name] for name in block.names]
    for text, group, n in zip(texts, block.group[places].tolist(), counts.tolist()):
        own = of[group]
        own[text] = own.get(text, 0) + n


def frequent_phrases(
    docs: DataFrame,
    group: str = "lang",
    text: str = "text",
    most_words: int = MOST_WORDS,
    least: int = LEAST_COUNT,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """lang, phrase, n: phrases of 1 to ``most_words`` words that occur ``least`` times in their group, by exact counts.

    The empty phrase has the number of all words of the group.
    """
    spark = docs.sparkSession
    slim = docs.select(F.coalesce(plain(group).cast("string"), F.lit(UNKNOWN)).alias("lang"), clean_text(text).alias("text"))
    filters: dict[int, FrequentFilter] = {}
    for level, lengths in enumerate((range(1, 2), range(2, 3), range(3, most_words + 1)), 1):
        if not len(lengths) or lengths[0] > most_words:
            break
        counter = _count(lengths, spark.sparkContext.broadcast(dict(filters)))
        packed = slim.mapInArrow(counter, "part int, low array<int>, n array<int>").repartition("part")
        counted = packed.select("part", F.inline(F.arrays_zip("low", "n")))  # parts stay where they are
        frequent = counted.groupBy("part", "low").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        fp = F.shiftleft(F.col("part").cast("long"), 32) + F.col("low").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
        filters[level] = FrequentFilter.of(frequent.select(fp.alias("fp")), filter_bits)
    sent = spark.sparkContext.broadcast(filters)
    written = slim.mapInArrow(_texts(most_words, sent), "part int, lang string, phrases binary, n array<long>")
    return written.repartition("part").mapInArrow(_add_up(least), "lang string, phrase string, n long")


def collocations(
    docs: DataFrame,
    group: str = "lang",
    text: str = "text",
    most_words: int = MOST_WORDS,
    least: int = LEAST_COUNT,
    top: int = TOP,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Each group's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    a, l and r count the phrase and the two parts of its lowest-scoring cut, n all words of the group;
    the score is floor(1000 a n / (l r)). A phrase gives way to a longer one that is never without it.
    """
    return rank_phrases(stored(frequent_phrases(docs, group, text, most_words, least, filter_bits), "phrases"), top)


def rank_phrases(counts: DataFrame, top: int = TOP) -> DataFrame:
    """The phrases of ``frequent_phrases``, cut, scored and ranked; the table is read several times."""
    size = F.size(F.split("phrase", " "))
    known = counts.filter("phrase <> ''")
    phrases = known.withColumn("words", size).filter("words >= 2").withColumnRenamed("n", "a")

    # Counts only fall as phrases grow, so it is enough to look at phrases of one word more.
    word = F.split("phrase", " ")
    part = lambda first, n: F.array_join(F.slice(word, first, n), " ")
    shorter = F.array(part(F.lit(1), F.col("words") - 1), part(F.lit(2), F.col("words") - 1))
    inner = phrases.filter("words > 2").select("lang", F.explode(shorter).alias("phrase"), "a")
    left = phrases.join(inner, ["lang", "phrase", "a"], "left_anti")

    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("head", part(F.lit(1), F.col("k")))
    cuts = cuts.withColumn("tail", part(F.col("k") + 1, F.col("words") - F.col("k")))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    totals = counts.filter("phrase = ''").select("lang", "n")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    # whole numbers: at most 38 digits for 1000 a n, as neither a nor n has more than 17
    exact = lambda *names: functools.reduce(lambda x, y: x * y, [F.col(c).cast("decimal(19,0)") for c in names])
    scored = scored.withColumn("__up", F.lit(SCALE).cast("decimal(4,0)") * exact("a", "n")).withColumn("__down", exact("l", "r"))
    scored = scored.withColumn("score", F.expr("__up div __down"))
    lowest = F.min(F.struct("score", "k", "l", "r", "n")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r", "cut.n")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    some = some.filter(F.col("rank") <= top).drop("rank", "salt")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
