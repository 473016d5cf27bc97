"""Token files: canonical, length-limited Huffman codes of token ids.

Texts are tokenized once and the ids kept in the shared folder. Their global counts (a
table as long as the vocabulary) give code lengths of at most ``LIMIT`` bits by
package-merge; the codes follow canonically from the lengths. Every document is coded where it
lies, and only coded bytes are shuffled into ranges of ascending document ids, one
shard of the files each. A file holds blocks of whole documents; a block can be decoded by itself, and
bit offsets every ``CHECKPOINT`` ids let a table-driven decoder run many places of it at once.

A token file folder has two Parquet tables, so it lives on any file system Spark can write:
``blocks`` (shard, block, first, doc_ids, lengths, checkpoints, payload) and ``codebook`` (id, bits).

Range bounds come from quantiles of the ids and only balance the work. Documents that share an id
and outweigh a range are spread over several shards, which stay in order.

Defined results: a NULL text is an empty one and has the end id alone; NULL ids come
first; rows with the same id follow each other in the order of a hash of their text; an
empty table gives empty files.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import releasing, text_of
from riskframe.llm.word_bpe import byte_letters
from riskframe.llm.words import pieces
from riskframe.session import scratch_path, shuffle_parallelism

LIMIT = 20
CHECKPOINT = 512
BLOCK_IDS = 1 << 18
#: Pieces, and words, whose ids a worker remembers; others are tokenized again.
REMEMBERED = 800_000
WORDS_TOGETHER = 5_000
#: ASCII punctuation without the apostrophe, which begins a word of its own kind.
_PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters of Latin-1, which have no other normal form and one lower-case form.
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
_CODED = "doc_id long, tie long, shard int, n int, bits array<int>, payload binary"
_BLOCKS = (
    "shard int, block int, first long, doc_ids array<long>, lengths array<int>, checkpoints array<long>, payload binary"
)


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for positive counts, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = np.asarray(counts, np.int64)[order]
    packages, levels = np.zeros(0, np.int64), []
    for _ in range(limit):
        merged = np.concatenate([leaves, packages])
        by_weight = np.argsort(merged, kind="stable")
        levels.append(by_weight < n)
        merged = merged[by_weight]
        packages = merged[0 : len(merged) // 2 * 2 : 2] + merged[1::2]
    lengths, taken = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):  # what is taken of each level is a prefix of it
        own = int(is_leaf[:taken].sum())
        lengths[:own] += 1
        taken = 2 * (taken - own)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes from (id, bits) pairs: shorter codes first, then smaller ids."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray) -> None:
        order = np.lexsort((ids, bits))
        self.ids, self.lengths = ids[order].astype(np.int64), bits[order].astype(np.int64)
        self.width = int(self.lengths[-1]) if len(ids) else 1
        steps = np.int64(1) << (self.width - self.lengths)  # places of each code in the decoding table
        first = np.cumsum(steps) - steps
        codes = first >> (self.width - self.lengths)
        size = int(self.ids.max()) + 1 if len(ids) else 1
        self.code_of, self.bits_of = np.zeros(size, np.uint32), np.zeros(size, np.int64)
        self.code_of[self.ids], self.bits_of[self.ids] = codes, self.lengths
        self.table = np.zeros(1 << self.width, np.int64)
        filled = np.repeat(self.ids << 5 | self.lengths, steps)
        self.table[: len(filled)] = filled

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of several texts' ids: bytes, each text's first byte (one more at the end), each id's bit in its text."""
        bits = self.bits_of[ids]
        ends = np.cumsum(bits)
        first = np.cumsum(counts) - counts
        before = np.concatenate([[0], ends])
        base = before[first]  # bits before each text
        inside = ends - bits - np.repeat(base, counts)
        sizes = (before[first + counts] - base + 7) // 8
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = inside + np.repeat(starts[:-1] * 8, counts)
        word = self.code_of[ids].astype(np.uint64) << (64 - (at & 31) - bits).astype(np.uint64)
        cell, total = at >> 5, int(starts[-1])  # a code lies in a cell of 32 bits and the next one
        out = np.zeros(total // 4 + 3, np.uint64)
        heads = np.flatnonzero(np.diff(cell, prepend=-1))
        if len(heads):
            both = np.add.reduceat(word, heads)
            out[cell[heads]] += both >> np.uint64(32)
            out[cell[heads] + 1] += both & np.uint64(0xFFFFFFFF)
        return out.astype(">u4").view(np.uint8)[:total], starts, inside

    def decode(self, payload: np.ndarray, checkpoints: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of all segments: each starts at its bit and holds its number of ids. All segments advance together."""
        padded = np.concatenate([payload, np.zeros(8, np.uint8)]).astype(np.uint32)
        windows = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
        order = np.argsort(-counts, kind="stable")
        place = (np.cumsum(counts) - counts)[order]
        bit, left = checkpoints[order].astype(np.int64), counts[order]
        out = np.zeros(int(counts.sum()), np.int64)
        shift, mask = np.uint32(32 - self.width), np.uint32(7)
        running = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), "left")
        for step, n in enumerate(running):
            at = bit[:n]
            code = (windows[at >> 3] << (at.astype(np.uint32) & mask)) >> shift
            entry = self.table[code]
            out[place[:n] + step] = entry >> 5
            bit[:n] = at + (entry & 31)
        return out


def _stays_letters(word: str) -> bool:
    """Whether normalized and lowered letters are still nothing but letters; marks would go with punctuation behind them."""
    return unicodedata.normalize("NFC", word).lower().isalpha()


class _Numbers(dict):
    """Numbers of pieces in the order in which they are met first."""

    def __missing__(self, piece: bytes) -> int:
        number = self[piece] = len(self)
        return number


class WordTokenizer:
    """A tokenizer of the tokenizers library, asked once per distinct word while the word is remembered.

    Texts are cut at ASCII white space, over which neither its normalization nor its splitting reaches. A cut piece of
    letters with ASCII punctuation behind them is two words of their own, the letters lowered if they are ASCII,
    because the tokenizer lowers and splits them so. Plain words are encoded many at a time; where each of
    them is one word to the tokenizer, the ends of words in its vocabulary tell them apart again.

    Each piece of a text is looked up once, which gives its number; ids are then taken by numbers from flat arrays.
    """

    _built: dict[int, WordTokenizer] = {}

    def __init__(self, content: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        settings = json.loads(content)
        suffix = settings["model"].get("end_of_word_suffix")
        self.lowers = '"Lowercase"' in json.dumps(settings.get("normalizer"))
        self.ends: np.ndarray | None = None
        if suffix:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        #: Words of Latin letters are one word to these steps, and go to the model as the letters that stand for their bytes.
        steps = json.dumps(settings.get("pre_tokenizer"))
        self.direct = bool(suffix) and self.lowers and '"ByteLevel"' in steps and r"|[\\p{L}]+|" in steps
        self.letters = str.maketrans({chr(b): letter for letter, b in byte_letters().items() if ord(letter) != b})
        self.words: dict[str, bytes] = {}
        self.number = _Numbers()
        self.first = np.zeros(1, np.int64)  # where the ids of each piece begin in ``ids``, and the last ones end
        self.ids = np.zeros(0, np.uint32)

    @classmethod
    def of(cls, content: str) -> WordTokenizer:
        key = zlib.crc32(content.encode())
        if key not in cls._built:
            cls._built[key] = cls(content)
        return cls._built[key]

    def _one_by_one(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in found]

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of words that are all letters or all punctuation."""
        if not words:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):  # some word is several to the tokenizer
            return self._one_by_one(words)
        raw, bounds = ids.tobytes(), (4 * ends).tolist()
        return [raw[a:b] for a, b in zip([0, *bounds], bounds)]

    def _latin(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words of Latin letters, from the model alone."""
        spelled = "\n".join(words).encode().decode("latin-1").translate(self.letters | {0x0A: "\n"}).split("\n")
        tokenize, ids, bounds = self.tokenizer.model.tokenize, [], [0]
        for word in spelled:
            ids += [t.id for t in tokenize(word)]
            bounds.append(4 * len(ids))
        raw = np.array(ids, np.uint32).tobytes()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _learn(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of new pieces, from those of their words."""
        letters = [p.rstrip(_PUNCTUATION) for p in pieces]
        rests = b"\n".join([p[len(w) :] for p, w in zip(pieces, letters)]).decode().split("\n")
        letters = b"\n".join(letters).decode().split("\n")  # no piece holds a line feed
        plain = [
            self.ends is not None and (not w or (w.isalpha() and (not r or w.isascii() or _stays_letters(w))))
            for w, r in zip(letters, rests)
        ]
        if self.lowers:
            letters = [w.lower() if w.isascii() or _LATIN(w) else w for w in letters]
        new = {w for w, ok in zip(letters, plain) if ok}
        new.update([w for w, ok in zip(rests, plain) if ok])
        new = [w for w in new if w and w not in self.words]
        for low in range(0, len(new), WORDS_TOGETHER):
            part = new[low : low + WORDS_TOGETHER]
            latin = [w for w in part if self.direct and _LATIN(w)]
            self.words.update(zip(latin, self._latin(latin) if latin else []))
            other = [w for w in part if not (self.direct and _LATIN(w))]
            self.words.update(zip(other, self._plain(other)))
        self.words[""] = b""
        odd = [p.decode() for p, ok in zip(pieces, plain) if not ok]
        coded = []
        for low in range(0, len(odd), WORDS_TOGETHER):
            coded += self._one_by_one(odd[low : low + WORDS_TOGETHER])
        of, odds = self.words, iter(coded)
        return [of[w] + of[r] if ok else next(odds) for w, r, ok in zip(letters, rests, plain)]

    def _split(self, text: bytes) -> list[bytes]:
        """Pieces between white space, with fewer forms of the same word.

        Lowering ASCII letters beforehand changes nothing unless a combining mark (its first byte is CC or CD) follows one,
        or the text may hold an added token, which is matched as it is written.
        """
        if self.lowers and b"\xcc" not in text and b"\xcd" not in text and b"<|" not in text:
            text = text.lower()
        return text.split()

    def _forget(self) -> None:
        """What was met first is what is frequent, and is kept."""
        if len(self.number) > REMEMBERED:
            kept = REMEMBERED // 3
            self.number = _Numbers(islice(self.number.items(), kept))
            self.first, self.ids = self.first[: kept + 1].copy(), self.ids[: self.first[kept]].copy()
        if len(self.words) > REMEMBERED:
            self.words = dict(islice(self.words.items(), REMEMBERED // 3))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        self._forget()
        known, look = len(self.number), self.number.__getitem__
        numbers = [np.fromiter(map(look, words), np.int64, len(words)) for words in map(self._split, texts)]
        if len(self.number) > known:
            new = self._learn(list(islice(self.number, known, None)))
            sizes = np.fromiter(map(len, new), np.int64, len(new)) // 4
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(new), np.uint32)])
        out = []
        for own in numbers:
            first = self.first[own]
            counts = self.first[own + 1] - first
            ends = np.cumsum(counts)
            out.append(self.ids[np.repeat(first - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)])
        return out


def _tokenize(tokenizer, end_id: int, points: list[int]):
    """Rows of ids (little-endian, 32 bits), the end id last, and the shard that the document id falls into."""
    cuts = np.array(points, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokenizer.of(tokenizer.value)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            for low, high in pieces(offsets, 2 << 20):
                part = batch.slice(low, high - low)
                ids = [np.concatenate([i, end]).tobytes() for i in encoder.encode(texts[low:high])]
                known = np.array(part.column("doc_id").is_valid())
                number = part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                below, upto = np.searchsorted(cuts, number, "left"), np.searchsorted(cuts, number, "right")
                tie = part.column("tie").to_numpy(zero_copy_only=False)
                shard = np.where(upto > below, below + 1 + np.mod(tie, np.maximum(upto - below, 1)), below)
                shard = np.where(known, shard, 0).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tie"), pa.array(shard), pa.array(ids, pa.binary())],
                    ["doc_id", "tie", "shard", "ids"],
                )

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        found = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), np.uint32))
        if len(found) > len(total):
            total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
        total[: len(found)] += found
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])


def _encode(book):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codebook(*book.value)
        for batch in batches:
            lists = [np.frombuffer(b, np.uint32) for b in batch.column("ids").to_pylist()]
            sizes = np.concatenate([[0], np.cumsum([4 * len(i) for i in lists])])
            for low, high in pieces(sizes, 4 << 20):
                part, some = batch.slice(low, high - low), lists[low:high]
                counts = np.array([len(i) for i in some], np.int64)
                data, starts, inside = codes.encode(np.concatenate(some), counts)
                first = np.cumsum(counts) - counts
                bits = [inside[f : f + n : CHECKPOINT].astype(np.int32) for f, n in zip(first, counts)]
                payload = [data[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tie"), part.column("shard"), pa.array(counts.astype(np.int32)),
                     pa.array(bits, pa.list_(pa.int32())), pa.array(payload, pa.binary())],
                    ["doc_id", "tie", "shard", "n", "bits", "payload"],
                )

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Coded documents, sorted by shard and id, become blocks of whole documents."""
    shard, block, first = None, 0, 0
    ids, lengths, bits, parts, size, held = [], [], [], [], 0, 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
             pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
             pa.array([np.concatenate(bits)], pa.list_(pa.int64())), pa.array([b"".join(parts)], pa.binary())],
            ["shard", "block", "first", "doc_ids", "lengths", "checkpoints", "payload"],
        )

    for batch in batches:
        columns = [batch.column(c) for c in ("shard", "doc_id", "n", "bits", "payload")]
        for s, doc, n, own, payload in zip(*columns):
            s = s.as_py()
            if ids and (s != shard or held >= BLOCK_IDS):
                yield flush()
                block, first = block + 1, first + held
                ids, lengths, bits, parts, size, held = [], [], [], [], 0, 0
            if s != shard:
                shard, block, first = s, 0, 0
            ids.append(doc.as_py())
            lengths.append(n.as_py())
            bits.append(own.values.to_numpy().astype(np.int64) + 8 * size)
            parts.append(payload.as_py())
            size += len(parts[-1])
            held += lengths[-1]
    if ids:
        yield flush()


def _decode(book, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codebook(*book.value)
        for batch in batches:
            for shard, first, docs, lengths, checkpoints, payload in zip(
                *[batch.column(c) for c in ("shard", "first", "doc_ids", "lengths", "checkpoints", "payload")]
            ):
                lengths = lengths.values.to_numpy().astype(np.int64)
                per_doc = -(-lengths // CHECKPOINT)
                counts = np.full(int(per_doc.sum()), CHECKPOINT, np.int64)
                counts[np.cumsum(per_doc) - 1] = lengths - (per_doc - 1) * CHECKPOINT
                data = np.frombuffer(payload.as_py(), np.uint8)
                ids = codes.decode(data, checkpoints.values.to_numpy(), counts).astype("<u4")
                starts = np.cumsum(lengths) - lengths
                texts = [ids[a : a + n] for a, n in zip(starts, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [docs.values, pa.array(np.full(len(lengths), shard.as_py(), np.int32)),
                     pa.array(starts + first.as_py()), pa.array(lengths),
                     pa.array([zlib.crc32(t.tobytes()) for t in texts], pa.int64()),
                     pa.array([t.astype(np.int32) for t in texts] if with_ids else [None] * len(texts), pa.list_(pa.int32()))],
                    ["doc_id", "shard", "inside", "n_tokens", "ids_crc32", "ids"],
                )

    return run


def _points(docs: DataFrame, shards: int) -> list[int]:
    """Range bounds of the ids; an id that outweighs a range appears several times."""
    shares = [i / shards for i in range(1, shards)]
    found = docs.select("doc_id").filter("doc_id is not null").approxQuantile("doc_id", shares, 1 / (2 * shards))
    return sorted(int(p) for p in found)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
    shards: int | None = None,
) -> None:
    """Writes the token files of all documents, in ascending order of their (whole-number) ids."""
    spark = docs.sparkSession
    slim = text_of(docs, doc_id, text).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie")
    )
    shards = shards or 2 * shuffle_parallelism(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = spark.sparkContext.broadcast(file.read())
    tokenized = slim.select("doc_id", "tie", "text").mapInArrow(
        releasing(_tokenize(tokenizer, end_id, _points(slim, shards))), "doc_id long, tie long, shard int, ids binary"
    )
    ids_path = scratch_path(spark, "ids")
    tokenized.write.option("compression", "zstd").parquet(ids_path)
    ids = spark.read.parquet(ids_path)
    counts = ids.select("ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counted = sorted((r["id"], r["n"]) for r in counts.collect())  # one row per id of the vocabulary
    symbols = np.array([i for i, _ in counted], np.int64)
    bits = code_lengths(np.array([n for _, n in counted], np.int64), limit)
    codebook = [(int(i), int(b)) for i, b in zip(symbols, bits)]
    spark.createDataFrame(codebook, "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    book = spark.sparkContext.broadcast((symbols, bits))
    coded = ids.mapInArrow(releasing(_encode(book)), _CODED)
    in_order = coded.repartition(shards, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "tie")
    in_order.mapInArrow(_blocks, _BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and ids."""
    rows = spark.read.parquet(f"{path}/codebook").collect()  # one row per id of the vocabulary
    book = (np.array([r["id"] for r in rows], np.int64), np.array([r["bits"] for r in rows], np.int64))
    blocks = spark.read.parquet(f"{path}/blocks")
    in_block = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    totals = blocks.select("shard", in_block.alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    offsets = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    decoded = blocks.mapInArrow(
        _decode(spark.sparkContext.broadcast(book), with_ids),
        "doc_id long, shard int, inside long, n_tokens long, ids_crc32 long, ids array<int>",
    )
    placed = decoded.join(F.broadcast(offsets), "shard").withColumn("start", F.col("before") + F.col("inside"))
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
