"""Byte-level BPE by a global shuffle of distinct words.

Texts are exploded into pre-tokens, unit by unit (a unit is some ``UNIT_BYTES`` of one
partition's texts): a list of the unit's distinct words, and for every document the positions as
numbers into that list. The words of all units meet by a hash of the word, so that each
distinct word is encoded once; the ids go back to the units they came from, are joined
to the positions, and every document is put together again. A frequent word travels
once per unit, not once per occurrence. Decoding joins ids to the token-byte table, which
has the size of the vocabulary.

The input is read twice (words, positions). Both readings must see the same rows in the same
partitions, as a table of files gives them; units carry a fingerprint of their texts,
and a reading that differs is an error, never a wrong result. Anything else than a
table of files should be stored first (``stored_first=True``).

Defined results: a NULL text is an empty one and has no tokens; ids and other columns are
passengers, NULL and repeated ones too; a text larger than a unit is a unit of its own.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import plain, releasing, stored, text_of
from riskframe.session import shuffle_parallelism

UNIT_BYTES = 16 << 20
#: Words that a task remembers; more than that are encoded again, with the same result.
REMEMBERED = 500_000

_SPACES = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Pieces between which a pre-token cannot reach: white space ends before the blank that leads a word.
_PIECE = re.compile(f" ?[^{_SPACES}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")


class Vocabulary:
    """Ranks of a tiktoken file, held as the file's bytes so that it travels light; built once per process."""

    _built: dict[int, Vocabulary] = {}

    def __init__(self, content: bytes, pattern: str) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.encoder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token

    @classmethod
    def of(cls, sent: Broadcast) -> Vocabulary:
        content, pattern = sent.value
        key = zlib.crc32(content)
        if key not in cls._built:
            cls._built[key] = cls(content, pattern)
        return cls._built[key]

    def decode(self, ids) -> bytes:
        """Token-byte table joined to the ids."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _squeeze(a: np.ndarray) -> bytes:
    """Whole numbers below 2^32, packed byte plane by byte plane: the higher planes hardly vary."""
    planes = np.ascontiguousarray(a, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _spread(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_words(words: list[str]) -> tuple[bytes, bytes]:
    """The words' bytes, one after the other, and their lengths."""
    encoded = [w.encode() for w in words]
    lengths = np.fromiter(map(len, encoded), np.uint32, len(encoded))
    return zstandard.ZstdCompressor(level=1).compress(b"".join(encoded)), _squeeze(lengths)


def _open_words(packed: bytes, lengths: bytes) -> list[str]:
    content = zstandard.ZstdDecompressor().decompress(packed)
    ends = np.cumsum(_spread(lengths), dtype=np.int64).tolist()
    return [content[a:b].decode() for a, b in zip([0, *ends], ends)]


def split_unit(texts: list[str], pattern: str) -> tuple[list[str], list[np.ndarray]]:
    """Distinct pre-tokens of the texts, in order of appearance, and each text as numbers of them."""
    pieces: dict[str, int] = {}
    coarse = []
    for text in texts:
        found = _PIECE.findall(text)
        coarse.append(np.fromiter((pieces.setdefault(p, len(pieces)) for p in found), np.int64, len(found)))
    words: dict[str, int] = {}
    find = regex.compile(pattern).findall
    flat, counts = [], np.zeros(len(pieces), np.int64)
    for i, piece in enumerate(pieces):
        letters = piece[1:] if piece[0] == " " else piece
        own = [piece] if letters.isalpha() else find(piece)  # letters after at most one blank are one pre-token
        counts[i] = len(own)
        flat += [words.setdefault(w, len(words)) for w in own]
    codes = np.array(flat, np.uint32)
    first = np.cumsum(counts) - counts
    return list(words), [_expand(codes, first, counts, c) for c in coarse]


def _expand(values: np.ndarray, first: np.ndarray, counts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen rows of a ragged table, one after the other."""
    lengths = counts[chosen]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(first[chosen] - (ends - lengths), lengths) + np.arange(total)]


def _units(batches: Iterator[pa.RecordBatch], unit_bytes: int) -> Iterator[tuple[str, pa.Array, list[str]]]:
    """Units of a partition: a key, the passengers, the texts."""
    part, number = TaskContext.get().partitionId(), 0
    rows, texts, size = [], [], 0

    def unit() -> tuple[str, pa.Array, list[str]]:
        mark = 0
        for t in texts:
            mark = zlib.crc32(t.encode(), zlib.crc32(b"\x00", mark))
        return f"{part}-{number}-{len(texts)}-{mark}", pa.concat_arrays(rows), texts

    for batch in batches:
        row, column = batch.column("row"), batch.column("text")
        low = 0
        for i in range(batch.num_rows):
            text = column[i].as_py()
            texts.append(text)
            size += len(text)
            if size >= unit_bytes:
                rows.append(row.slice(low, i + 1 - low))
                yield unit()
                rows, texts, size, low, number = [], [], 0, i + 1, number + 1
        if low < batch.num_rows:
            rows.append(row.slice(low))
    if texts:
        yield unit()


def _words_of_units(pattern: str, buckets: int, unit_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, texts in _units(batches, unit_bytes):
            words, _ = split_unit(texts, pattern)
            bucket = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words)) % buckets
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                own = order[bounds[b] : bounds[b + 1]].tolist()
                if own:
                    packed, lengths = _pack_words([words[i] for i in own])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b], pa.int32()), pa.array([key]), pa.array([_squeeze(own)], pa.binary()),
                         pa.array([packed], pa.binary()), pa.array([lengths], pa.binary())],
                        ["bucket", "unit", "places", "words", "lengths"],
                    )

    return run


def _encode_words(vocabulary: Broadcast):
    """All units' words of a bucket are in one task, which encodes each of them once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Vocabulary.of(vocabulary).encoder
        known: dict[str, list[int]] = {}
        for batch in batches:
            for unit, places, packed, lengths in zip(*[batch.column(c) for c in ("unit", "places", "words", "lengths")]):
                words = _open_words(packed.as_py(), lengths.as_py())
                new = [w for w in words if w not in known]
                if new:
                    known.update(zip(new, encoder.encode_ordinary_batch(new, num_threads=1)))
                ids = [known[w] for w in words]
                counts = np.fromiter(map(len, ids), np.uint32, len(ids))
                flat = np.fromiter((i for own in ids for i in own), np.uint32, int(counts.sum()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([unit.as_py()]), pa.array([places.as_py()], pa.binary()),
                     pa.array([_squeeze(counts)], pa.binary()), pa.array([_squeeze(flat)], pa.binary())],
                    ["unit", "places", "counts", "ids"],
                )
                if len(known) > REMEMBERED:
                    known = {}

    return run


def _positions_of_units(pattern: str, unit_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows, texts in _units(batches, unit_bytes):
            _, sequences = split_unit(texts, pattern)
            for low in range(0, len(texts), 1000):
                part = sequences[low : low + 1000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(part)), rows.slice(low, len(part)),
                     pa.array([_squeeze(s) for s in part], pa.binary())],
                    ["unit", "row", "places"],
                )

    return run


def _reassemble(vocabulary: Broadcast, with_ids: bool):
    def run(words: pa.Table, docs: pa.Table) -> pa.Table:
        table = Vocabulary.of(vocabulary)
        places = [_spread(b) for b in words.column("places").to_pylist()]
        size = sum(map(len, places))
        counts, first, ids = np.zeros(size, np.int64), np.zeros(size, np.int64), []
        total = 0
        for at, n, own in zip(places, words.column("counts").to_pylist(), words.column("ids").to_pylist()):
            n = _spread(n).astype(np.int64)
            counts[at], first[at] = n, np.cumsum(n) - n + total
            ids.append(_spread(own))
            total += len(ids[-1])
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        decimals = [b"%d" % i for i in range(len(table.bytes_of))]
        n_tokens, sums, decoded, lists = [], [], [], []
        for packed in docs.column("places").to_pylist():
            sequence = _spread(packed)
            if len(sequence) and int(sequence.max()) >= size:
                raise RuntimeError("the two readings of the input differ; store it first")
            own = _expand(flat, first, counts, sequence)
            listed = own.tolist()
            n_tokens.append(len(listed))
            sums.append(hashlib.sha256(b",".join(map(decimals.__getitem__, listed))).hexdigest())
            decoded.append(hashlib.sha256(table.decode(listed)).hexdigest())
            lists.append(own.astype(np.int32) if with_ids else None)
        return pa.table(
            [docs.column("row"), pa.array(n_tokens, pa.int64()), pa.array(sums, pa.string()),
             pa.array(decoded, pa.string()), pa.array(lists, pa.list_(pa.int32()))],
            ["row", "n_tokens", "ids_sha256", "decoded_sha256", "ids"],
        )

    return run


def encode(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    with_ids: bool = True,
    stored_first: bool = False,
    unit_bytes: int = UNIT_BYTES,
) -> DataFrame:
    """The kept columns, n_tokens, ids_sha256, decoded_sha256 (of the decoded ids) and, on request, ids."""
    spark = docs.sparkSession
    row = F.struct(*[plain(c).alias(f"c{i}") for i, c in enumerate(keep)])
    slim = text_of(docs.withColumn("__row", row), "__row", text).withColumnRenamed("doc_id", "row")
    if stored_first:
        slim = stored(slim, "bpe")
    with open(vocabulary_path, "rb") as file:
        vocabulary = spark.sparkContext.broadcast((file.read(), pattern))
    buckets = shuffle_parallelism(spark)
    words = slim.mapInArrow(
        releasing(_words_of_units(pattern, buckets, unit_bytes)), "bucket int, unit string, places binary, words binary, lengths binary"
    )
    encoded = words.repartition(buckets, "bucket").mapInArrow(
        releasing(_encode_words(vocabulary)), "unit string, places binary, counts binary, ids binary"
    )
    kind = slim.schema["row"].dataType
    positions = slim.mapInArrow(
        releasing(_positions_of_units(pattern, unit_bytes)),
        T.StructType().add("unit", "string").add("row", kind).add("places", "binary"),
    )
    out = T.StructType().add("row", kind).add("n_tokens", "long").add("ids_sha256", "string")
    out = out.add("decoded_sha256", "string").add("ids", T.ArrayType(T.IntegerType()))
    whole = encoded.groupBy("unit").cogroup(positions.groupBy("unit")).applyInArrow(_reassemble(vocabulary, with_ids), out)
    columns = [F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)]
    return whole.select(*columns, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else []))


def decode(tokens: DataFrame, vocabulary_path: str, pattern: str, ids: str = "ids", output: str = "text") -> DataFrame:
    """Adds the text of the ids; NULL stays NULL. Bytes that are no UTF-8 become replacement characters."""
    with open(vocabulary_path, "rb") as file:
        vocabulary = tokens.sparkSession.sparkContext.broadcast((file.read(), pattern))

    def texts(lists: pa.Array) -> pa.Array:
        table = Vocabulary.of(vocabulary)
        return pa.array([None if i is None else table.decode(i).decode("utf-8", "replace") for i in lists.to_pylist()], pa.string())

    return tokens.withColumn(output, F.arrow_udf(texts, T.StringType())(plain(ids)))
