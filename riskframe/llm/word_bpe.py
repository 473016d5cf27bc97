"""BPE encoding and decoding by forced boundaries.

A vocabulary whose words carry an end mark has 512 symbols: each byte inside a word, and each byte
that ends one. Two neighbouring symbols that stand side by side in no token of the vocabulary can
never be merged into one, so there is a certain cut between them; the end of a word is
such a place, as no token goes beyond it. The fragments between cuts are encoded independently of
each other, a batch of them at once, and their ids are concatenated.

Texts go through the tokenizer file's own steps before that: its added tokens are taken out of the raw
text, then come its normalizer and its splitting into words. ASCII white space is a boundary for all of
these, so each distinct piece between white space goes through them once while a worker remembers it.
Rows are handled by themselves: no shuffle, and no key can be hot.

Merges are applied lowest rank first. That can be done for all places of a fragment at once, because
a merge needs the results of earlier ones only; this is checked when the file is read.

Ids are kept as bytes, little-endian and 32 bits each. Decoding joins ids to the table of tokens,
as the file's decoder (none: tokens with a blank between) does.

Defined results: a NULL text is an empty one and has no ids; NULL ids decode to NULL, no ids to an
empty text; other columns are passengers, NULL and repeated ones too; a very long piece is
encoded by a heap instead of in rounds and not remembered, with the same result; a file with other
steps than those known here (truncation and padding are unused) is an error.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import plain, release_memory, text_of
from riskframe.llm.words import pieces, text_buffer

#: Pieces whose ids a worker remembers; others are encoded again, with the same result.
REMEMBERED = 300_000
#: Longer pieces are not remembered.
REMEMBERED_BYTES = 256
#: Longer fragments are merged with a heap: rounds over all places would cost their length times the number of merges.
ROUND_SYMBOLS = 512
BATCH_BYTES = 2 << 20
_NONE = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 itself, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class ForcedCutBpe:
    """A word-end BPE of a tokenizers file: its merges over symbols, its certain cuts, its steps before and after."""

    _built: dict[int, ForcedCutBpe] = {}

    def __init__(self, content: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        settings = json.loads(content)
        model, suffix = settings["model"], settings["model"].get("end_of_word_suffix")
        unused = ("unk_token", "continuing_subword_prefix", "dropout", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or not suffix or any(model.get(k) for k in unused) or settings.get("decoder"):
            raise ValueError("not a word-end byte-level BPE without decoder")
        self.tokenizer = Tokenizer.from_str(content)
        added = settings["added_tokens"]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens are expected to be matched as they are")
        self.added = {t["content"]: t["id"] for t in added}
        self.find_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")" if self.added else "(?!)()")
        steps = json.dumps(settings.get("normalizer")) + json.dumps(settings.get("pre_tokenizer"))
        #: How ASCII pieces are cut into words; anything else goes through the library's own steps.
        self.ascii_words = None
        if '"Lowercase"' in steps and r"'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in steps:
            self.ascii_words = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x00-\x20\x7fa-z0-9]+")
        self._read_vocabulary(model["vocab"], model["merges"], suffix)
        self.known: dict[bytes, bytes] = {}

    def _read_vocabulary(self, vocab: dict[str, int], merges: list, suffix: str) -> None:
        self.letters = letters = byte_letters()

        def symbols(token: str) -> list[int]:
            ends = token.endswith(suffix)
            own = [letters[c] for c in (token.removesuffix(suffix) if ends else token)]
            if ends:
                own[-1] += 256
            return own

        self.size = max([*vocab.values(), *self.added.values()]) + 1
        self.side_by_side = np.zeros((512, 512), bool)
        self.id_of = np.full(512, -1, np.int64)
        self.tokens = [b""] * self.size
        for token, number in vocab.items():
            own = symbols(token)
            if len(own) == 1:
                self.id_of[own[0]] = number
            self.side_by_side[own[:-1], own[1:]] = True
            self.tokens[number] = token.encode()
        for token, number in self.added.items():
            self.tokens[number] = token.encode()
        if (self.id_of < 0).any():
            raise ValueError("some byte has no token")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        born = np.full(self.size, -1, np.int64)
        born[made] = np.arange(len(made))
        if len(np.unique(made)) < len(made) or (np.maximum(born[left], born[right]) >= np.arange(len(made))).any():
            raise ValueError("merges are not in the order in which their parts are made")
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.made = made

    @classmethod
    def of(cls, sent: Broadcast) -> ForcedCutBpe:
        content = sent.value
        key = zlib.crc32(content.encode())
        if key not in cls._built:
            cls._built[key] = cls(content)
        return cls._built[key]

    def _words(self, piece: bytes) -> list[bytes | int]:
        """Words (as bytes) and ids of added tokens in a piece without ASCII white space."""
        if self.ascii_words is not None and piece.isascii() and b"<|" not in piece:
            lowered = piece.lower()
            found = self.ascii_words.findall(lowered)
            if sum(map(len, found)) == len(lowered):  # control characters are left to the library
                return found
        out: list[bytes | int] = []
        for part in self.find_added.split(piece.decode()):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                clean = self.tokenizer.normalizer.normalize_str(part) if self.tokenizer.normalizer else part
                out += [bytes(map(self.letters.__getitem__, w)) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(clean)]
        return out

    def cut(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words, and where fragments begin: behind a pair that no token holds."""
        symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        symbols[np.cumsum([len(w) for w in words]) - 1] += 256
        first = np.flatnonzero(~self.side_by_side[symbols[:-1], symbols[1:]]) + 1
        return symbols, np.concatenate([[0], first])

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def _by_heap(self, ids: list[int]) -> list[int]:
        """One long fragment: the pair of least rank first, the leftmost of equal ones first."""
        rank = dict(zip(self.keys.tolist(), self.ranks.tolist()))
        n, size = len(ids), self.size
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank.get(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or rank.get(ids[i] * size + ids[j]) != r:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if (r := rank.get(ids[i] * size + ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := rank.get(ids[before[i]] * size + ids[i])) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [i for i in ids if i >= 0]

    def merge(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all fragments, one after the other, and how many each has."""
        lengths = np.diff(np.concatenate([first, [len(symbols)]]))
        ids, fragment = self.id_of[symbols], np.repeat(np.arange(len(first)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for f in np.flatnonzero(lengths > ROUND_SYMBOLS):
            own = np.array(self._by_heap(ids[first[f] : first[f] + lengths[f]].tolist()), np.int64)
            done.append((np.full(len(own), f), own))
        active = (lengths <= ROUND_SYMBOLS)[fragment]
        ids, fragment = ids[active], fragment[active]
        while len(ids):
            rank = np.full(len(ids), _NONE)
            rank[:-1] = np.where(fragment[1:] == fragment[:-1], self._rank(ids[:-1], ids[1:]), _NONE)
            heads = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
            sizes = np.diff(np.concatenate([heads, [len(ids)]]))
            least = np.minimum.reduceat(rank, heads)
            over = np.repeat(least == _NONE, sizes)
            if over.any():
                done.append((fragment[over], ids[over]))
            chosen = ~over & (rank == np.repeat(least, sizes))
            run = np.flatnonzero(chosen)
            fresh = np.concatenate([[True], np.diff(run) > 1]) if len(run) else np.zeros(0, bool)
            start = np.maximum.accumulate(np.where(fresh, run, 0)) if len(run) else run
            run = run[(run - start) % 2 == 0]  # of overlapping places (x x x) the leftmost, then every second one
            ids[run] = self.made[rank[run]]
            keep = ~over
            keep[run + 1] = False
            ids, fragment = ids[keep], fragment[keep]
        at, values = np.concatenate([f for f, _ in done]), np.concatenate([v for _, v in done])
        return values[np.argsort(at, kind="stable")], np.bincount(at, minlength=len(first))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as bytes."""
        if not words:
            return []
        symbols, first = self.cut(words)
        ids, counts = self.merge(symbols, first)
        ends = np.cumsum([len(w) for w in words])
        before = np.concatenate([[0], np.cumsum(counts)])
        bounds = (4 * before[np.searchsorted(first, ends, "left")]).tolist()  # a word's end is a certain cut
        raw = ids.astype("<u4").tobytes()
        return [raw[a:b] for a, b in zip([0, *bounds], bounds)]

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        split = [self._words(p) for p in new]
        coded = iter(self.encode_words([w for words in split for w in words if not isinstance(w, int)]))
        ids = lambda w: np.array([w], "<u4").tobytes() if isinstance(w, int) else next(coded)
        return {p: b"".join([ids(w) for w in words]) for p, words in zip(new, split)}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as bytes."""
        lowers = self.ascii_words is not None
        split = [(t.lower() if lowers and t.isascii() and b"<|" not in t else t).split() for t in texts]
        if len(self.known) > REMEMBERED:  # what was met first is what is frequent
            self.known = dict(islice(self.known.items(), REMEMBERED // 3))
        new = self._learn(list(set().union(*split).difference(self.known)))
        long = {p for p in new if len(p) > REMEMBERED_BYTES}
        self.known.update(new)
        look = self.known.__getitem__
        out = [b"".join(map(look, words)) for words in split]
        for piece in long:
            del self.known[piece]
        return out

    def decode(self, ids: bytes) -> str:
        """Tokens joined to the ids."""
        return b" ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()


def _encode(vocabulary: Broadcast, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ForcedCutBpe.of(vocabulary)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for low, high in pieces(offsets, BATCH_BYTES):
                bounds = offsets[low : high + 1].tolist()
                ids = encoder.encode([data[a:b].tobytes() for a, b in zip(bounds, bounds[1:])])
                back = [encoder.decode(i) for i in ids] if decoded else [None] * len(ids)
                columns = [batch.column("row").slice(low, high - low), pa.array(ids, pa.binary()), pa.array(back, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "decoded"])
            release_memory()

    return run


def _vocabulary(docs: DataFrame, path: str) -> Broadcast:
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame,
    tokenizer_path: str,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    output: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """The kept columns and the ids of the text, as bytes (little-endian, 32 bits each).

    ``decoded`` names one more column for the text that the ids decode to, made by the same workers.
    """
    row = F.struct(*[plain(c).alias(f"c{i}") for i, c in enumerate(keep)])
    slim = text_of(docs.select(row.alias("row"), plain(text).alias("text")), "row").withColumnRenamed("doc_id", "row")
    out = T.StructType().add("row", slim.schema["row"].dataType).add("ids", "binary").add("decoded", "string")
    coded = slim.mapInArrow(_encode(_vocabulary(docs, tokenizer_path), decoded is not None), out)
    results = [F.col("ids").alias(output), *([F.col("decoded").alias(decoded)] if decoded else [])]
    return coded.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)], *results)


def decode(tokens: DataFrame, tokenizer_path: str, ids: str = "ids", output: str = "text") -> DataFrame:
    """Adds the text of the ids, added tokens included."""
    vocabulary = _vocabulary(tokens, tokenizer_path)

    def texts(packed: pa.Array) -> pa.Array:
        table = ForcedCutBpe.of(vocabulary)
        return pa.array([None if i is None else table.decode(i) for i in packed.to_pylist()], pa.string())

    return tokens.withColumn(output, F.arrow_udf(texts, T.StringType())(plain(ids)))


def listed(ids: str = "ids") -> F.Column:
    """Packed ids as an array of whole numbers."""

    def lists(packed: pa.Array) -> pa.Array:
        rows = [None if i is None else np.frombuffer(i, "<u4").astype(np.int32) for i in packed.to_pylist()]
        return pa.array(rows, pa.list_(pa.int32()))

    return F.arrow_udf(lists, T.ArrayType(T.IntegerType()))(plain(ids))
