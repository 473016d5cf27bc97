"""Texts packed with zstandard for shuffles, and opened again a bounded number of bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN_BYTES = 1 << 20


def _pack(texts: pa.Array) -> pa.Array:
    packer = zstandard.ZstdCompressor()
    return pa.array([packer.compress((t or "").encode()) for t in texts.to_pylist()], pa.binary())


def packed(text: str) -> Column:
    return F.arrow_udf(_pack, T.BinaryType())(text)


def opened(packs: list[bytes]) -> list[bytes]:
    opener = zstandard.ZstdDecompressor()
    return [opener.decompress(p) for p in packs]


def open_groups(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, list[bytes]]]:
    """Row ranges of a batch with their texts, about ``OPEN_BYTES`` at a time."""
    opener = zstandard.ZstdDecompressor()
    low, held, total = 0, [], 0
    for i, pack in enumerate(batch.column(column)):
        held.append(opener.decompress(pack.as_py()))
        total += len(held[-1])
        if total >= OPEN_BYTES:
            yield low, i + 1, held
            low, held, total = i + 1, [], 0
    if held:
        yield low, batch.num_rows, held


def joined_buffer(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts, and their offsets in it."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), offsets
