"""Words and word windows of Arrow text batches as 64-bit numbers, computed on whole buffers with numpy.

A word's number is a sum of numbers that each byte has at each place, a window's number a polynomial over
its words, both modulo 2^64 and mixed afterwards. (A polynomial over bytes would not do: modulo 2^64 there are
words of some thousand bytes that have the same number under every odd base.) All functions work on pieces of
bounded size, so one very long text costs eight bytes per word and no more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
U64 = np.uint64

_bytes = np.arange(256)
#: Lower-cased letters, digits and everything beyond ASCII.
ALNUM = ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80)
ALNUM |= (_bytes >= 0x41) & (_bytes <= 0x5A)  # these are lowered first
#: Everything but blank, tab, line feed, vertical tab, form feed and carriage return.
NON_SPACE = ~((_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D)))
LOWER = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes).astype(np.uint8)
SAME = _bytes.astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads a 64-bit number over all bits (a bijection)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _odd(seed: int) -> int:
    return int(mix(np.array([seed], dtype=U64))[0]) | 1


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as far as they were asked for."""

    def __init__(self, base: int) -> None:
        self.base = base
        self.up, self.down = np.ones(1, U64), np.ones(1, U64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            inverse = pow(self.base, -1, 1 << 64)
            self.up = np.cumprod(np.r_[U64(1), np.full(n, self.base, U64)])
            self.down = np.cumprod(np.r_[U64(1), np.full(n, inverse, U64)])



def _byte_numbers(byte_and_place: np.ndarray) -> np.ndarray:
    """The number of a byte at a place, which are given as byte + 256 * place."""
    return mix((byte_and_place.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15))


_NEAR_PLACES = 32
_NEAR_NUMBERS = _byte_numbers(np.arange(256 * _NEAR_PLACES))
_WORD_POWERS = (_Powers(_odd(23)), _Powers(_odd(37)))


@dataclass
class Words:
    """Words of several texts, in order. ``first[d]:first[d + 1]`` are those of text d."""

    numbers: np.ndarray
    starts: np.ndarray  # byte offsets in the buffer
    ends: np.ndarray
    first: np.ndarray

    @property
    def stop(self) -> np.ndarray:
        """For each word, where its text's words end."""
        return np.repeat(self.first[1:], np.diff(self.first))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text array; a NULL is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one text."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, min(end, n)
        row = end


def _word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    chars = data[keep]
    first = np.cumsum(lengths) - lengths
    place = 256 * (np.arange(len(chars)) - np.repeat(first, lengths)) + chars
    numbers = _NEAR_NUMBERS[np.minimum(place, len(_NEAR_NUMBERS) - 1)]
    far = np.flatnonzero(place >= len(_NEAR_NUMBERS))
    numbers[far] = _byte_numbers(place[far])
    return mix(np.add.reduceat(numbers, first) + lengths.astype(U64))


def _piece_words(data: np.ndarray, heads: np.ndarray, word_bytes: np.ndarray, fold: np.ndarray):
    """Words of a piece; ``heads`` are the offsets at which texts begin."""
    data = fold[data]
    keep = word_bytes[data]
    before, after = np.zeros_like(keep), np.zeros_like(keep)
    before[1:], after[:-1] = keep[:-1], keep[1:]
    heads = heads[(heads > 0) & (heads < len(data))]
    before[heads] = False
    after[heads - 1] = False
    starts, ends = np.flatnonzero(keep & ~before), np.flatnonzero(keep & ~after) + 1
    if not len(starts):
        return np.zeros(0, U64), starts, ends
    return _word_numbers(data, starts, ends, keep), starts, ends


def find_words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, fold: np.ndarray = SAME) -> Words:
    """Words of the texts between the offsets: longest runs of ``word_bytes`` after folding."""
    base, end = int(offsets[0]), int(offsets[-1])
    numbers, starts, ends = [], [], []
    at = base
    while at < end:
        stop = min(end, at + 4 * PIECE_BYTES)
        if stop < end:  # not inside a word, if it has an end within reach
            free = np.flatnonzero(~word_bytes[fold[data[at:stop]]])
            while not len(free) and stop < end:
                stop = min(end, 2 * stop - at)
                free = np.flatnonzero(~word_bytes[fold[data[at:stop]]])
            if stop < end:
                stop = at + int(free[-1]) + 1
        n, s, e = _piece_words(data[at:stop], offsets - at, word_bytes, fold)
        numbers.append(n), starts.append(s + at), ends.append(e + at)
        at = stop
    if not numbers:
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, U64), empty, empty, np.zeros(len(offsets), np.int64))
    all_starts = np.concatenate(starts)
    return Words(np.concatenate(numbers), all_starts, np.concatenate(ends), np.searchsorted(all_starts, offsets))


def window_numbers(numbers: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """A number for each window of ``length`` consecutive words, whichever texts they belong to."""
    n = len(numbers) - length + 1
    if n < 1:
        return np.zeros(0, U64)
    powers = _WORD_POWERS[which]
    powers.upto(len(numbers) + 1)
    sums = np.zeros(len(numbers) + 1, U64)
    np.cumsum(numbers * powers.up[: len(numbers)], out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * powers.down[:n] + U64(length))


def window_starts(words: Words, length: int) -> np.ndarray:
    """Indexes of the words at which a window of one text begins."""
    return np.flatnonzero(np.arange(len(words.numbers)) + length <= words.stop)
