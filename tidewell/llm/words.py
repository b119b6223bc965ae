"""Texts of an Arrow batch as numpy arrays: words, their hashes and lines, without a Python loop over words.

A word is a run of bytes other than ``\\x20`` and ``\\x09``-``\\x0D``. All six separators are ASCII, so the byte view gives
the same words as the code point view. Null texts count as empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that end a term of ASCII letters and other characters above ASCII; the second table lets digits stand in terms too.
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
NO_LETTER_OR_DIGIT = NO_LETTER.copy()
NO_LETTER_OR_DIGIT[0x30:0x3A] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_GOLDEN = 0x9E3779B97F4A7C15


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def constants(count: int, seed: int) -> np.ndarray:
    """``count`` fixed odd 64-bit numbers."""
    steps = (np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 32)) * np.uint64(_GOLDEN)
    return mix(steps) | np.uint64(1)


_BYTE_VALUES = constants(256, 1)
_BASE = np.uint64(0xD1342543DE82EF95)
_powers = np.ones(1, np.uint64)


def powers(count: int) -> np.ndarray:
    global _powers
    if len(_powers) < count:
        grown = np.full(max(count, 2 * len(_powers)), _BASE, np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown)
    return _powers[:count]


@dataclass
class Texts:
    """Bytes of consecutive texts; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words of ``texts`` in order; those of text ``i`` are ``first[i]:first[i + 1]``."""

    texts: Texts
    in_word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, Texts]]:
    """The texts of a column in slices of about ``limit`` bytes (one text at least), each with the place of its first text."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, Texts(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def split_words(texts: Texts, separators: np.ndarray = _SPACE) -> Words:
    """Maximal runs of bytes that ``separators`` (a flag for each byte value, ASCII ones only) does not name."""
    inside = ~separators[texts.data]
    filled = np.diff(texts.offsets) > 0
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    heads = texts.offsets[:-1][filled]
    opens[heads] = inside[heads]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    tails = texts.offsets[1:][filled] - 1
    closes[tails] = inside[tails]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    text = np.searchsorted(texts.offsets, start, "right") - 1
    return Words(texts, inside, start, end, text, np.searchsorted(start, texts.offsets))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A to Z in lower case and all others as they are."""
    return _LOWER[data]


def word_bytes(words: Words) -> pa.LargeBinaryArray:
    """The words in order, A to Z in lower case; every word is exact, so Arrow's dictionaries count and compare them without hashes of ours."""
    offsets = np.concatenate([[0], np.cumsum(words.end - words.start)]).astype(np.int64)
    data = lower_ascii(words.texts.data[words.in_word])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words.start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order and do not overlap."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    values = _BYTE_VALUES[data[np.repeat(start, size) + place]] * powers(int(size.max()))[place]
    full = size > 0
    sums = np.zeros(len(size), np.uint64)
    sums[full] = np.add.reduceat(values, (np.cumsum(size) - size)[full])
    return mix(sums + size.astype(np.uint64) * np.uint64(_GOLDEN))


def word_hashes(words: Words) -> np.ndarray:
    return span_hashes(words.texts.data, words.start, words.end)


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside a text and their bounds by text.

    A text with fewer words, but at least one, has one shingle made of all its words.
    """
    count = np.diff(first)
    sizes = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
    at = np.repeat(first[:-1], sizes) + place
    reach = np.repeat(np.minimum(count, width), sizes)
    total = reach.astype(np.uint64)
    for step, factor in enumerate(constants(width, 2)):
        there = step < reach
        total[there] += hashes[at[there] + step] * factor
    return mix(total), bounds
