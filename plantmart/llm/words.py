"""Words of whole texts as numpy arrays.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; these separators are single bytes in UTF-8, so working on bytes
finds exactly the words of the text. Every word gets a 64-bit hash of its bytes with A-Z lower-cased. A null text has no words.
Texts are taken in slices of about ``SLICE`` bytes and ``TEXTS`` texts at most (a longer text is one slice of its own), which bounds
memory.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE = 1 << 20
TEXTS = 2000
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
# The separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values over all places (a bijection)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
LOWERED = SYMBOL[LOWER]


_table: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(size: int) -> list[np.ndarray]:
    """BASE and its inverse modulo 2**64 to the powers 0 .. ``size`` at least; one table that grows."""
    if len(_table[0]) <= size:
        length = (1 << size.bit_length()) + 1
        for k, step in enumerate((BASE, U(pow(int(BASE), -1, 1 << 64)))):
            p = np.full(length, step, np.uint64)
            p[0] = 1
            with np.errstate(over="ignore"):
                _table[k] = np.multiply.accumulate(p)
    return _table


@dataclass
class Words:
    """Words of ``n`` texts: for each its text, its first byte and the byte after its last one in ``data``, and its hash."""

    n: int
    data: np.ndarray
    offsets: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    prefix: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Number of words before each text, and of all."""
        return np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=self.n))]).astype(np.int64)

    def prefixes(self, width: int, salt: int) -> np.ndarray:
        """Hashes of each word's first ``width`` bytes (of the whole word, if it is shorter)."""
        stop = np.minimum(self.end, self.start + width)
        return mix(_ranged(self.prefix, self.start, stop) + U(salt) * BASE)


def _ranged(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    back = _powers(len(prefix))[1]
    return (prefix[end] - prefix[start]) * back[start]


def words_of(data: np.ndarray, offsets: np.ndarray, symbols: np.ndarray = LOWERED) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``. ``symbols`` has a number for each byte; hashes are made of these."""
    n, size = len(offsets) - 1, len(data)
    word = ~IS_SPACE[data]
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < size)]
    starts[inner] |= word[inner]
    ends[inner - 1] |= word[inner - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    with np.errstate(over="ignore"):
        prefix = np.zeros(size + 1, np.uint64)
        np.cumsum(symbols[data] * _powers(size)[0][:size], out=prefix[1:])
        hashes = mix(_ranged(prefix, start, end))
    text = np.searchsorted(offsets, start, side="right") - 1
    return Words(n, data, offsets, text, start, end, hashes, prefix)


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array without copying; nulls become empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, held = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``size`` bytes: first and last position, bytes, offsets."""
    data, offsets = buffers(texts)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        to = min(to, n, at + TEXTS)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_slices(texts: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, Words]]:
    for at, to, data, offsets in slices(texts, size):
        yield at, to, words_of(data, offsets)


def remainder(doc_id, modulus: int) -> np.ndarray:
    """crc32 of the ids as decimal text, modulo ``modulus``."""
    return np.array([zlib.crc32(str(i).encode()) % modulus for i in doc_id], np.int64)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """The same as a Spark column; a null id counts as the text ``None``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("None")).cast("binary")) % modulus
