"""Whole texts as byte arrays: words, word hashes and word-window hashes without a Python loop.

All functions take a batch of texts as one byte array and the offsets of its texts. A word is a
longest run of bytes outside ``separators``; UTF-8 bytes of other letters are above 127, so ASCII
separators cut texts exactly where a pattern over characters would.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
STEP = U64(0x9E3779B97F4A7C15)
_LETTERS = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)

#: Letters that are hashed at once; a longer word is on its own.
HASHED_LETTERS = 1 << 18

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Words(NamedTuple):
    """Byte ranges of words; words ``first[i]:first[i + 1]`` belong to text ``i``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.string()), "")
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def parts(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes of text each, or of one row."""
    _, offsets = text_bytes(column)
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, upto
        at = upto


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> Words:
    solid = np.zeros(len(data) + 2, dtype=bool)
    solid[1:-1] = ~separators[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """64-bit hash of each word's bytes, in steps that take a bounded part of memory beside the texts."""
    out = np.empty(len(words.starts), np.uint64)
    lengths = words.ends - words.starts
    total = np.cumsum(lengths)
    at = 0
    while at < len(out):
        upto = max(at + 1, int(np.searchsorted(total, total[at] - lengths[at] + HASHED_LETTERS, "right")))
        out[at:upto] = _hashes(data, words.starts[at:upto], lengths[at:upto])
        at = upto
    return out


def _hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    begin = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum()))
    letters = data[within + np.repeat(starts - begin, lengths)]
    within -= np.repeat(begin, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), STEP))
    values = _LETTERS[letters]
    values *= powers[within]
    return mix(np.add.reduceat(values, begin) + lengths.astype(np.uint64))


def windows(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of ``size`` words from each position on; the last ``size - 1`` positions have none.

    Another ``seed`` first mixes the words' hashes anew, so windows that agree by chance in one hash
    do not therefore agree in the other.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    terms = mix(hashes ^ mix(np.array([seed], np.uint64) * STEP)) if seed else hashes
    out = np.full(n, U64(seed * 2 + 1))
    for j in range(size):
        out = out * STEP + terms[j : j + n]
    return mix(out)


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Positions at which a whole window of ``size`` words of one text begins."""
    counts = np.diff(first)
    full = np.maximum(counts - size + 1, 0)
    begin = np.concatenate([[0], np.cumsum(full)[:-1]]) if len(full) else full
    return np.arange(int(full.sum())) - np.repeat(begin, full) + np.repeat(first[:-1], full)


def give_back() -> None:
    """Return freed memory to the system: a worker that is used again still holds what its last task took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
