"""Vectorised word splitting and hashing over the UTF-8 buffers of Arrow batches.

A batch of texts is one byte array with row offsets. Separators are ASCII bytes, so words are
byte ranges and no text is decoded. Word hashes come from one polynomial prefix sum per slice.
A null text counts as empty. Slices hold about ``SLICE_BYTES`` of text (one longer text makes
a slice of its own), which bounds the memory of a task by its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Separators of words ``[^\x20\x09-\x0D]+``.
BLANKS = np.zeros(256, dtype=bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Separators of lower-cased words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[:128] = True
PUNCTUATION[0x30:0x3A] = False
PUNCTUATION[0x61:0x7B] = False

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), SLICE_BYTES + 1)
        for base, name in ((_BASE, "_powers"), (_INVERSE, "_inverses")):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of one slice: row of each word, byte range in ``data``, and hash."""

    data: np.ndarray
    offsets: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    prefix: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows).astype(np.int64)

    def bounds(self) -> np.ndarray:
        """Index of the first word of each row, and the number of words at the end."""
        return np.concatenate(([0], np.cumsum(self.counts())))

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes in each range (equal bytes, equal hash, wherever they stand)."""
        _, inverses = _tables(len(self.data) + 1)
        raw = (self.prefix[end] - self.prefix[start]) * inverses[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the row offsets into them (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, index, data = column.buffers()
    offsets = np.frombuffer(index, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(offsets) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def split_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Words:
    """Words of the lower-cased texts (A-Z only), never across a row boundary."""
    data = LOWER.take(data)
    n = len(data)
    inside = ~separators.take(data)
    begins = np.zeros(n + 1, dtype=bool)
    begins[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | begins[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begins[1:n]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))
    powers, _ = _tables(n + 1)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    terms = prefix[1:]
    terms[:] = data
    terms += np.uint64(1)
    terms *= powers[:n]
    np.cumsum(terms, out=terms)
    return Words(data, offsets, row, start, end, prefix)


def word_slices(column: pa.Array, separators: np.ndarray,
                limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) for each slice of a text column."""
    data, offsets = text_buffer(column)
    for low, high in slices(offsets, limit):
        part = offsets[low:high + 1]
        yield low, high, split_words(data[part[0]:part[-1]], part - part[0], separators)


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within a row, and the row of each run.

    A row of fewer words, but not none, gives one run: its whole sequence.
    """
    n = len(hashes)
    counts = np.diff(bounds)
    if n >= width:
        runs = np.zeros(n - width + 1, dtype=np.uint64)
        for j in range(width):
            runs = mix(runs * np.uint64(0x100000001B3) + hashes[j:n - width + 1 + j])
        row = np.repeat(np.arange(len(counts)), counts)
        whole = row[:n - width + 1] == row[width - 1:]
        runs, row = runs[whole], row[:n - width + 1][whole]
    else:
        runs, row = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = np.array([_sequence(hashes[bounds[i]:bounds[i + 1]]) for i in short], dtype=np.uint64)
        runs = np.concatenate((runs, extra))
        row = np.concatenate((row, short))
        order = np.argsort(row, kind="stable")
        runs, row = runs[order], row[order]
    return runs, row


def _sequence(hashes: np.ndarray) -> int:
    value = np.full(1, len(hashes), dtype=np.uint64)
    for h in hashes:
        value = mix(value * np.uint64(0x100000001B3) + h)
    return int(value[0])
