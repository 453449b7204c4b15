"""Words and hashes of many texts at once: numpy over the bytes of an Arrow string column."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)

#: Space and the controls 9 to 13 part words.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
#: Letters: A-Z, a-z and every byte of a character beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
#: Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers up to ``n`` and their inverses modulo 2**64, kept per worker."""
    global _powers
    if len(_powers[0]) <= n:
        size = 1 << n.bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        rows = [np.full(size, x, np.uint64) for x in (_BASE, inverse)]
        for row in rows:
            row[0] = 1
            np.multiply.accumulate(row, out=row)
        _powers = rows[0], rows[1]
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def slices(batches: Iterable[pa.RecordBatch], text: int, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``most_bytes`` of text; a longer text is a slice of its own."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and the n + 1 offsets of its rows in them."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the runs of ``inside`` bytes; runs end where texts do."""
    if not len(inside):
        return (np.zeros(0, np.int64),) * 3
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    begins[offsets[:-1][full]] = inside[offsets[:-1][full]]
    ends[offsets[1:][full] - 1] = inside[offsets[1:][full] - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


class Rolling:
    """Hashes of byte ranges of one buffer, by prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        up, self._down = powers(len(data))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])


def distinct(text: np.ndarray, feature: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Each (text, feature) once, in order of text and feature."""
    keys = np.sort(text.astype(np.int64) * buckets + feature.astype(np.int64))
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys // buckets, keys % buckets


def rows_of(text: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    """Values of the texts 0 to n - 1, sorted by text, as a list column."""
    offsets = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
