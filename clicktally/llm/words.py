"""Words and shingles of whole Arrow string columns, found by numpy on the raw UTF-8 bytes.

A text is never cut and never becomes one Python object per word. A document column is walked
through in runs of whole documents of about ``RUN_BYTES``, so that memory follows the longest
document and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20

_U = np.uint64
_random = np.random.default_rng(20240501)
_LETTER = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_PLACE = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _byte_class(separators: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for low, high in separators:
        table[low : high + 1] = False
    table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]  # letters are lower-cased first
    return table


#: Which bytes belong to a word. Bytes of characters beyond ASCII always do.
BLANK_SEPARATED = _byte_class([(0x20, 0x20), (0x09, 0x0D)])
ALPHANUMERIC = _byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_HASHED = _LETTER[_LOWER]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


@dataclass
class Run:
    """Words of some consecutive documents: ``first`` is the row of the first one."""

    first: int
    data: np.ndarray  # the documents' bytes
    offsets: np.ndarray  # of the documents in data, one more than documents
    starts: np.ndarray  # of the words in data
    ends: np.ndarray
    hashes: np.ndarray  # 64 bits per word, A-Z lower-cased
    bounds: np.ndarray  # document i has the words bounds[i]:bounds[i + 1]

    def __len__(self) -> int:
        return len(self.offsets) - 1


_powers = [np.ones(1, dtype=np.uint64)] * 2


def _power_tables(n: int) -> list[np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, RUN_BYTES + 1)
        _powers = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b))]) for b in (_BASE, _INVERSE)]
    return _powers


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each row begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(column: pa.Array | pa.ChunkedArray, inside: np.ndarray, size: int = RUN_BYTES) -> Iterator[Run]:
    """All documents of a column in runs of at least ``size`` bytes (the last may be smaller)."""
    data, offsets = raw(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, min(rows, int(np.searchsorted(offsets, offsets[row] + size, "left"))))
        yield _run(row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row], inside)
        row = stop


def _run(first: int, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Run:
    n = len(data)
    word = inside[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    before[:1] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:n]))
    after = np.empty(n, dtype=bool)
    after[-1:] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    power, inverse = _power_tables(n + 1)
    summed = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_HASHED[data] * power[:n], out=summed[1:])
    hashes = mix((summed[ends] - summed[starts]) * inverse[starts])
    return Run(first, data, offsets, starts, ends, hashes, np.searchsorted(starts, offsets))


def shingles(run: Run, size: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of every document of a run.

    A shingle is ``size`` consecutive words; a document of fewer words has one, of all its words;
    a document without words has none.
    """
    words, bounds = run.hashes, run.bounds
    full = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for place in range(size if len(full) else 0):
        full += words[place : place + len(full)] * _PLACE[place]
    full = mix(full + _U(size))
    for i in range(len(run)):
        low, high = int(bounds[i]), int(bounds[i + 1])
        if high - low >= size:
            found = np.sort(full[low : high - size + 1])
            yield run.first + i, found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif high > low:
            short = (words[low:high] * _PLACE[: high - low]).sum(dtype=np.uint64) + _U(high - low)
            yield run.first + i, mix(np.array([short], dtype=np.uint64))
        else:
            yield run.first + i, full[:0]


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches of about ``size`` bytes of one string column."""
    for batch in batches:
        offsets = raw(batch.column(column))[1]
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, min(batch.num_rows, int(np.searchsorted(offsets, offsets[row] + size, "left"))))
            yield batch.slice(row, stop - row)
            row = stop
