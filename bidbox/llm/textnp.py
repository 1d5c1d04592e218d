"""Vectorised words, lines and rolling hashes over one Arrow batch of texts.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` (ASCII white space, so byte-level
splitting of UTF-8 is exact).  All functions work on a chunk: the concatenated bytes of
some rows, cut so that a chunk holds about ``CHUNK_BYTES`` unless one text alone is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
#: For work that holds several numbers a byte of the chunk: a worker keeps most of what it once took.
SMALL_CHUNK = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True

_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_ROLL = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX1
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX2
    return h ^ (h >> np.uint64(33))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


class Chunk:
    """Bytes of some rows laid end to end; ``offsets`` has one more entry than there are rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.rows = len(offsets) - 1
        self._sums: np.ndarray | None = None

    def row_of(self, at: np.ndarray) -> np.ndarray:
        """Row that holds each byte position."""
        return np.searchsorted(self.offsets, at, side="right") - 1

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of ``inside`` bytes that stay within a row."""
        n = len(inside)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = self.offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(~SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and rows of the ``\\n``-split lines; a text of k newlines has k + 1."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        rows = np.concatenate([np.arange(self.rows), self.row_of(breaks)])
        order = np.lexsort((starts, rows))
        starts, rows = starts[order], rows[order]
        ends = np.empty_like(starts)
        ends[:-1] = starts[1:] - 1
        last = np.ones(len(starts), bool)
        last[:-1] = rows[1:] != rows[:-1]
        ends[last] = self.offsets[rows[last] + 1]
        return starts, ends, rows

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte span, alike wherever the span lies."""
        if self._sums is None:
            up, _ = _power(len(self.data) + 1)
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(BYTE_CODE[self.data] * up[:-1], out=self._sums[1:])
        _, down = _power(len(self.data) + 1)
        return mix((self._sums[ends] - self._sums[starts]) * down[starts])


def grouped_order(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Order by owner (small integers) and then by 64-bit value: one sort of a joined key, exact by falling back on ties."""
    if not len(owner):
        return np.zeros(0, np.int64)
    bits = np.uint64(int(owner.max()).bit_length())
    if not bits:
        return np.argsort(values)
    key = (owner.astype(np.uint64) << (np.uint64(64) - bits)) | (values >> bits)
    order = np.argsort(key)
    k, v = key[order], values[order]
    if ((k[1:] == k[:-1]) & (v[1:] != v[:-1])).any():
        return np.lexsort((values, owner))
    return order


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries of ``h`` (len(h) - k + 1 values)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * _ROLL + h[j:j + n]
    return mix(out)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, Chunk]]:
    """(first row, Chunk) of consecutive rows; a null text has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield at, Chunk(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
        at = to


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's LongType."""
    return h.view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
