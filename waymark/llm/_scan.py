"""Vectorised text kernels over Arrow string buffers.

Every kernel works on one :class:`Chunk`: the UTF-8 bytes of some documents
laid end to end with their offsets, straight from the Arrow buffers (no
Python string is made). Chunks are bounded in bytes, so a worker's memory
follows the longest single document and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 20
#: Odd multipliers of the two polynomial hashes over bytes and over words.
BYTE_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
WORD_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
NO_HASH = U64(0xFFFFFFFFFFFFFFFF)

#: The white space that ends a word: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Chunk:
    """``first``/``last``: the rows of the batch; ``data``: their bytes; ``offs``: n + 1 offsets."""

    first: int
    last: int
    data: np.ndarray
    offs: np.ndarray

    def doc(self, i: int) -> bytes:
        return self.data[self.offs[i] : self.offs[i + 1]].tobytes()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def raw_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of a binary column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES, rows: int | None = None) -> Iterator[Chunk]:
    """Whole documents in runs of about ``most`` bytes, and of ``rows`` documents at most; a longer document is a chunk of its own."""
    data, offs = buffers(column)
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        j = j if rows is None else min(j, i + rows)
        yield Chunk(i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place on a copy)."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(size + 1, b, U64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=U64))
    return out[0], out[1]


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i up to ``size`` at least."""
    room = 1 << 16
    while room < size:
        room *= 2
    return _powers(base, room) if room <= 4 * CHUNK_BYTES else _powers.__wrapped__(base, size)


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span, by prefix sums of one polynomial."""
    up, down = powers(base, len(values))
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    h = total[ends]
    h -= total[starts]
    h *= down[starts]
    return mix(h)


@dataclass
class Words:
    """``starts``/``ends``: byte spans of the words; ``offs``: each document's first word, n + 1 of them."""

    starts: np.ndarray
    ends: np.ndarray
    offs: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offs)


def words(chunk: Chunk, separator: np.ndarray = SPACE) -> Words:
    """Maximal runs of bytes that aren't separators, within a document."""
    n = len(chunk.data)
    inside = ~separator[chunk.data]
    edge = np.zeros(n + 1, bool)
    edge[chunk.offs] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before &= ~edge[:n]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after &= ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, chunk.offs))


def word_hashes(chunk: Chunk, w: Words, base: int = BYTE_BASES[0]) -> np.ndarray:
    """A hash of each word's bytes and length."""
    h = span_hash(chunk.data.astype(U64) + U64(1), w.starts, w.ends, base)
    return h


def gram_hashes(word_hash: np.ndarray, offs: np.ndarray, k: int, base: int = WORD_BASES[0]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words by start word, and which starts lie k words before their document's end."""
    m = len(word_hash)
    if m < k:
        return np.zeros(0, U64), np.zeros(0, bool)
    at = np.arange(m - k + 1)
    left = np.repeat(offs[1:], np.diff(offs))[: m - k + 1] - at
    return span_hash(word_hash, at, at + k, base), left >= k


def sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of each run of ``width`` values."""
    f, have, out = (np.minimum if least else np.maximum), 1, x
    while have * 2 <= width:
        out = f(out[:-have], out[have:])
        have *= 2
    if rest := width - have:
        out = f(out[:-rest], out[rest:])
    return out


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def list_matrix(column: pa.Array, width: int) -> np.ndarray:
    """The values of a list column, all lists of ``width`` values without nulls, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
