"""Document fingerprints as invertible Bloom lookup tables of paragraphs (operator 13).

A document is cut into paragraphs, each becomes a 64-bit digest, and the
table's cells add up the digests that fall into them. Of two versions the cells are
subtracted: what they share is gone, and what differs is peeled out of cells that hold one digest
alone. Where that gets stuck, both versions get a larger table.

All documents of a chunk are worked on at once as arrays: digests by prefix sums over the bytes,
cells by one scatter, peeling in rounds over all pairs that are left.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np

from ._scan import BYTE_BASES, U64, Chunk, Words, mix, span_hash, word_hashes, words

#: Cells of a fingerprint: three parts, in each of which a digest has one cell.
CELLS, PARTS = 24, 3
#: How much larger the table of the next attempt is.
GROWTH = 4
#: A line of more words is cut after words whose hash divides by this, so that a change leaves what is far from it.
PIECE = 8
#: Cells that are worked on at once.
MOST_CELLS = 1 << 20
#: Attempts with ever larger tables that never stick but by an accident of their hashes.
MOST_ATTEMPTS = 40
_NTH, _CHECK, _CELL = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F)


@dataclass
class Items:
    """Digests of documents: those of document i are ``digests[offs[i]:offs[i + 1]]``, all different there."""

    digests: np.ndarray
    offs: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offs) - 1), np.diff(self.offs))

    def take(self, rows: np.ndarray) -> Items:
        """The documents at these places, in this order, repeated where they are."""
        sizes = np.diff(self.offs)[rows]
        offs = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(offs[-1]) - np.repeat(offs[:-1], sizes) + np.repeat(self.offs[rows], sizes)
        return Items(self.digests[at], offs)


def paragraphs(chunk: Chunk, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(starts, offs): where the paragraphs of each document begin; together they are its bytes, white space going with what it follows.

    A paragraph ends at a line break and, within a line, after a word
    whose hash divides by ``piece``: the same words are cut alike wherever they stand.
    """
    w: Words = words(chunk)
    n = len(w.starts)
    lines = np.concatenate([[0], np.cumsum(chunk.data == 0x0A)])
    begins = np.zeros(n, bool)
    if n:
        begins[1:] = (lines[w.starts[1:]] > lines[w.ends[:-1]]) | (word_hashes(chunk, w)[:-1] % U64(piece) == 0)
    first = np.zeros(n + 1, bool)
    first[w.offs] = True  # a document's first word begins with the document
    starts = np.union1d(w.starts[begins & ~first[:n]], chunk.offs[:-1][np.diff(chunk.offs) > 0])
    return starts, np.searchsorted(starts, chunk.offs)


def digests(chunk: Chunk, piece: int = PIECE) -> Items:
    """One digest per paragraph, of its bytes and of how many equal ones lie before it in the document."""
    starts, offs = paragraphs(chunk, piece)
    ends = np.append(starts, len(chunk.data))[1:]
    h = span_hash(chunk.data.astype(U64) + U64(1), starts, ends, BYTE_BASES[1])
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    order = np.lexsort((h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    run = np.flatnonzero(new)
    nth = np.arange(len(h)) - np.repeat(run, np.diff(np.append(run, len(h))))
    d = mix(h[order] + U64(1) + nth.astype(U64) * _NTH)
    again = np.lexsort((d, doc[order]))  # all different, but for an accident
    d, of = d[again], doc[order][again]
    keep = np.ones(len(d), bool)
    keep[1:] = (d[1:] != d[:-1]) | (of[1:] != of[:-1])
    return Items(d[keep], np.searchsorted(of[keep], np.arange(len(offs))))


def places(d: np.ndarray, cells: int) -> np.ndarray:
    """(PARTS, n): each digest's cell in each part; other sizes of table deal them out otherwise."""
    part, salt = U64(cells // PARTS), int(_CELL)
    return np.stack([mix(d + U64(((p + 1) * salt + cells) % (1 << 64))) % part + U64(p) * part for p in range(PARTS)]).astype(np.int64)


def checks(d: np.ndarray) -> np.ndarray:
    return mix(d ^ _CHECK)


@dataclass
class Tables:
    """Tables of documents, a row each: per cell the number of digests, their sum and the sum of their checks, modulo 2^64."""

    count: np.ndarray
    key: np.ndarray
    check: np.ndarray

    def minus(self, other: Tables) -> Tables:
        return Tables(self.count - other.count, self.key - other.key, self.check - other.check)

    def text(self, row: int) -> str:
        """One table as text, little-endian counts, sums and checks."""
        return base64.b64encode(self.count[row].astype("<i4").tobytes() + self.key[row].astype("<u8").tobytes() + self.check[row].astype("<u8").tobytes()).decode()


def tables(items: Items, cells: int) -> Tables:
    n = len(items.offs) - 1
    out = Tables(np.zeros((n, cells), np.int64), np.zeros((n, cells), U64), np.zeros((n, cells), U64))
    add(out, items.owner, items.digests, np.ones(len(items.digests), np.int64))
    return out


def add(t: Tables, row: np.ndarray, d: np.ndarray, times: np.ndarray) -> None:
    """Put digests into the rows' tables so many times (-1 takes one out)."""
    cells = t.count.shape[1]
    c, sign = checks(d), times.astype(U64)
    for p in places(d, cells):
        at = row * cells + p
        np.add.at(t.count.reshape(-1), at, times)
        np.add.at(t.key.reshape(-1), at, d * sign)
        np.add.at(t.check.reshape(-1), at, c * sign)


def peel(t: Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(done per row, row, digest, side) of differences of tables: side 1 is only in the first version, -1 only in the second.

    In each round all cells with one digest alone give it up, and it is taken out of its other
    cells, which may leave new ones alone. ``t`` is used up.
    """
    cells = t.count.shape[1]
    rows, found, sides = [], [], []
    look = np.flatnonzero(t.count.reshape(-1))
    while len(look):
        n = t.count.reshape(-1)[look]
        look = look[np.abs(n) == 1]
        side = t.count.reshape(-1)[look]
        d = t.key.reshape(-1)[look] * side.astype(U64)
        row = look // cells
        alone = (t.check.reshape(-1)[look] == checks(d) * side.astype(U64)) & (places(d, cells) == look % cells).any(axis=0)
        one = np.unique(np.stack([row[alone], d[alone].view(np.int64), side[alone]]), axis=1)  # several cells may give the same one
        if not one.shape[1]:
            break
        row, d, side = one[0], np.ascontiguousarray(one[1]).view(U64), one[2]
        add(t, row, d, -side)
        rows.append(row)
        found.append(d)
        sides.append(side)
        look = np.unique(row * cells + places(d, cells))
    done = ~(t.count.any(axis=1) | t.key.any(axis=1) | t.check.any(axis=1))
    none = np.zeros(0, np.int64)
    row, d, side = (np.concatenate(v) if v else e for v, e in ((rows, none), (found, none.view(U64)), (sides, none)))
    mine = done[row]
    return done, row[mine], d[mine], side[mine]


@dataclass
class Differences:
    """Per pair the digests in only one version (``row``, ``digest``, ``side``) and the ``cells`` of the table that gave them up."""

    row: np.ndarray
    digest: np.ndarray
    side: np.ndarray
    cells: np.ndarray


def differences(a: Items, b: Items, cells: int = CELLS) -> Differences:
    """Subtract the tables of the versions of each pair and peel; pairs that stick get a table ``GROWTH`` times as large, until none is left."""
    pairs = len(a.offs) - 1
    left, used, got = np.arange(pairs), np.zeros(pairs, np.int64), []
    for _ in range(MOST_ATTEMPTS):
        stuck = []
        for at in range(0, len(left), max(1, MOST_CELLS // cells)):
            some = left[at : at + max(1, MOST_CELLS // cells)]
            done, row, d, side = peel(tables(a.take(some), cells).minus(tables(b.take(some), cells)))
            got.append((some[row], d, side))
            used[some[done]] = cells
            stuck.append(some[~done])
        left = np.concatenate(stuck) if stuck else left[:0]
        if not len(left):
            break
        # beyond what any of them could differ by, a slightly larger table has other hashes and does as well as a much larger one
        most = int((np.diff(a.offs)[left] + np.diff(b.offs)[left]).max())
        cells = cells * GROWTH if cells < 8 * most else cells + PARTS
    else:
        raise RuntimeError(f"differences of {len(left)} pairs did not come out in {MOST_ATTEMPTS} tables")
    row, d, side = (np.concatenate(v) for v in zip(*got, strict=True)) if got else (np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64))
    return Differences(row, d, side, used)


def likeness(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Shared paragraphs over all of both, from the numbers of paragraphs and of those that differ; 1 for two empty texts."""
    both, every = (a + b - apart) / 2, (a + b + apart) / 2
    return np.divide(both, every, out=np.ones(len(a)), where=every > 0)
