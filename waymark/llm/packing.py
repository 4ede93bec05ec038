"""Packing token sequences into windows by non-negative least squares.

Documents are tokenised once, each closed by a separator id. Whole windows are
cut off a document from its start; what is left, its tail, is shorter than a window.
The histogram of tail lengths (one number per length, so bounded by the window
whatever the corpus) goes to the driver, which

1. enumerates shallow combinations, pairs and triples of lengths that fill a
   window exactly;
2. solves repeat counts x >= 0 that minimise |A x - histogram| by
   multiplicative updates, where A says how often a combination uses a length;
3. rounds them down, never using more tails than there are, and takes greedily
   what still fits;
4. packs the residual tails greedily end to end, longest first, cutting one
   wherever a window is full. The last, unfilled window is cut into sequences of
   powers of two, which need no padding.

The plan is a table of at most some thousand intervals of ranks per length. Each
tail gets its rank among the tails of its length from counts per (length,
hash bucket), so a length that a third of all documents have is ranked in many
tasks, and finds its sequence and offset by its rank alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _scan, bpe
from ._spark import cut, partitions

WINDOW = 1024
TRIPLES = 24
PIECES = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECES = pa.schema([(x.split()[0], pa.int64()) for x in PIECES.split(", ")])


@dataclass
class Plan:
    """Intervals of ranks per length: those from ``low[i]`` on have ``first[i]`` + (rank - low) as sequence, at ``offset[i]``.

    ``used[l]``: ranks from there on are residual; the q-th of them lies at
    ``base[l]`` + q * l of the residual stream, whose sequences start at ``ends``.
    """

    length: np.ndarray
    low: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    used: np.ndarray
    base: np.ndarray
    planned: int
    window: int
    residual: int

    def bounds(self) -> np.ndarray:
        """Where the residual's sequences that aren't whole windows begin and end: powers of two, largest first."""
        at = [self.residual // self.window * self.window]
        rest = self.residual - at[0]
        while rest:
            at.append(at[-1] + (1 << (rest.bit_length() - 1)))
            rest -= at[-1] - at[-2]
        return np.array(at)

    @property
    def sequences(self) -> int:
        return self.planned + self.residual // self.window + len(self.bounds()) - 1


def combinations(histogram: np.ndarray, window: int, triples: int = TRIPLES) -> np.ndarray:
    """Rows of three lengths (0: none) that sum to the window; for triples, each length with the ``triples`` most frequent ones."""
    have = np.flatnonzero(histogram)
    pairs = [(a, window - a, 0) for a in have.tolist() if a <= window - a and histogram[window - a]]
    common = have[np.argsort(-histogram[have], kind="stable")[:triples]].tolist()
    three = {tuple(sorted((a, b, window - a - b))) for a in have.tolist() for b in common if 0 < window - a - b < window and histogram[window - a - b]}
    return np.array([*pairs, *sorted(three)], np.int64).reshape(-1, 3)


def nnls(combos: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 near the least squares of A x = histogram."""
    h = histogram.astype(float)
    use = combos > 0

    def project(x: np.ndarray) -> np.ndarray:  # A x
        return np.bincount(combos.ravel(), (use * x[:, None]).ravel(), len(h))

    def back(r: np.ndarray) -> np.ndarray:  # A' r
        return (r[combos] * use).sum(1)

    x = np.where(use, h[combos], np.inf).min(1) / 3
    target = back(h)
    for _ in range(rounds):
        x *= target / np.maximum(back(project(x)), 1e-12)
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> Plan:
    """histogram[l]: how many tails have length l, for l below the window."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    combos = combinations(left, window)
    rows: list[tuple[int, int, int, int]] = []
    used, planned = np.zeros(len(left), np.int64), 0
    wish = np.floor(nnls(combos, left)).astype(np.int64) if len(combos) else np.zeros(0, np.int64)
    for greedy in (False, True):
        for c in np.argsort(-wish, kind="stable").tolist():
            parts = [p for p in combos[c].tolist() if p]
            n = min(left[p] // parts.count(p) for p in parts)
            n = int(n if greedy else min(n, wish[c]))
            offset = 0
            for p in parts if n > 0 else ():
                rows.append((p, int(used[p]), planned, offset))
                used[p] += n
                left[p] -= n
                offset += p
            planned += max(n, 0)
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    lengths = np.arange(len(left))
    mass = left * lengths
    base = mass[::-1].cumsum()[::-1] - mass  # longest first
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], used, base, planned, window, int(mass.sum()))


def _tokenise(name: str, separator: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = SparkFiles.get(name)
        for batch in batches:
            for c in _scan.chunks(batch.column(1)):
                ids, offs = bpe.encode(path, c)
                ids = np.insert(ids, offs[1:], separator).astype("<u4")
                at = (offs + np.arange(len(offs))).tolist()
                raw = memoryview(ids.view(np.uint8))
                crcs, tails, tail_crcs = [], [], []
                for a, b in zip(at, at[1:]):
                    whole = a + (b - a) // window * window
                    crcs.append([zlib.crc32(raw[4 * i : 4 * (i + window)]) for i in range(a, whole, window)])
                    tail = bytes(raw[4 * whole : 4 * b])
                    tail_crcs.append(zlib.crc32(tail))
                    tails.append(np.frombuffer(tail, "<u4").astype("<u2").tobytes() if b > whole and ids[whole:b].max() < 1 << 16 else tail)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[c.first : c.last], pa.array(np.diff(at), pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(tail_crcs, pa.int64()), pa.array(tails, pa.binary())],
                    names=["id", "doc_tokens", "crcs", "tail_crc", "tail"],
                )

    return run


def _place(p: Plan, starts: np.ndarray, whole_base: int, most_whole: int):
    """Pieces of each document from its rank; ``starts[l]``: number of documents with shorter tails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = p.length << 44 | p.low
        bounds = p.bounds()
        full = p.residual // p.window
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            tokens, rank = np.asarray(col["doc_tokens"]), np.asarray(col["rank"])
            size = tokens % p.window
            at = np.maximum(np.searchsorted(key, size << 44 | rank, "right") - 1, 0)
            out: list[tuple] = []
            for i, (doc, crcs, tail_crc, raw) in enumerate(zip(*(col[n].to_pylist() for n in ("id", "crcs", "tail_crc", "tail")), strict=True)):
                n, r, s = int(tokens[i]), int(rank[i]), int(size[i])
                first = whole_base + (int(starts[s]) + r) * most_whole
                out += [(doc, k * p.window, p.window, crc, n, first + k, 0) for k, crc in enumerate(crcs)]
                if not s:
                    continue
                if r < p.used[s]:
                    j = at[i]
                    out.append((doc, n - s, s, tail_crc, n, int(p.first[j] + r - p.low[j]), int(p.offset[j])))
                    continue
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * s else "<u4").astype("<u4")
                pos, done = int(p.base[s]) + (r - int(p.used[s])) * s, 0
                while done < s:
                    here = pos + done
                    if here < bounds[0]:
                        seq, begin, end = here // p.window, here // p.window * p.window, (here // p.window + 1) * p.window
                    else:
                        k = int(np.searchsorted(bounds, here, "right")) - 1
                        seq, begin, end = full + k, int(bounds[k]), int(bounds[k + 1])
                    take = min(s - done, end - here)
                    out.append((doc, n - s + done, take, zlib.crc32(ids[done : done + take].tobytes()), n, p.planned + seq, here - begin))
                    done += take
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 7, schema=_PIECES)

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, separator: int = 0, most: int = 0) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece.

    Every id of every document, the separator after it included, lies in
    exactly one piece; a sequence's pieces fill it gaplessly from offset 0, and
    it has ``window`` ids, or a power of two of them. Null and empty texts are
    a lone separator. Documents longer than a window give whole windows and a
    tail. Rows that repeat, or share an id, are packed each by itself. An empty
    table gives no piece; further columns are ignored. ``most``: how many
    frequent words to count for the encoder's lexicon, 0 for the vocabulary's own.
    """
    spark = docs.sparkSession
    name = bpe.lexicon(docs, tokenizer, text_col, most)
    schema = "id long, doc_tokens long, crcs array<long>, tail_crc long, tail binary"
    buckets = 4 * partitions(spark)
    told = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_tokenise(name, separator, window), schema)
    told = cut(told.withColumns({"size": (F.col("doc_tokens") % window).cast("int"), "part": F.pmod(F.xxhash64("id", "tail_crc"), F.lit(buckets)).cast("int")}))
    counts = cut(told.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("crcs")).alias("whole")))
    rows = counts.groupBy("size").agg(F.sum("n").alias("n"), F.max("whole").alias("whole")).collect()  # one row per length below the window
    histogram = np.zeros(window, np.int64)
    for r in rows:
        histogram[r["size"]] = r["n"]
    p = plan(histogram, window)
    before = counts.select("size", "part", (F.sum("n").over(Window.partitionBy("size").orderBy("part")) - F.col("n")).alias("before"))
    ranked = told.withColumn("nth", F.row_number().over(Window.partitionBy("size", "part").orderBy("id", "doc_tokens", "tail_crc")))
    ranked = ranked.join(before, ["size", "part"]).withColumn("rank", F.col("before") + F.col("nth") - 1).select("id", "doc_tokens", "crcs", "tail_crc", "tail", "rank")
    starts = np.cumsum(histogram) - histogram
    return ranked.mapInArrow(_place(p, starts, p.sequences, max([1, *(r["whole"] for r in rows)])), PIECES)
