"""Embedding near-dedup by product quantisation: inverted lists, residual codes, exact rerank.

*Coarse lists and codes.* k-means centroids, and per subspace code words of the
residuals, are fitted on the driver to a bounded sample of unit vectors; every
vector is then assigned to its nearest centroid and coded, with the length of
its quantisation error kept beside the code.

*Sufficient probes.* Two unit vectors with a cosine of at least ``least`` lie
within r = sqrt(2 - 2 * least). Where one belongs to list o and the other to c, the
plane between o and c is between them, so their distances to it, each
(|q - c|^2 - |q - o|^2) / (2 |c - o|), add up to r at most, and one of the two is r / 2
at most. So every vector probes the lists whose planes are within r / 2, and a
pair is found from one end at least, whatever the vectors are. It counts for both
ends, once: where both find it, from the end with the smaller id.

*Asymmetric distances.* In a list, the distance from q to each coded vector is a
sum of table look-ups; it is at most the code's own error away from the true
distance, so a pair goes to the exact cosine exactly if look-up distance <= r + error.
No pair of a probed list is lost.

Equal vectors collapse first and count with their multiplicity. A list is cut
into blocks of bounded size, and so are the vectors that probe it; a task
compares one block of each and returns a number of links per vector and a
spanning star per component it saw, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _scan
from ._scan import U64
from ._spark import components, cut

COSINE = 0.95
SAMPLE = 20_000
SAMPLE_BYTES = 32 << 20
MOST_LISTS = 4096
LIST_SIZE = 1024
#: Parts in which the share of sampled vectors is counted.
FINE = 1 << 40
SUBSPACES, WORDS = 8, 64
MEMBERS, PROBERS = 2048, 4096


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, dim, d1, d2, vec): the components in bytes, as floats where that loses nothing, with two hashes of them as doubles; no vec where it can't link."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            lists = part.column(1)
            n = len(lists)
            size = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            flat = np.asarray(lists.flatten().fill_null(float("nan")), dtype=np.float64) + 0.0  # makes -0.0 0.0
            doc = np.repeat(np.arange(n), size)
            with np.errstate(over="ignore", invalid="ignore"):
                square = np.bincount(doc, np.square(flat), n)
            good = (size > 0) & np.isfinite(square) & (square > 0)
            ends = np.cumsum(size)
            raw = flat.view(U64)
            d1, d2 = (_scan.signed(_scan.span_hash(_scan.mix(raw), ends - size, ends, b)) for b in _scan.WORD_BASES)
            short = flat.astype(np.float32)
            bits = np.append(0, np.cumsum(short.astype(np.float64) != flat))
            thin = bits[ends] == bits[ends - size]
            blobs = [(short if t else flat)[a:b].tobytes() if g else None for a, b, g, t in zip((ends - size).tolist(), ends.tolist(), good.tolist(), thin.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.where(good, size, 0), pa.int32()), pa.array(d1), pa.array(d2), pa.array(blobs, pa.binary())], names=["id", "dim", "d1", "d2", "vec"]
            )


def kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """k centroids, seeded by rows at even steps."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(x, c)
        count = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[count > 0] = total[count > 0] / count[count > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([((c * c).sum(1) - 2 * x[i : i + 2048] @ c.T).argmin(1) for i in range(0, len(x), 2048)]) if len(x) else np.zeros(0, int)


@dataclass
class Index:
    """Coarse centroids, and code words per subspace (``cuts``: where subspaces begin and end)."""

    centroids: np.ndarray
    words: list[np.ndarray]
    cuts: list[int]
    least: float

    @property
    def radius(self) -> float:
        return math.sqrt(max(0.0, 2 - 2 * self.least)) + 1e-7

    def code(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, error length) of residuals."""
        codes = np.stack([nearest(residual[:, a:b], w) for a, b, w in zip(self.cuts, self.cuts[1:], self.words, strict=False)], 1).astype(np.uint8)
        rest = residual - np.concatenate([w[codes[:, j]] for j, w in enumerate(self.words)], 1)
        return codes, np.sqrt((rest * rest).sum(1))

    def tables(self, residual: np.ndarray) -> list[np.ndarray]:
        """Per subspace, the squared distances of each residual to each code word."""
        return [((residual[:, None, a:b] - w[None]) ** 2).sum(2) for a, b, w in zip(self.cuts, self.cuts[1:], self.words, strict=False)]

    def apart(self) -> np.ndarray:
        """The distances between centroids, which a task makes once for all its batches."""
        square = (self.centroids**2).sum(1)
        return np.sqrt(np.maximum(square[:, None] + square - 2 * self.centroids @ self.centroids.T, 0))

    def probes(self, x: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
        """(own list, lists to probe) of each unit vector; of two linked vectors one at least probes the other's list."""
        apart = self.apart() if apart is None else apart
        d2 = np.maximum((x * x).sum(1)[:, None] + (self.centroids**2).sum(1) - 2 * x @ self.centroids.T, 0)
        own = d2.argmin(1)
        need = d2 - d2[np.arange(len(x)), own][:, None] <= self.radius * apart[own] + 1e-9
        need[np.arange(len(x)), own] = True
        return own, [np.flatnonzero(r) for r in need]


def fit(x: np.ndarray, least: float, lists: int) -> Index:
    """An index for unit vectors, from a sample of them."""
    dim = x.shape[1]
    c = kmeans(x, lists)
    residual = x - c[nearest(x, c)]
    cuts = [dim * j // min(SUBSPACES, dim) for j in range(min(SUBSPACES, dim) + 1)]
    return Index(c, [kmeans(residual[:, a:b], WORDS) for a, b in zip(cuts, cuts[1:])], cuts, least)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one length as doubles, from bytes of floats or doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, offs = _scan.raw_buffers(column)
    size = np.diff(offs)
    if (size == size[0]).all():
        return data.view(np.float32 if size[0] == 4 * dim else np.float64).reshape(-1, dim).astype(np.float64)
    return np.stack([data[a:b].view(np.float32 if b - a == 4 * dim else np.float64).astype(np.float64) for a, b in zip(offs, offs[1:])])


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(1))[:, None]


def _bits(probes: np.ndarray, lists: int) -> bytes:
    mask = np.zeros(lists, bool)
    mask[probes] = True
    return np.packbits(mask).tobytes()


def _assign(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                apart = index.apart() if apart is None else apart
                part = batch.slice(at, 1024)
                u = _unit(_vectors(part.column(2), index.centroids.shape[1]))
                own, probes = index.probes(u, apart)
                codes, error = index.code(u - index.centroids[own])
                offs = np.append(0, np.cumsum([len(p) for p in probes]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns, pa.array(own, pa.int32()), pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(np.concatenate(probes), pa.int32())),
                        pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error, pa.float64()), pa.array([_bits(p, len(index.centroids)) for p in probes], pa.binary()),
                    ],
                    names=["id", "n", "vec", "list", "probes", "codes", "error", "seen"],
                )

    return run


def stars_of_pairs(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest id, id) for the other members of each component of the pairs (a, b) of places in ids."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    a, b, low = rank[a], rank[b], np.arange(len(ids))
    while True:
        before = low.copy()
        np.minimum.at(low, a, low[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if (low == before).all():
            break
    s = ids[order]
    other = s[low] != s
    return s[low][other], s[other]


def _links(index: Index):
    """Links between one block of a list and one block of its probers."""

    def run(table: pa.Table) -> pa.Table:
        asks, own = np.asarray(table["asks"]), np.asarray(table["list"])
        ids, n, vec = np.asarray(table["id"]), np.asarray(table["n"]), _vectors(table["vec"], index.centroids.shape[1])
        q, m = np.flatnonzero(asks), np.flatnonzero(~asks)
        count = np.zeros(len(ids), np.int64)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        if len(q) and len(m):
            raw, _ = _scan.raw_buffers(table["codes"].take(pa.array(m)).combine_chunks())
            codes = raw.reshape(len(m), -1)
            seen = np.zeros((len(ids), -(-len(index.centroids) // 8)), np.uint8)
            seen[m] = _scan.raw_buffers(table["seen"].take(pa.array(m)).combine_chunks())[0].reshape(len(m), -1)
            reach = (index.radius + np.asarray(table["error"])[m]) ** 2 + 1e-9
            norm = np.sqrt((vec * vec).sum(1))
            centre = index.centroids[table["at"][0].as_py()]
            for i in range(0, len(q), 256):
                part = q[i : i + 256]
                near = np.zeros((len(part), len(m)))
                for j, t in enumerate(index.tables(vec[part] / norm[part, None] - centre)):
                    near += t[:, codes[:, j]]
                a, b = np.nonzero(near <= reach)
                a, b = part[a], m[b]
                other = ids[a] != ids[b]
                a, b = a[other], b[other]
                for k in range(0, len(a), 1 << 16):
                    x, y = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
                    hit = (vec[x] * vec[y]).sum(1) / (norm[x] * norm[y]) >= index.least
                    # of two ends that find each other the one with the smaller id counts the pair
                    hit[hit] = ((seen[y[hit], own[x[hit]] >> 3] >> (7 - (own[x[hit]] & 7)).astype(np.uint8)) & 1 == 0) | (ids[x[hit]] < ids[y[hit]])
                    if hit.any():
                        pairs.append((x[hit], y[hit]))
                        count += (np.bincount(x[hit], n[y[hit]], len(ids)) + np.bincount(y[hit], n[x[hit]], len(ids))).astype(np.int64)
        low = high = np.zeros(0, np.int64)
        if pairs:
            # a vector may be here both as prober and as member
            u, place = np.unique(ids, return_inverse=True)
            low, high = stars_of_pairs(u, *(place[np.concatenate(x)] for x in zip(*pairs, strict=True)))
        has = np.flatnonzero(count)
        return pa.table({
            "id": pa.array(np.append(ids[has], low)), "links": pa.array(np.append(count[has], np.zeros(len(low), np.int64))),
            "b": pa.array(np.append(np.zeros(len(has), np.int64), high), mask=np.append(np.ones(len(has), bool), np.zeros(len(low), bool))),
        })

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = COSINE, sample: int = SAMPLE, lists: int | None = None) -> DataFrame:
    """(id, n_links, component_id, kept), one row per input row.

    Vectors link if their cosine in double precision is ``least`` or more.
    Those that are null, empty, zero or hold null or non-finite components link
    with nothing; vectors of different lengths don't link. Equal vectors link
    with each other. ``component_id`` is the smallest id reachable by links, and
    the row with that id is kept. Rows that repeat an id count as vectors of
    their own in ``n_links`` and links, whether their vectors are equal or not. An empty table gives an empty result; further
    columns are ignored. ``sample``: how many vectors the index is fitted to at
    most; ``lists``: number of inverted lists, one per about
    ``LIST_SIZE`` vectors by default.
    """
    ready = cut(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(_prepare, "id long, dim int, d1 long, d2 long, vec binary"))
    classes = cut(ready.where("vec is not null and id is not null").groupBy("dim", "d1", "d2").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n")).withColumn("key", F.monotonically_increasing_id()))
    # classes go by keys of their own up to the end, since an id may be the smallest of several
    heads = classes.select(F.col("class_id").alias("id"), "dim", "d1", "d2", "n", "key")
    reps = ready.join(heads, ["id", "dim", "d1", "d2"]).dropDuplicates(["key"]).select(F.col("key").alias("id"), "n", "vec", "dim")
    found = None
    for dim, total in sorted((r["dim"], r["count"]) for r in classes.groupBy("dim").count().collect()):  # one row per length of vectors
        some = min(sample, max(256, SAMPLE_BYTES // (8 * dim)))
        own = reps.where(F.col("dim") == dim).drop("dim")
        share = -(-min(some, total) * FINE // total)
        def rows(df: DataFrame, dim: int = dim) -> list[np.ndarray]:
            return [np.frombuffer(r["vec"], np.float32 if len(r["vec"]) == 4 * dim else np.float64).astype(np.float64) for r in df.orderBy("id").select("vec").collect()]

        x = rows(own.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(FINE)) < share))
        index = fit(_unit(np.stack(x)), least, lists or max(1, min(MOST_LISTS, -(-total // LIST_SIZE))))
        at = cut(own.mapInArrow(_assign(index), "id long, n long, vec binary, list int, probes array<int>, codes binary, error double, seen binary"))
        inside = at.groupBy("list").agg(F.count(F.lit(1)).alias("members")).withColumnRenamed("list", "at")
        asking = at.select(F.explode("probes").alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("probers"))
        size = F.broadcast(inside.join(asking, "at").select(  # at most one row per list
            "at", F.ceil(F.col("members") / MEMBERS).cast("int").alias("mb"), F.ceil(F.col("probers") / PROBERS).cast("int").alias("qb")
        ))
        member = at.select("id", "n", "vec", "codes", "error", "seen", "list", F.col("list").alias("at"), F.lit(False).alias("asks")).join(size, "at")
        prober = at.select("id", "n", "vec", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"), F.lit(None).cast("binary").alias("seen"), "list", F.explode("probes").alias("at"), F.lit(True).alias("asks")).join(size, "at")
        slot = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        member = member.select("id", "n", "vec", "codes", "error", "seen", "list", "at", "asks", slot("mb").alias("m"), every("qb").alias("q"))
        prober = prober.select("id", "n", "vec", "codes", "error", "seen", "list", "at", "asks", every("mb").alias("m"), slot("qb").alias("q"))
        part = cut(member.union(prober).groupBy("at", "m", "q").applyInArrow(_links(index), "id long, links long, b long"))
        found = part if found is None else found.union(part)
    if found is None:
        return ready.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = found.where("b is null").groupBy("id").agg(F.sum("links").alias("links"))
    of = components(found.where("b is not null").select(F.col("id").alias("a"), "b"))
    known = (
        classes.join(links.withColumnRenamed("id", "key"), "key", "left").join(of.withColumnRenamed("node", "key"), "key", "left")
        .select("dim", "d1", "d2", "class_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "key").alias("root"))
    )
    known = known.join(known.groupBy("root").agg(F.min("class_id").alias("component")), "root").drop("root", "class_id")
    out = ready.drop("vec").join(known, ["dim", "d1", "d2"], "left")
    linked = F.col("id").isNotNull() & (F.col("dim") > 0)
    component = F.coalesce(F.when(linked, F.col("component")), F.col("id"))
    return out.select("id", F.coalesce(F.when(linked, F.col("n_links")), F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
