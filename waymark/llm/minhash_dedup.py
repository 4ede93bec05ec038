"""Near-dedup with DartMinHash signatures, banded joins and exact verification.

*Darts.* Every element of a weighted set owns a fixed, hashed random pattern of
darts over the plane (weight, rank), with one dart per unit of area on
average. The plane is cut into cells, in weight and in rank, whose dart counts
follow from a hash of (element, cell) by the Poisson law, so that sets that
share an element share its darts below the smaller of its two weights. A set
looks at cells of rising rank, takes the darts below each element's weight, and
each dart falls on one of ``bands * rows`` coordinates; the earliest dart of
a coordinate is its signature value. A set stops when all coordinates have one,
so large sets touch few darts per element. Two sets agree on a coordinate
with the probability of their weighted Jaccard similarity.

*Joining.* Equal sets collapse to one representative first. In a bucket of
equal bands each representative is joined to the smallest one only, so rows
grow with a bucket and not with its square. The components of these
candidate links are families: all representatives that share a bucket are in
one. Families get their shingle sets from the texts and are cut into blocks of
bounded size; a task takes two blocks of a family and finds all intersections at
once as products of incidence matrices over the shingles that occur twice or
more, so every pair of a family is compared exactly and no pair becomes a row.
A task returns only a spanning star of each component it finds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _scan
from ._scan import U64
from ._spark import components, cut

SHINGLE, BANDS, ROWS, SIMILARITY = 5, 32, 8, 0.8
#: Runs that rows are dealt over to meet the class of their equal sets.
RUNS = 256
#: A block of a family has about so many documents and shingles at most.
BLOCK_DOCS, BLOCK_SHINGLES = 2048, 2_000_000
#: The first cell's width in rank; later ones double up to the last, then repeat it.
FIRST_RANK, LAST_RANK, LAST_WEIGHT = 2.0**-5, 32.0, 16.0


def shingle_sets(c: _scan.Chunk, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, count) of the distinct shingles, by document and hash.

    A text of 1 to k - 1 words has one shingle, all of its words.
    """
    w = _scan.words(c)
    h = _scan.word_hashes(c, w)
    g, whole = _scan.gram_hashes(h, w.offs, k)
    at = np.flatnonzero(whole)
    doc = np.repeat(np.arange(len(w.counts)), w.counts)
    few = np.flatnonzero((w.counts > 0) & (w.counts < k))
    short = _scan.span_hash(h, w.offs[few], w.offs[few + 1], _scan.WORD_BASES[1])
    h, doc = np.append(g[at], short), np.append(doc[at], few)
    order = np.argsort(h, kind="stable")
    kind = np.uint16 if len(w.counts) < 1 << 16 else np.int64
    order = order[np.argsort(doc[order].astype(kind), kind="stable")]
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], h[first], np.diff(np.append(first, len(h)))


def _cells(first: float, last: float) -> Iterator[tuple[float, float]]:
    low, width = 0.0, first
    while True:
        yield low, width
        low += width
        width = min(low, last)


@lru_cache(maxsize=256)
def _poisson(area: float) -> np.ndarray:
    """Thresholds: a uniform 64-bit value below the i-th means at most i darts."""
    p, total, out = math.exp(-area), 0.0, []
    for i in range(int(area + 12 * math.sqrt(area) + 24)):
        total += p
        out.append(min(int(total * 2.0**64), 2**64 - 1))
        p *= area / (i + 1)
    return np.array(out, U64)


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> U64(11)).astype(np.float64) * 2.0**-53


def dart_signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n_docs: int, size: int) -> np.ndarray:
    """n_docs x size ranks of the earliest dart per coordinate; infinity throughout for an empty set."""
    sig = np.full(n_docs * size, np.inf)
    open_ = np.zeros(n_docs, bool)
    open_[doc] = True
    top = float(weight.max()) if len(weight) else 0.0
    for rank_no, (rank_low, rank_width) in enumerate(_cells(FIRST_RANK, LAST_RANK)):
        live = open_[doc]
        if not live.any():
            return sig.reshape(n_docs, size)
        if not live.all():
            doc, h, weight = doc[live], h[live], weight[live]
        for weight_no, (low, width) in enumerate(_cells(1.0, LAST_WEIGHT)):
            if low >= top:
                break
            has = np.flatnonzero(weight > low) if low else slice(None)
            u = _scan.mix(h[has] ^ U64((rank_no * 0x9E3779B97F4A7C15 + weight_no * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9) % 2**64))
            law = _poisson(width * rank_width)
            some = np.flatnonzero(u >= law[0])
            if not len(some):
                continue
            count = np.searchsorted(law, u[some], "right")
            which = np.repeat(some, count)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            dart = _scan.mix(u[which] + (nth.astype(U64) + U64(1)) * U64(0xD1B54A32D192ED03))
            if low or isinstance(has, np.ndarray):
                which = has[which]
            rank = rank_low + rank_width * _unit(_scan.mix(dart ^ U64(0x2545F4914F6CDD1D)))
            if width > 1 or top > 1:
                hit = low + width * _unit(_scan.mix(dart ^ U64(0x8CB92BA72F3D8DD7))) < weight[which]
                dart, rank, which = dart[hit], rank[hit], which[hit]
            np.minimum.at(sig, doc[which] * size + (dart % U64(size)).astype(np.int64), rank)
        open_ &= np.isinf(sig.reshape(n_docs, size)).any(1)
    raise AssertionError


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = np.ascontiguousarray(sig).view(U64).reshape(len(sig), bands, rows)
    factor = _scan.powers(_scan.WORD_BASES[1], rows)[0][1 : rows + 1]
    return _scan.signed(_scan.mix((_scan.mix(bits) * factor).sum(2, dtype=U64) + np.arange(bands, dtype=U64)))


def _sketch(k: int, bands: int, rows: int, counts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _scan.chunks(batch.column(1), _scan.CHUNK_BYTES // 2):
                n = c.last - c.first
                doc, h, times = shingle_sets(c, k)
                weight = times.astype(float) if counts else np.ones(len(h))
                keys = band_keys(dart_signatures(doc, h, weight, n, bands * rows), bands, rows)
                size = np.bincount(doc, minlength=n)
                salt = times.astype(U64) * U64(0x9E3779B97F4A7C15) if counts else U64(0)
                sums = []
                for seed in (0x94D049BB133111EB, 0xBF58476D1CE4E5B9):
                    total = np.append(U64(0), np.cumsum(_scan.mix((h ^ U64(seed)) + salt), dtype=U64))
                    ends = np.append(0, np.cumsum(size))
                    sums.append(pa.array(_scan.signed(total[ends[1:]] - total[ends[:-1]])))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * bands + 1, bands), pa.int32()), pa.array(keys.ravel()))
                row = [batch.column(i)[c.first : c.last] for i in (0, 2, 3)]
                yield pa.RecordBatch.from_arrays([*row, pa.array(size, pa.int64()), *sums, lists], names=["id", "t1", "t2", "n_shingles", "d1", "d2", "bands"])

    return run


def _sets(k: int, counts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _scan.chunks(batch.column(1)):
                doc, h, times = shingle_sets(c, k)
                if counts:  # a shingle that occurs n times becomes n elements
                    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    doc, h = np.repeat(doc, times), _scan.mix(np.repeat(h, times) + nth.astype(U64))
                ends = np.searchsorted(doc, np.arange(c.last - c.first + 1)).tolist()
                blobs = [h[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                own = slice(c.first, c.last)
                yield pa.RecordBatch.from_arrays([batch.column(0)[own], pa.array(blobs, pa.binary()), batch.column(2)[own], batch.column(3)[own]], names=["id", "shingles", "family", "blocks"])

    return run


def linked(left: list[np.ndarray], right: list[np.ndarray], least: float, slab: int = 1024) -> np.ndarray:
    """Which pairs of the two lists of sets have a Jaccard similarity of ``least`` or more."""
    sets = left + right
    size = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), size)
    _, col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    again = times > 1
    at = (np.cumsum(again) - 1)[col]
    ok = again[col]
    row, at = row[ok], at[ok]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(again.sum()), slab):
        s = slice(*np.searchsorted(at, [low, low + slab]))
        m = np.zeros((len(sets), slab), np.float32)
        m[row[s], at[s] - low] = 1
        both += m[: len(left)] @ m[len(left) :].T
    return both / (size[: len(left), None] + size[None, len(left) :] - both.astype(np.float64)) >= least


def stars(ids: np.ndarray, adjacent: np.ndarray) -> list[tuple[int, int]]:
    """(smallest id, id) for each other member of each component."""
    out, open_ = [], np.ones(len(ids), bool)
    for i in np.argsort(ids).tolist():
        if open_[i]:
            front = np.array([i])
            open_[i] = False
            while len(front):
                front = np.flatnonzero(adjacent[front].any(0) & open_)
                open_[front] = False
                out += [(int(ids[i]), int(ids[j])) for j in front]
    return out


def _family(least: float):
    def run(table: pa.Table) -> pa.Table:
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        ids, block = np.asarray(table["id"]), np.asarray(table["block"])
        sets = [np.frombuffer(x, U64) for x in table["shingles"].to_pylist()]
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        hit = linked([sets[x] for x in a], [sets[x] for x in b], least) if len(a) and len(b) else np.zeros((len(a), len(b)), bool)
        adjacent = np.zeros((len(ids), len(ids)), bool)
        adjacent[np.ix_(a, b)] = hit
        adjacent |= adjacent.T
        found = stars(ids, adjacent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, counts: bool = False,
) -> DataFrame:
    """(id, class_id, component_id, kept, n_shingles): one row per input row.

    Two texts are linked if the Jaccard similarity of their sets of ``shingle``
    consecutive words (split at ASCII white space, otherwise unchanged) is
    ``least`` or more; ``counts`` weights shingles by how often they occur.
    ``class_id`` is the smallest id with the same shingles, ``component_id``
    the smallest one reachable by links, and the row with that id stays. Null
    and empty texts have no shingles, link with nothing and stay. A text shorter
    than a shingle is one shingle. Rows with a null id stay, and link nothing.
    Rows that repeat an id are marked each by its own text, so an id may stay with one
    of them and go with another; equal rows, and those whose texts have the same shingles, are marked alike. An empty table gives an empty
    result; further columns are ignored.
    """
    return _marked(docs, id_col, text_col, shingle, least, bands, rows, counts).drop("t1", "t2")


def _identity(id_col: str, text_col: str) -> list[Column]:
    """(id, t1, t2): a row's id and two hashes of its text, which together are what a decision is about."""
    return [F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("t1"), F.xxhash64(F.lit(29), text_col).alias("t2")]


def _marked(docs: DataFrame, id_col: str, text_col: str, shingle: int, least: float, bands: int, rows: int, counts: bool) -> DataFrame:
    """``near_duplicates`` with the hashes of each row's text."""
    own = ["id", "t1", "t2"]
    narrow = docs.select(*_identity(id_col, text_col), F.col(text_col).alias("text")).select("id", "text", "t1", "t2")
    sketch = cut(narrow.mapInArrow(_sketch(shingle, bands, rows, counts), "id long, t1 long, t2 long, n_shingles long, d1 long, d2 long, bands array<long>"), narrow=True)
    # rows meet their class by way of runs, so that a class of a third of all rows is one row per run
    equal = ["n_shingles", "d1", "d2"]
    dealt = sketch.select(*own, *equal, F.pmod(F.xxhash64(*own, F.lit(13)), F.lit(RUNS)).cast("int").alias("run"))
    # a class is headed by one of its rows with the smallest id, and goes by a key of its own, as an id may head several
    firsts = dealt.where("n_shingles > 0").groupBy("run", *equal).agg(F.min(F.when(F.col("id").isNotNull(), F.struct(*own))).alias("head"))
    classes = cut(firsts.groupBy(*equal).agg(F.min("head").alias("head")).select(*equal, F.col("head.id").alias("class_id"), "head.t1", "head.t2").withColumn("key", F.monotonically_increasing_id()))
    of_run = firsts.select("run", *equal).join(classes.select(*equal, "class_id", "key"), equal)
    member = dealt.where("n_shingles > 0").join(of_run, ["run", *equal]).select(*own, *equal, "class_id", "key")
    heads = sketch.join(classes.where("class_id is not null").select(F.col("class_id").alias("id"), "t1", "t2", *equal, "key"), [*own, *equal])
    entries = heads.select("key", F.posexplode("bands").alias("band", "value"))
    # the member with the smallest key leads its bucket
    leaders = entries.groupBy("band", "value").agg(F.min("key").alias("a"), F.max("key").alias("z")).where("a <> z").select("band", "value", "a")
    candidates = entries.join(leaders, ["band", "value"]).where("key <> a").select("a", F.col("key").alias("b"))
    family = components(candidates).select(F.col("node").alias("key"), F.col("component").alias("family"))
    size = classes.select("key", "n_shingles", F.col("class_id").alias("id"), "t1", "t2").join(family, "key")
    blocks = size.groupBy("family").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    wanted = size.join(blocks, "family").select(*own, "key", "family", "blocks")
    sets = narrow.join(wanted, own).select(F.col("key").alias("id"), "text", "family", "blocks").mapInArrow(_sets(shingle, counts), "id long, shingles binary, family long, blocks int")
    sets = sets.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    meet = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meet = meet.select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "block", "shingles")
    links = meet.groupBy("family", "i", "j").applyInArrow(_family(least), "a long, b long")
    linked_keys = components(links).withColumnRenamed("node", "key").join(classes.select("key", "class_id"), "key").withColumn("salt", F.pmod("key", F.lit(RUNS)).cast("int"))
    least_ids = linked_keys.groupBy("component", "salt").agg(F.min("class_id").alias("some")).groupBy("component").agg(F.min("some").alias("component_id"), F.collect_set("salt").alias("salts"))
    of = linked_keys.join(least_ids.select("component", "component_id", F.explode("salts").alias("salt")), ["component", "salt"]).select("key", "component_id")
    done = member.join(of, "key", "left").select(*own, "class_id", "component_id", "n_shingles")
    bare = dealt.where("n_shingles = 0").select(*own, F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("long").alias("component_id"), "n_shingles")  # they meet none
    component = F.coalesce("component_id", "class_id", "id")
    return done.union(bare).select(*own, F.coalesce("class_id", "id").alias("class_id"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"), "n_shingles")


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, counts: bool = False,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one text of each component, each row judged by its own text."""
    stays = _marked(docs, id_col, text_col, shingle, least, bands, rows, counts).where("kept").select("id", "t1", "t2").distinct()
    same = [a.eqNullSafe(F.col(f"__{n}")) for a, n in zip((F.col(id_col).cast("long"), F.xxhash64(text_col), F.xxhash64(F.lit(29), text_col)), stays.columns, strict=True)]
    return docs.join(stays.toDF(*[f"__{n}" for n in stays.columns]), same, "left_semi")
