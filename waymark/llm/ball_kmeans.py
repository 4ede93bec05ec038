"""Centroid clustering by ball k-means (operator 11).

A cluster is a ball: its centroid and the largest distance of its members. Only
centroids within twice that radius can take a member away, so those are its
neighbours. The half distances to them cut the ball into a stable core, whose
members are compared with no other centroid, and rings, whose members are
compared with the neighbours up to the ring's own and no others. All of it is
whole-number arithmetic, so the clusters are exactly those of plain Lloyd rounds.

Vectors lie as blocks (matrices of some thousand rows) in a table bucketed by
block, written once. What a round keeps is a byte or so a vector, the labels of a block, and
it goes to the blocks by a join for which only the labels move. A round reads
the vectors once: the task that assigns a block also gives its sums.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scan import list_matrix
from ._spark import cut, partitions, removed, shared_folder, ship

DIMS, CLUSTERS, ROUNDS, SCALE, SALT = 64, 8, 10, 1024, "3:"
#: Vectors of a block: a matrix of at most 1 MB at 64 components.
BLOCK_BYTES = 1 << 20
#: Bytes of vectors in a bucket, about.
BUCKET_BYTES = 128 << 20
#: Components beyond this can't be compared in whole numbers of 64 bits at any usual length.
LARGEST = 1 << 27


def whole(vectors: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, x array<int>) of the vectors with exactly ``dims`` components, none null or non-finite."""
    v = F.col(vector_col).cast("array<double>")
    fine = (F.size("v") == dims) & F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    far = F.exists("v", lambda c: F.abs(c) >= LARGEST / SCALE)
    told = F.when(far, F.raise_error(F.lit(f"a component lies beyond {LARGEST // SCALE}"))).otherwise(F.col("v"))
    return vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.coalesce(fine, F.lit(False))).select("id", F.transform(told, lambda c: F.floor(F.lit(SCALE) * c).cast("int")).alias("x"))


def seeds(rows: DataFrame, clusters: int, salt: str) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, a row each; equal ids go by their vectors, a null id counts as empty text."""
    text = F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = rows.select(F.sha2(text, 256).alias("h"), "x").orderBy("h", "x").limit(clusters).collect()  # that many rows
    return np.array([r["x"] for r in first], np.int64)


def _blocks(dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, x) -> (block, ids, matrix): a block's number is that of its task and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, most, i = TaskContext.get().partitionId(), max(1, BLOCK_BYTES // (4 * dims)), 0
        for b in batches:
            for at in range(0, b.num_rows, most):
                some = b.slice(at, most)
                x = list_matrix(some.column(1), dims).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some.column(0))
                yield pa.RecordBatch.from_arrays([pa.array([(task << 32) | i], pa.int64()), ids, pa.array([x.tobytes()], pa.binary())], names=["block", "ids", "matrix"])
                i += 1

    return run


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x to one centroid, exact."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(label, squared distance) of the nearest centroid of each row, the smaller number of ties: the first round, which knows no balls yet."""
    label, best = np.zeros(len(x), np.int64), distances(x, centres[0])
    for j in range(1, len(centres)):
        d = distances(x, centres[j])
        closer = d < best
        label[closer], best[closer] = j, d[closer]
    return label, best


def neighbours(centres: np.ndarray, radius: list[int]) -> list[list[tuple[int, int]]]:
    """Per ball its neighbours by rising distance, as (squared distance, number): those whose centroid lies within twice its radius."""
    out = []
    for i, r in enumerate(radius):
        apart = [(int(d), j) for j, d in enumerate(distances(centres, centres[i])) if j != i]
        out.append(sorted((d, j) for d, j in apart if d <= 4 * r * r))
    return out


def reassign(x: np.ndarray, label: np.ndarray, centres: np.ndarray, near: list[list[tuple[int, int]]]) -> tuple[np.ndarray, np.ndarray]:
    """(label, squared distance) of the nearest centroid, given each row's ball before.

    With D the distance of two centroids, one is no nearer than a member's own at
    distance d where D > 2 d, or 4 d^2 < D^2 in whole numbers. Members nearer than half
    the way to the first neighbour are the stable core; a member in the ring between the
    halves of neighbour k and k + 1 meets the first k. At equality a tie is possible, so it counts to the outer ring.
    """
    out, best = label.copy(), np.zeros(len(x), np.int64)
    for i in np.unique(label):
        members = np.flatnonzero(label == i)
        own = distances(x[members], centres[i])
        best[members] = own
        for apart, j in near[i]:  # ring after ring, from the inside: who is left lies beyond all rings before
            beyond = 4 * own >= apart
            members, own = members[beyond], own[beyond]
            if not len(members):
                break
            d = distances(x[members], centres[j])
            closer = (d < best[members]) | ((d == best[members]) & (j < out[members]))
            out[members[closer]], best[members[closer]] = j, d[closer]
    return out, best


def _round(centres: np.ndarray, near: list[list[tuple[int, int]]] | None, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One round over blocks (block, ids, matrix, labels): their labels, and per block and cluster the facts: farthest squared distance, members, inertia, and the sum of each component.

    A row of labels has no ``cluster``; a row of sums has no ``block``. In the last round labels come with ids and distances, opened up.
    """
    dims = centres.shape[1]
    small = np.uint8 if len(centres) <= 1 << 8 else np.int32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                x = np.frombuffer(b.column(2)[row].as_buffer(), np.int32).reshape(-1, dims).astype(np.int64)
                label, d = nearest(x, centres) if near is None else reassign(x, np.frombuffer(b.column(3)[row].as_buffer(), small).astype(np.int64), centres, near)
                some = np.unique(label)
                n, void = 1 + len(some), [None] * len(some)
                facts = []
                for j in some:
                    mine = label == j
                    facts.append([int(d[mine].max()), int(mine.sum()), int(d[mine].sum()), *x[mine].sum(axis=0).tolist()])
                cols = [
                    pa.array([b.column(0)[row].as_py(), *void], pa.int64()), pa.array([label.astype(small).tobytes(), *void], pa.binary()),
                    pa.array([None, *some], pa.int32()), pa.array([None, *facts], pa.list_(pa.int64())),
                ]
                names = ["block", "labels", "cluster", "facts"]
                if last:
                    ids = b.column(1).slice(row, 1)
                    empty = pa.array([[]] * (n - 1), ids.type)
                    cols += [pa.concat_arrays([ids, empty])] + [pa.array([v, *[np.zeros(0, np.int64)] * (n - 1)], pa.list_(pa.int64())) for v in (label, d)]
                    names += ["ids", "clusters", "distances"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _summed(done: DataFrame) -> dict[int, tuple[int, int, int, list[int]]]:
    """Per cluster (members, farthest squared distance, inertia, sums) of a round: a row per cluster and number."""
    each = done.where("cluster is not null").select("cluster", F.posexplode("facts").alias("i", "v"))
    per: dict[int, dict[int, int]] = {}
    for r in each.groupBy("cluster", "i").agg(F.when(F.col("i") == 0, F.max("v")).otherwise(F.sum(F.when(F.col("i") > 0, F.col("v")))).alias("v")).collect():
        per.setdefault(r["cluster"], {})[r["i"]] = r["v"]
    return {j: (f[1], f[0], f[2], [f[i] for i in range(3, len(f))]) for j, f in per.items()}


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, salt: str = SALT, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256): a row per vector with exactly ``dims`` finite components.

    Components count as floor(1024 * c). Centroids start as the vectors whose ids have the smallest hash; each of
    ``rounds`` rounds assigns all vectors to their nearest (ties: the smaller number) and moves every centroid that has members to the floor of
    their mean; then vectors are assigned once more. Where there are fewer vectors than
    ``clusters`` each starts a centroid. Other vectors (null, of another length, with null or
    non-finite components) have no row; an empty table gives none. Repeated rows and ids count as often as they
    occur, a null id stays null, further columns are ignored. A component beyond 131,072 is an error.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = whole(vectors, dims, id_col, vector_col)
    centres = seeds(rows, clusters, salt)
    if not len(centres):
        return spark.createDataFrame([], f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    name, folder = f"waymark_blocks_{uuid.uuid4().hex}", f"{shared_folder(spark)}/waymark-blocks-{uuid.uuid4().hex}"
    made = cut(rows.mapInArrow(_blocks(dims), f"block long, ids array<{kind}>, matrix binary"))  # numbers stay as they are if a task is repeated
    count = made.count()
    buckets = min(max(partitions(spark), -(-count * BLOCK_BYTES // BUCKET_BYTES)), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    made.repartition(buckets, "block").write.bucketBy(buckets, "block").option("path", folder).saveAsTable(name)
    del made
    try:
        labels, near = None, None
        for i in range(rounds + 1):
            last = i == rounds
            blocks = spark.table(name)
            met = blocks.withColumn("labels", F.lit(None).cast("binary")) if labels is None else blocks.join(labels.hint("shuffle_hash"), "block")
            out = "block long, labels binary, cluster int, facts array<long>" + (f", ids array<{kind}>, clusters array<long>, distances array<long>" if last else "")
            done = cut(met.select("block", "ids", "matrix", "labels").mapInArrow(_round(centres, near, last), out))
            per = _summed(done)
            labels = done.where("block is not null").select("block", "labels")
            if last:
                break
            moved, radius = centres.copy(), [0] * len(centres)
            for j, (n, far, _, s) in per.items():
                moved[j] = [v // n for v in s]
                shift = sum((int(a) - int(b)) ** 2 for a, b in zip(moved[j], centres[j], strict=True))
                radius[j] = isqrt(far) + isqrt(shift) + 2  # around the moved centroid, rounded up
            centres, near = moved, neighbours(moved, radius)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        removed(spark, folder)
    summary = [(j, inertia, ",".join(str(v) for v in centres[j])) for j, (_, _, inertia, _) in per.items()]
    facts = spark.createDataFrame(summary, "cluster int, cluster_inertia long, c string").withColumn("centroid_sha256", F.sha2("c", 256)).drop("c")
    total = F.lit(sum(inertia for _, inertia, _ in summary)).cast("long")
    each = done.where("block is not null").select(F.explode(F.arrays_zip("ids", "clusters", "distances")).alias("v"))
    each = each.select(F.col("v.ids").alias("id"), F.col("v.clusters").cast("int").alias("cluster"), F.col("v.distances").alias("distance"))
    return each.join(F.broadcast(facts), "cluster").select("id", "cluster", "distance", "cluster_inertia", total.alias("inertia"), "centroid_sha256")  # a row per cluster
