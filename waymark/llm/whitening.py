"""Embedding whitening from upper-triangle column aggregates (operator 12).

Entries become integers, so that every sum is exact and does not depend on how
rows are dealt out. Spark SQL expressions, generated for the number of
dimensions, add up the centred products of all pairs of dimensions in one
aggregation; the covariance is put together from them on the driver (dims x dims
numbers) and decomposed by LAPACK.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scan import list_matrix
from ._spark import cut, ship

#: An entry c counts as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Components to which a vector is projected.
COMPONENTS = 8
#: An eigenvalue below this share of the largest one is rounding, not variance.
LEAST_SHARE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """``n`` fitted vectors; ``sums`` per dimension (exact); ``axes``: a unit eigenvector a row, by falling eigenvalue ``values``; ``trace`` of the covariance."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def dims(self) -> int:
        return len(self.sums)


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x array<long>) of the vectors that are neither null nor hold a null or non-finite entry."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    x = F.transform("v", lambda c: F.floor(F.lit(SCALE) * c).cast("long") + SHIFT)
    return vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(whole).select("id", x.alias("x"))


def pair_sums(dims: int, shift: list[int], kind: str = "bigint") -> Callable[[DataFrame], DataFrame]:
    """The sums of centred products of every pair of dimensions, as one aggregation of generated expressions.

    Row g of the upper triangle has dims - g pairs and row dims - 1 - g has g + 1,
    so two rows folded together have dims + 1, whatever g: that many
    expressions over dims / 2 groups are the whole triangle, few enough for the
    compiler to keep in one fast method.
    """
    half = -(-dims // 2)
    # position k of fold g is the pair (g, g + k), or (dims - 1 - g, k - 1) beyond row g's end; the middle row of an odd triangle folds onto nothing
    expressions = [f"sum(cast(y[if({k} < {dims} - g, g, {dims - 1} - g)] as {kind}) * y[if({k} < {dims} - g, g + {k}, {max(k - 1, 0)})]) AS p{k}" for k in range(dims + 1)]
    centre = F.array(*[F.lit(s).cast("long") for s in shift])

    def run(rows: DataFrame) -> DataFrame:
        centred = rows.select(F.zip_with("x", centre, lambda a, b: a - b).alias("y"))
        return centred.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(half - 1)))).groupBy("g").agg(*[F.expr(e) for e in expressions])

    return run


def covariance(dims: int, n: int, sums: list[int], shift: list[int], folds: list) -> np.ndarray:
    """The covariance matrix, divisor n: each entry is an exact quotient of integers, rounded once.

    Products are centred by whole numbers at most 1 from the mean; what is left of the means is taken off exactly.
    """
    left = [s - n * m for s, m in zip(sums, shift, strict=True)]
    out = np.zeros((dims, dims))
    for fold in folds:
        g = fold["g"]
        rows = [(g, j, j - g) for j in range(g, dims)]
        if (other := dims - 1 - g) != g:
            rows += [(other, j, j + 1) for j in range(other, dims)]
        for i, j, k in rows:
            out[i, j] = out[j, i] = (int(fold[f"p{k}"]) * n - left[i] * left[j]) / (n * n)
    return out


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Principal axes of all vectors; None where there is none.

    Vectors that are null, empty, or hold a null or non-finite entry don't count, nor do those of
    another length than most have (of equally many, the longest). Further columns are ignored; repeated
    rows and ids count as often as they occur. At most ``components`` axes are
    kept, fewer where the vectors have fewer dimensions or no variance in more.
    """
    rows = integers(vectors, id_col, vector_col)
    most = rows.groupBy(F.size("x").alias("dims")).count().where("dims > 0").orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not most:
        return None
    dims, n = most[0]["dims"], most[0]["count"]
    rows = rows.where(F.size("x") == dims)
    one = rows.agg(F.max(F.array_max("x")).alias("high"), F.min(F.array_min("x")).alias("low"), *[F.try_sum(F.col("x")[i]).alias(f"s{i}") for i in range(dims)]).first()
    sums = [one[f"s{i}"] for i in range(dims)]
    if None in sums:  # beyond a long
        one_wide = rows.agg(*[F.sum(F.col("x")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]).first()
        sums = [int(v) for v in one_wide]
    shift = [s // n for s in sums]
    spread = one["high"] - one["low"] + 1
    kind = "bigint" if n * spread * spread < 1 << 63 else "decimal(38,0)"  # the sums fit, or are kept wider
    v = covariance(dims, n, sums, shift, pair_sums(dims, shift, kind)(rows).collect())  # dims / 2 rows
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")
    values, axes = values[order], axes.T[order]
    keep = int(np.sum(values > max(values[0], 0) * LEAST_SHARE)) if values[0] > 0 else 0
    keep = min(keep, components)
    return Whitening(n, tuple(sums), axes[:keep], values[:keep], float(np.trace(v)))


def _project(model: Whitening) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, x) -> (id, squares, cross, w): with d the distances to the whole-number centre, sum d^2 and sum d * (what is left of the sums), and the whitened values."""
    shift = [s // model.n for s in model.sums]
    left = np.array([s - model.n * m for s, m in zip(model.sums, shift, strict=True)], dtype=object)
    fraction = np.array([float(r) / model.n for r in left])
    turn = (model.axes / np.sqrt(model.values)[:, None]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = list_matrix(b.column(1), model.dims)
            d = x - np.array(shift, np.int64)
            far = max(int(np.abs(d).max(initial=0)), 1)
            wide = d.astype(object) if far * far * model.dims >= 1 << 62 or far * model.n * model.dims >= 1 << 62 else d
            squares, cross = (wide * wide).sum(axis=1), (wide * (left if wide is not d else left.astype(np.int64))).sum(axis=1)
            tail = sum(int(r) ** 2 for r in left)
            exact = [model.n * model.n * int(a) - 2 * model.n * int(c) + tail for a, c in zip(squares, cross, strict=True)]
            w = (d - fraction) @ turn
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([e if e < 1 << 63 else None for e in exact], pa.int64()), pa.array([str(e) for e in exact], pa.string()), pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))],
                names=["id", "deviation", "deviation_exact", "w"],
            )

    return run


def whiten(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, deviation_exact, whitened, explained, identity_error): a row per vector and component.

    ``component`` counts from 1 by falling variance; ``deviation``: the sum over dimensions of (n x - S)^2, exact, null where
    it is beyond a long (``deviation_exact`` has its digits as text); ``whitened``: the vector's distance from the mean along the
    component over its standard deviation; ``explained``: the component's share of the variance; ``identity_error``: the
    largest entry of the covariance of all whitened vectors, computed from them, less the identity's.

    A vector that is null, empty, holds a null or non-finite entry or has another length than the model's has no
    row; repeated ids and rows each have their own, and a null id stays null. A component without variance has no
    row, so vectors that are all equal give none, as an empty table does.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema[id_col].dataType.simpleString()
    if model is None or not len(model.values):
        return spark.createDataFrame([], f"id {kind}, component int, n long, deviation long, deviation_exact string, whitened double, explained double, identity_error double")
    rows = integers(vectors, id_col, vector_col).where(F.size("x") == model.dims)
    done = cut(rows.mapInArrow(_project(model), f"id {kind}, deviation long, deviation_exact string, w array<double>"))
    k = len(model.values)
    mean = done.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(k)]).first()
    off = lambda i: F.col("w")[i] - F.lit(mean[f"m{i}"])
    one = done.agg(*[F.avg(off(i) * off(j)).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    error = max((abs(one[f"c{i}_{j}"] - (i == j)) for i in range(k) for j in range(i, k) if one[f"c{i}_{j}"] is not None), default=0.0)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    out = done.select("id", "deviation", "deviation_exact", F.posexplode("w").alias("c", "whitened"))
    return out.select(
        "id", (F.col("c") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "deviation_exact", "whitened",
        F.get(explained, F.col("c")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
