"""Ball k-means and whitening against plain arithmetic, on vectors with ties, gaps and clashing columns."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from compare import duck_rows, spark_rows

from waymark.llm import ball_kmeans, whitening
from waymark.llm._spark import ship
from waymark.llm.oracles import ORACLES
from waymark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x string, cluster int, g int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, "a", "b", 1, 2) for i, v in rows], SCHEMA)


def literal(rows, dims, clusters, rounds):
    kept = [(i, [int(np.floor(1024 * float(np.float32(c)))) for c in v]) for i, v in rows if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in order[:clusters]]
    for r in range(rounds + 1):
        where = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            where.append((min(d), d.index(min(d))))
        if r < rounds:
            for j in range(len(centres)):
                mine = [v for (_, v), (_, k) in zip(kept, where) if k == j]
                if mine:
                    centres[j] = [sum(c) // len(mine) for c in zip(*mine)]
    per = [sum(d for d, k in where if k == j) for j in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, k, d, per[k], sum(per), sha[k]) for (i, _), (d, k) in zip(kept, where)), key=str)


ODD = [(None, [1.0, 2.0, 3.0]), (900, None), (901, [1.0, None, 0.0]), (902, [float("nan"), 0.0, 0.0]), (903, [float("inf"), 0.0, 0.0]), (904, [1.0]), (905, []), (7, [0.5, 0.5, 0.5])]


@pytest.mark.parametrize("kind", ["blobs", "grid", "equal", "few"])
def test_ball_kmeans_is_plain_kmeans(spark, kind):
    rng = np.random.default_rng(5)
    if kind == "blobs":
        rows = [(i, [float(c) for c in rng.normal(i % 6, 0.3, 3)]) for i in range(400)] + ODD
    elif kind == "grid":  # many ties
        rows = [(i, [float(c) for c in rng.integers(-2, 3, 3)]) for i in range(300)] + ODD
    elif kind == "equal":
        rows = [(i, [0.25, -0.25, 0.0]) for i in range(30)]
    else:
        rows = [(1, [0.0, 0.0, 1.0]), (1, [0.0, 0.0, 1.0]), (1, [0.0, 1.0, 1.0])]
    got = sorted((tuple(r) for r in ball_kmeans.cluster(table(spark, rows), clusters=5, rounds=4, dims=3).collect()), key=str)
    assert got == literal(rows, 3, 5, 4)


def test_ball_kmeans_of_nothing(spark):
    assert ball_kmeans.cluster(table(spark, [])).count() == 0
    assert ball_kmeans.cluster(table(spark, [(1, [1.0, 2.0])])).count() == 0


def test_rings_meet_relevant_neighbours_only():
    """A member meets as many neighbours as its ring has, and the result is that of all comparisons."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (12, 4))
    x = rng.integers(-3500, 3500, (5000, 4))
    before, far = ball_kmeans.nearest(x, centres)
    moved = centres + rng.integers(-40, 40, centres.shape)
    own = ((x - moved[before]) ** 2).sum(axis=1)
    radius = [int(np.sqrt(own[before == j].max(initial=0))) + 1 for j in range(12)]
    near = ball_kmeans.neighbours(moved, radius)
    label, d = ball_kmeans.reassign(x, before, moved, near)
    every, best = ball_kmeans.nearest(x, moved)
    assert (label == every).all() and (d == best).all()
    core = [(4 * own[i] < near[before[i]][0][0]) if near[before[i]] else True for i in range(len(x))]
    assert all(label[i] == before[i] for i in np.flatnonzero(core)) and 0 < sum(core) < len(x)


def test_rounds_move_labels_only(spark, tmp_path):
    """The blocks lie in buckets, so only the labels are exchanged to meet them."""
    ship(spark)
    blocks = spark.range(64).selectExpr("id AS block", "cast('m' AS binary) AS matrix")
    blocks.repartition(4, "block").write.bucketBy(4, "block").option("path", str(tmp_path / "b")).saveAsTable("blocks_of_a_test")
    try:
        labels = spark.range(64).selectExpr("id AS block", "cast('l' AS binary) AS labels")
        plan = spark.table("blocks_of_a_test").join(labels.hint("shuffle_hash"), "block")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Sort" not in plan and "ShuffledHashJoin" in plan
    finally:
        spark.sql("DROP TABLE blocks_of_a_test")


def test_ball_kmeans_same_as_sql(spark, sf_dir):
    assert spark_rows(QUERIES["op11_ball_kmeans"](spark, sf_dir)) == duck_rows(ORACLES["op11_ball_kmeans"], sf_dir)


# --- whitening ---------------------------------------------------------------------


def check_whitened(out, x, dims):
    """Rows of whitened vectors against numpy's covariance of the same integers."""
    n = len(x)
    cov = np.cov(x.T.astype(float), bias=True).reshape(dims, dims)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    by = {}
    for r in out:
        by.setdefault(r.id, {})[r.component] = r
    s = [int(v) for v in x.sum(axis=0)]
    k = min(8, dims)
    w = np.array([[by[i][c + 1].whitened for c in range(k)] for i in range(n)])
    expect = (x - x.mean(axis=0)) @ axes[:, :k] / np.sqrt(values[:k])
    sign = np.sign((w * expect).sum(axis=0))
    assert np.abs(w - sign * expect).max() < 1e-6
    assert np.abs(np.cov(w.T, bias=True).reshape(k, k) - np.eye(k)).max() < 1e-9
    for i in range(n):
        exact = sum((n * int(a) - b) ** 2 for a, b in zip(x[i], s))
        for c in range(k):
            r = by[i][c + 1]
            assert (r.n, r.deviation, r.deviation_exact) == (n, exact, str(exact))
            assert abs(r.explained - values[c] / np.trace(cov)) < 1e-9 and r.identity_error < 1e-9


@pytest.mark.parametrize("dims", [1, 2, 5, 12])
def test_whitening_against_numpy(spark, dims):
    rng = np.random.default_rng(dims)
    v = rng.normal(0, 1, (60, dims)) @ rng.normal(0, 1, (dims, dims)) + rng.normal(0, 5, dims)
    rows = [(i, [float(c) for c in v[i]]) for i in range(60)] + [(900, None), (901, [None] * dims), (902, [float("nan")] * dims), (904, [1.0] * (dims + 1)), (905, [])]
    t = table(spark, rows)
    x = np.floor(1024 * v.astype(np.float32).astype(float)).astype(np.int64) + 100_000
    out = whitening.whiten(t, whitening.fit(t)).collect()
    assert len(out) == 60 * min(8, dims)
    check_whitened(out, x, dims)


def test_whitening_without_variance_and_of_nothing(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        t = table(spark, rows)
        assert whitening.whiten(t, whitening.fit(t)).count() == 0
    t = table(spark, [(i, [float(i), 2.0 * i, 3.0]) for i in range(9)] + [(3, [3.0, 6.0, 3.0]), (None, [4.0, 8.0, 3.0])])  # one direction only, a repeated row, a null id
    out = whitening.whiten(t, whitening.fit(t)).collect()
    assert len(out) == 11 and {r.component for r in out} == {1} and out[0].explained == pytest.approx(1.0) and sum(r.id is None for r in out) == 1


def test_wide_entries_are_exact(spark):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate([[4e9, 1.0], [-4e9, 2.0], [3e9, -5.0], [1.0, 1e9]])]
    t = table(spark, rows)
    m = whitening.fit(t)
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in rows]
    assert list(m.sums) == [sum(c) for c in zip(*x)]
    for r in whitening.whiten(t, m).collect():
        exact = sum((4 * a - s) ** 2 for a, s in zip(x[r.id], m.sums))
        assert r.deviation_exact == str(exact) and r.deviation == (exact if exact < 1 << 63 else None)


def test_pair_sums_cover_the_triangle(spark):
    for dims in (1, 2, 3, 6, 7):
        x = np.random.default_rng(dims).integers(-50, 50, (20, dims))
        rows = spark.createDataFrame([([int(c) for c in v],) for v in x], "x array<long>")
        folds = whitening.pair_sums(dims, [0] * dims)(rows).collect()
        sums = [int(s) for s in x.sum(axis=0)]
        assert np.allclose(whitening.covariance(dims, 20, sums, [0] * dims, folds), np.cov(x.T.astype(float), bias=True).reshape(dims, dims))


def test_whitening_query(spark, sf_dir):
    out = [r.asDict() for r in QUERIES["op12_whitening"](spark, sf_dir).collect()]
    v = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    ids = sorted(v)
    x = np.floor(1024 * np.array([v[i] for i in ids], np.float32).astype(float)).astype(np.int64) + 100_000
    from types import SimpleNamespace

    place = {i: n for n, i in enumerate(ids)}
    check_whitened([SimpleNamespace(**{**r, "id": place[r["vec_id"]]}) for r in out], x, 64)
