"""Exact, substring, near and embedding dedup against brute force on small fixtures."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymark.llm import _scan, exact_dedup, minhash_dedup, pq_dedup, substring_dedup
from waymark.llm._spark import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, id string, kept string, run int, spans string"


def docs(spark, rows):
    """Documents with further columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, None, "x", "y", 1, "z") for i, t in rows], DOCS)


def join_components(ids, links):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


# --- exact ---------------------------------------------------------------------

EXACT = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "A"), (6, "a "), (7, "b"), (-8, "a"), (9, "é"), (10, "é")]


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(spark, keep):
    got = {r.id: r for r in exact_dedup.exact_groups(docs(spark, EXACT), keep=keep).collect()}
    best = max if keep == "largest" else min
    for i, t in EXACT:
        same = [j for j, u in EXACT if (u or "") == (t or "")]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (best(same), len(same), i == best(same))
        assert got[i].text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_exact_rounds_move_records_by_run_alone(spark):
    rows = exact_dedup.digests(docs(spark, EXACT), runs=64).withColumnRenamed("id", "keep_id").withColumn("n", F.lit(1))
    plan = exact_dedup._exchanged(rows, 0, 8, F.max)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange" in x]
    assert len(exchanges) == 1 and re.search(r"hashpartitioning\(run#\d+, ", exchanges[0]) and len(re.findall(r"\bSort \[", plan)) == 1 and "SortAggregate" in plan


def test_exact_dedup_keeps_rows_whole(spark):
    out = exact_dedup.exact_dedup(docs(spark, EXACT))
    assert out.columns == [c.split()[0] for c in DOCS.split(", ")] and sorted(r.doc_id for r in out.collect()) == [2, 4, 5, 6, 7, 10]


def test_exact_empty_repeated_and_null_ids(spark):
    assert exact_dedup.exact_groups(docs(spark, [])).count() == 0
    assert [(r.group_size, r.kept) for r in exact_dedup.exact_groups(docs(spark, [(1, "a"), (1, "a")])).collect()] == [(2, True)] * 2
    got = {r.id: r.kept for r in exact_dedup.exact_groups(docs(spark, [(None, "a"), (1, "a"), (None, "b")])).where("text_sha256 <> ''").collect() if r.id}
    assert got == {1: True} and exact_dedup.exact_dedup(docs(spark, [(None, "b"), (2, "c")])).count() == 2


def test_exact_long_text(spark):
    long = "x" * 2_000_000
    assert exact_dedup.exact_dedup(docs(spark, [(1, long), (2, long), (3, long + "y")])).count() == 2


# --- substring ----------------------------------------------------------------------


def brute_removed(rows, k):
    seen, gone = set(), {}
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in sorted(texts):
        hit = set()
        for s in range(len(w) - k + 1):
            g = tuple(w[s : s + k])
            if g in seen:
                hit |= set(range(s, s + k))
            seen.add(g)
        gone[i] = (len(w), len(hit), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in hit).encode()).hexdigest())
    return gone


def passages(seed, n=60, words=40, vocabulary=12):
    """Texts of few words with shared passages, copies and repeats within a text."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghijklmnop"[:vocabulary]) * r.randint(1, 3)
    shared = [[word() for _ in range(r.randint(10, 60))] for _ in range(4)]
    out = []
    for i in range(n):
        w = [word() for _ in range(r.randint(0, words))]
        for _ in range(r.randint(0, 2)):
            p = r.choice(shared)
            a = r.randint(0, len(p) - 1)
            at = r.randint(0, len(w))
            w[at:at] = p[a : a + r.randint(1, 60)]
        if r.random() < 0.1 and out:
            out.append((i * 7 % 61, out[-1][1]))
        else:
            out.append((i * 7 % 61, r.choice(["", " "]) + r.choice([" ", "\n", "\t "]).join(w)))
    return out


@pytest.mark.parametrize(("seed", "k"), [(1, 20), (2, 6), (3, 3)])
def test_substring_against_brute_force(spark, monkeypatch, seed, k):
    rows = [*passages(seed), (100, None), (101, ""), (102, "a b"), (103, "q " * 50), (104, " x y"), (105, "é " * 30 + "\x0b" + "é " * 5)]
    got = {r.id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.removed_words(docs(spark, rows).repartition(3), k=k).collect()}
    assert got == brute_removed(rows, k)


def test_groups_within_a_task_agree_with_one_group():
    rows = passages(5, 80)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], names=["id", "text"])

    def paths(size):
        old, substring_dedup.GROUP_BYTES = substring_dedup.GROUP_BYTES, size
        try:
            edges = pa.Table.from_batches(substring_dedup._scan_edges(8, 6)(iter([batch])))
        finally:
            substring_dedup.GROUP_BYTES = old
        by = {}
        for r in edges.to_pylist():
            by.setdefault(r["bucket"], []).append(r)
        answers = [a for rs in by.values() for a in substring_dedup._resolve(8)(pa.Table.from_pylist(rs, edges.schema)).to_pylist()]
        found = substring_dedup._compact(pa.Table.from_pylist(answers, substring_dedup._ANSWER_ARROW)).to_pylist()
        return {(p["doc"], p["start"] + j) for p in found for j in range(p["edges"])}

    assert paths(1) == paths(1 << 20) != set()


def test_packed_numbers_survive():
    for x in ([], [5], [-3, 9, 2**40], [2**63 - 1, -(2**63)]):
        assert substring_dedup._unpack(substring_dedup._pack(np.array(x, np.int64))).tolist() == x


def test_remaining_texts_keep_white_space(spark):
    p = " ".join(f"w{i}" for i in range(20))
    rows = [(1, f"one\n{p}  two"), (2, f"three\t{p}\n\nfour  five"), (3, None), (4, f"{p}"), (5, "a  b\n")]
    got = {r.id: r.kept_text for r in substring_dedup.remaining_texts(docs(spark, rows)).collect()}
    assert got == {1: f"one\n{p}  two", 2: "three\tfour  five", 3: "", 4: "", 5: "a  b\n"}


def test_substring_odd_tables(spark):
    assert substring_dedup.removed_words(docs(spark, [])).count() == 0
    t = " ".join("abcdefghijklmnopqrstuvwxyz")
    assert [r.n_removed for r in substring_dedup.removed_words(docs(spark, [(1, t), (1, t)])).collect()] == [0, 0]
    got = {r.id: r.n_removed for r in substring_dedup.removed_words(docs(spark, [(None, t), (5, t)])).collect()}
    assert got == {None: 26, 5: 0}
    big = " ".join(f"{i % 977}" for i in range(300_000))
    assert {r.id: r.n_removed for r in substring_dedup.removed_words(docs(spark, [(1, big)])).collect()} == {1: 300_000 - 977}


# --- near copies -----------------------------------------------------------------------


def shingles(t, k=5):
    w = WORD.findall(t or "")
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_near(rows, least=0.8):
    s = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in s for b in s if a < b and s[a] and s[b] and len(s[a] & s[b]) >= least * len(s[a] | s[b])]
    return join_components(s, links)


def near_copies(seed, families=12, n=8):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    out = []
    for _ in range(families):
        base = [word() for _ in range(r.choice([3, 30, 120, 400]))]
        for _ in range(n):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                w[r.randrange(len(w))] = word()
            out.append((len(out) * 37 % 997, " ".join(w)))
    return out


@pytest.mark.parametrize("block", [2048, 3])
def test_near_copies_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK_DOCS", block)
    rows = [*near_copies(4), (2000, None), (2001, ""), (2002, " \n"), (2003, "a b"), (2004, "a  b"), (2005, "a b c")]
    got = {r.id: r for r in minhash_dedup.near_duplicates(docs(spark, rows)).collect()}
    want = brute_near(rows)
    assert {i: got[i].component_id for i in got} == want
    assert all(r.kept == (r.id == r.component_id) for r in got.values()) and got[2003].class_id == got[2004].class_id == 2003 and got[2001].kept


def test_near_dedup_rows_and_odd_tables(spark):
    assert minhash_dedup.near_duplicates(docs(spark, [])).count() == 0
    t = " ".join(f"w{i}" for i in range(60))
    out = minhash_dedup.near_dedup(docs(spark, [(1, t), (2, t + " end"), (3, "other"), (None, t)]))
    assert sorted((r.doc_id for r in out.collect()), key=str) == [1, 3, None] and len(out.columns) == 7
    assert minhash_dedup.near_duplicates(docs(spark, [(1, t), (1, t)])).where("kept").count() == 2


def test_an_id_over_several_texts(spark):
    """An id may head several classes, which stay apart; each row goes or stays by its own text."""
    a, b, c = (" ".join(f"{p}{i}" for i in range(60)) for p in "abc")
    rows = [(5, a), (5, b), (2, b), (9, a + " more"), (7, c), (7, c + " more"), (5, a), (None, b), (1, None), (1, "x")]
    got = sorted(((r.id, r.class_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs(spark, rows)).collect()), key=str)
    want = [(5, 5, 5, True)] * 2 + [(5, 2, 2, False), (2, 2, 2, True), (9, 9, 5, False), (7, 7, 7, True), (7, 7, 7, True), (None, 2, 2, True), (1, 1, 1, True), (1, 1, 1, True)]
    assert got == sorted(want, key=str)
    kept = minhash_dedup.near_dedup(docs(spark, rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(5, a), (5, a), (2, b), (7, c), (7, c + " more"), (None, b), (1, None), (1, "x")], key=str)
    # one word off: the copy of an id's second text goes, its first and unique text stays
    kept = minhash_dedup.near_dedup(docs(spark, [(5, a), (5, b + " more"), (2, b)])).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == [(2, b), (5, a)]


def test_counted_shingles(spark):
    a = "x y z u v " * 10
    rows = [(1, a), (2, a * 3)]
    assert {r.component_id for r in minhash_dedup.near_duplicates(docs(spark, rows)).collect()} == {1}
    assert {r.component_id for r in minhash_dedup.near_duplicates(docs(spark, rows), counts=True).collect()} == {1, 2}


def test_darts_estimate_weighted_similarity():
    h = _scan.mix(np.arange(40, dtype=np.uint64))
    r = np.random.default_rng(1)
    u, v = r.integers(1, 60, 40).astype(float), r.integers(1, 60, 40).astype(float)
    sig = minhash_dedup.dart_signatures(np.repeat([0, 1], 40), np.append(h, h), np.append(u, v), 2, 6000)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(u, v).sum() / np.maximum(u, v).sum()) < 0.03
    assert np.isinf(minhash_dedup.dart_signatures(np.zeros(0, int), h[:0], u[:0], 1, 8)).all()


def test_set_products():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 50, r.integers(1, 60)).astype(np.uint64)) for _ in range(30)]
    got = minhash_dedup.linked(sets[:12], sets[12:], 0.4, slab=7)
    for i, a in enumerate(sets[:12]):
        for j, b in enumerate(sets[12:]):
            x = len(np.intersect1d(a, b))
            assert got[i, j] == (x / (len(a) + len(b) - x) >= 0.4)


def test_components(spark):
    r = random.Random(9)
    links = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 200), r.randrange(100, 200)) for _ in range(60)] + [(500, 300 + i) for i in range(50)] + [(7, 7)]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a != b]
    want = join_components({x for p in real for x in p}, real)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- embeddings ----------------------------------------------------------------------------


def brute_vectors(rows, least=0.95):
    ok = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a in ok for b in ok if a != b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= least]
    low = join_components([i for i, _ in rows], links)
    return {i: (sum(a == i for a, _ in links), low[i]) for i, _ in rows}


@pytest.mark.parametrize("small", [False, True])
def test_vectors_against_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(pq_dedup, "MEMBERS", 16)
        monkeypatch.setattr(pq_dedup, "PROBERS", 10)
    r = np.random.default_rng(5)
    base = r.normal(size=(60, 32))
    vs = [*base, *(base[i % 15] + r.normal(size=32) * r.choice([0.05, 0.2, 0.3]) for i in range(120)), *[base[3]] * 10, base[4] * 2.0]
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in zip(r.permutation(len(vs)), vs, strict=True)]
    rows += [(900, None), (901, []), (902, [0.0] * 32), (903, [float("nan")] + [1.0] * 31), (904, [None] + [1.0] * 31), (905, [float("inf")] * 32), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, [-0.0, 1.0]), (909, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, id string")
    got = {x.id: (x.n_links, x.component_id) for x in pq_dedup.near_vectors(df, lists=9 if small else None).collect()}
    assert got == brute_vectors(rows)


def test_vectors_odd_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert pq_dedup.near_vectors(none).count() == 0
    junk = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<double>")
    assert sorted((r.id, r.n_links, r.component_id, r.kept) for r in pq_dedup.near_vectors(junk).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    twice = spark.createDataFrame([(1, [1.0, 0.1]), (1, [1.0, 0.1]), (None, [1.0, 0.1])], "vec_id long, embedding array<double>")
    assert sorted((str(r.id), r.n_links) for r in pq_dedup.near_vectors(twice).collect()) == [("1", 1), ("1", 1), ("None", 0)]


def test_recall_of_probes_is_high():
    r = np.random.default_rng(0)
    x = pq_dedup._unit(r.normal(size=(6000, 64)))
    index = pq_dedup.fit(x[:3000], 0.95, 40)
    q = x[:2000]
    u = r.normal(size=q.shape)
    u -= (u * q).sum(1)[:, None] * q
    other = 0.95 * q + np.sqrt(1 - 0.95**2) * u / np.linalg.norm(u, axis=1)[:, None]
    own, _ = index.probes(other)
    _, lists = index.probes(q)
    assert np.mean([o in set(p.tolist()) for o, p in zip(own, lists, strict=True)]) > 0.99
    assert np.mean([len(p) for p in lists]) < 20


@pytest.mark.parametrize("effective", [4, 8])
def test_vectors_near_a_subspace_lose_no_link(spark, effective):
    r = np.random.default_rng(effective)
    x = pq_dedup._unit(r.normal(size=(2000, effective)))
    u = r.normal(size=x.shape)
    u -= (u * x).sum(1)[:, None] * x
    other = 0.9501 * x + np.sqrt(1 - 0.9501**2) * u / np.linalg.norm(u, axis=1)[:, None]
    v = np.concatenate([x, other]) @ np.linalg.qr(r.normal(size=(64, effective)))[0].T
    index = pq_dedup.fit(v, 0.95, 100)
    own, probes = index.probes(v)
    a, b = np.arange(2000), np.arange(2000, 4000)
    assert all(own[j] in probes[i] or own[i] in probes[j] for i, j in zip(a.tolist(), b.tolist(), strict=True))
    some = np.concatenate([v[:300], v[2000:2300]])
    df = spark.createDataFrame([(i, x) for i, x in enumerate(some.tolist())], "vec_id long, embedding array<double>")
    got = {x.id: (x.n_links, x.component_id) for x in pq_dedup.near_vectors(df, lists=40).collect()}
    cosine = pq_dedup._unit(some) @ pq_dedup._unit(some).T >= 0.95
    links = np.argwhere(np.triu(cosine, 1)).tolist()
    low = join_components(range(len(some)), links)
    assert got == {i: (int(cosine[i].sum()) - 1, low[i]) for i in range(len(some))}


def test_vectors_that_share_an_id_all_link(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (5, [1.0, 0.01, 0.0]), (6, [0.01, 1.0, 0.0]), (7, [0.0, 1.0, 0.01]), (8, [0.0, 0.0, 1.0]), (1, [0.0, 1.0, 0.0])]
    got = pq_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.id, r.n_links, r.component_id, r.kept) for r in got) == [
        (1, 1, 1, True), (1, 3, 1, True), (1, 3, 1, True), (5, 1, 1, False), (6, 3, 1, False), (7, 3, 1, False), (8, 0, 8, True)
    ]


def test_words_at_chunk_edges():
    texts = ["a b", "", "  ", "c", "d e ", None, " f"]
    c = next(_scan.chunks(pa.array(texts)))
    w = _scan.words(c)
    assert [c.data[s:e].tobytes() for s, e in zip(w.starts, w.ends, strict=True)] == [b"a", b"b", b"c", b"d", b"e", b"f"] and w.counts.tolist() == [2, 0, 0, 1, 2, 0, 1]
    assert sum(x.last - x.first for x in _scan.chunks(pa.array(texts).slice(1, 5), 2)) == 5
