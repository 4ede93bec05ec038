"""Fingerprints and paragraph differences against sets in plain Python."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from waymark.llm import fingerprints, paragraph_sketch as ps
from waymark.llm._scan import chunks
from waymark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, id string, at int, extra boolean, range int, tie long, copy string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "a", 1, True, 2, 3, "b") for i, t in rows], SCHEMA)


def items(text):
    """The set of a text's digests, each by itself."""
    return set(ps.digests(next(chunks(pa.array([text], pa.large_string())))).digests.tolist()) if text else set()


def pieces(text):
    (c,) = chunks(pa.array([text], pa.large_string()))
    starts, _ = ps.paragraphs(c)
    raw = text.encode()
    return [raw[a:b].decode() for a, b in zip(starts, [*starts[1:], len(raw)])]


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_paragraphs_are_the_whole_text_cut_at_lines_and_by_content():
    rng = random.Random(3)
    for _ in range(50):
        text = "".join(rng.choice(["word ", "é ", "x", "\n", "\n\n", " ", "\t", "longer words here ", "ß。"]) for _ in range(rng.randrange(1, 80)))
        cut = pieces(text)
        assert "".join(cut) == text
        assert all("\n" not in p.strip() for p in cut)
    line = " ".join(f"w{i}" for i in range(200))
    a, b = pieces(line), pieces("quite other words before " + line)
    assert len(a) > 8 and len(set(a) & set(b)) >= len(a) - 2  # cut alike after what is new


def test_repeated_paragraphs_count_each_time():
    assert len(items("same\nsame\nsame\nother")) == 4
    assert len(items("same\nsame\n") ^ items("same\n")) in (1, 2)


@pytest.mark.parametrize("n", [0, 1, 5, 40, 3000])
def test_peeling_gives_the_symmetric_difference(n):
    rng = np.random.default_rng(n)
    shared = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    versions = []
    for _ in range(2):
        rows = [np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, rng.integers(0, n + 1)).astype(np.uint64)])) for _ in range(6)]
        versions.append(ps.Items(np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])))
    got = ps.differences(*versions)
    for i in range(6):
        a, b = (set(v.digests[v.offs[i] : v.offs[i + 1]].tolist()) for v in versions)
        mine = got.row == i
        assert set(got.digest[mine & (got.side == 1)].tolist()) == a - b and set(got.digest[mine & (got.side == -1)].tolist()) == b - a
        assert mine.sum() == len(a ^ b)
        assert got.cells[i] >= len(a ^ b) or len(a ^ b) <= got.cells[i]


def test_a_stuck_table_is_made_larger():
    a = ps.Items(np.arange(1, 401, dtype=np.uint64), np.array([0, 400]))
    b = ps.Items(np.zeros(0, np.uint64), np.array([0, 0]))
    got = ps.differences(a, b)
    assert got.cells[0] >= 400 > ps.CELLS and len(got.digest) == 400


def literal(rows):
    order = sorted(rows, key=lambda r: r[0])
    out = {}
    for n, (i, t) in enumerate(order):
        t, after = t or "", order[(n + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), edited, after)
    return out


TEXTS = ["", None, "one", "a b c d e f g h i j k l m n o p q r s t", "ä ö ü\nß 𝄞𝄞 zwei\n", " \n ", "same\nsame\nsame", "x" * 5000, "w " * 3000]


def check(got, rows):
    expect = literal(rows)
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        n, sha, edited, after = expect[r.id]
        t = text[r.id] or ""
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(jaccard(items(t), items(edited))) and r.near_next == pytest.approx(jaccard(items(t), items(after)))
    marks = {}
    for r in got:
        assert marks.setdefault(text[r.id] or "", r.fingerprint) == r.fingerprint
    assert len(set(marks.values())) == len(marks)


def test_edited_likeness_against_sets(spark):
    rng = random.Random(1)
    rows = [(i * 7 - 50, rng.choice(TEXTS) if rng.random() < 0.5 else "".join(rng.choice(["the ", "cat ", "sat\n", "é ", "\n", f"w{rng.randrange(50)} "]) for _ in range(rng.randrange(300)))) for i in range(150)]
    check(fingerprints.edited_likeness(docs(spark, rows)).collect(), rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_few_documents(spark, n):
    rows = [(i, f"text {i} of some\nlines") for i in range(n)]
    check(fingerprints.edited_likeness(docs(spark, rows)).collect(), rows)


def test_repeated_and_null_ids(spark):
    rows = [(None, "a b"), (None, "c"), (None, None), (5, "x y z"), (5, "x y z"), (5, "q"), (9, "last")]
    got = fingerprints.edited_likeness(docs(spark, rows)).collect()
    assert sorted(((r.id, r.n_chars) for r in got), key=str) == sorted(((i, len(t or "")) for i, t in rows), key=str)
    only = fingerprints.edited_likeness(docs(spark, [(None, "a b"), (None, "c d")])).collect()
    assert len(only) == 2 and all(r.id is None for r in only)


def test_fingerprints_and_changes_between_versions(spark):
    old = [(1, "a\nb\nc"), (2, "same"), (3, None), (4, "gone"), (None, "x")]
    new = [(1, "a\nB\nc\nd"), (2, "same"), (3, "now\nsome"), (5, "new"), (None, "x")]
    marks = {r.id: r for r in fingerprints.fingerprints(docs(spark, old)).collect()}
    assert len(marks) == 5 and marks[1].n_paragraphs == 3 and marks[3].n_paragraphs == 0
    got = {r.id: r for r in fingerprints.changed_paragraphs(docs(spark, old), docs(spark, new)).collect()}
    assert set(got) == {1, 2, 3} and got[2].removed == [] == got[2].added and got[3].removed == [] and len(got[3].added) == 2
    was, now = (np.array(sorted(items(t)), np.uint64).view(np.int64).tolist() for t in (old[0][1], new[0][1]))
    assert set(got[1].removed) == set(was) - set(now) and set(got[1].added) == set(now) - set(was)
    assert fingerprints.fingerprints(docs(spark, [])).count() == 0 == fingerprints.changed_paragraphs(docs(spark, []), docs(spark, old)).count()


def test_query_against_sets(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(QUERIES["op13_fingerprints"](spark, sf_dir).withColumnRenamed("doc_id", "id").collect(), rows)
