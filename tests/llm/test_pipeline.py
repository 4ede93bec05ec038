"""The registered queries against SQL, and each pipeline stage against brute force on what came before."""

from __future__ import annotations

import re

import pytest
from compare import duck_rows, spark_rows
from test_dedup import brute_near, brute_removed

import corpus_pipeline
from waymark.llm import oracles, queries, toxicity


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_queries_against_sql(spark, sf_dir, name):
    assert spark_rows(queries.QUERIES[name](spark, sf_dir)) == duck_rows(oracles.ORACLES[name], sf_dir)


def test_names_cover_all():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "minhash_dedup", "substring_dedup", "packing"]


def test_stages_against_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = docs
    seen = [{r.doc_id: r for r in docs.collect()}]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, at, sf_dir)
        out.write.parquet(str(tmp_path / str(i)))
        at = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert at.columns == docs.columns
            seen.append({r.doc_id: r for r in at.collect()})
            assert len(seen[-1]) == at.count()
    start, clean, exact, near, cut = seen
    bad = {r.id for r in toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1").collect()}
    assert clean == {i: r for i, r in start.items() if i not in bad}
    last = {}
    for i, r in clean.items():
        last[r.text] = max(i, last.get(r.text, i))
    assert exact == {i: clean[i] for i in last.values()}
    root = brute_near([(i, r.text) for i, r in exact.items()])
    assert near == {i: r for i, r in exact.items() if root[i] == i}
    removed = brute_removed([(i, r.text) for i, r in near.items()], 20)
    assert set(cut) == set(near)
    for i, r in cut.items():
        n, gone, _ = removed[i]
        assert len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) == n - gone and r.n_chars == len(r.text) and (gone or r.text == near[i].text)
    pieces = at.collect()
    assert {p.doc_id for p in pieces} == set(cut)
    assert sorted(map(tuple, pieces)) == sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))


def test_repeated_rows_do_not_multiply(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    words = [" ".join(f"{p}{i}" for i in range(30)) for p in "abcdefgh"]
    rows = [(1, words[0], "en", "x")] * 3 + [(2, words[1], "en", "z"), (2, words[1], "en", "y"), (3, words[2], "en", "x"), (3, words[3], "de", "x"), (4, words[2], "fr", "x")]
    rows += [(None, words[4], "en", "n"), (None, words[5], "de", "n"), (None, words[5], "de", "n"), (None, words[6], "fr", "n"), (None, words[1], "fr", "n"), (None, None, "fr", "n")]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], kind)
    exact = corpus_pipeline.exact_stage(spark, df, "")
    want = [(1, 0, "en", "x"), (2, 1, "en", "y"), (3, 3, "de", "x"), (4, 2, "fr", "x"), (None, 4, "en", "n"), (None, 5, "de", "n"), (None, 6, "fr", "n")]
    want = {(i, words[w], lang, source, len(words[w])) for i, w, lang, source in want} | {(None, None, "fr", "n", 0)}
    got = list(map(tuple, exact.collect()))
    assert exact.columns == df.columns and len(got) == len(want) and set(got) == want
    want = sorted(str((i, t or "", *more)) for i, t, *more in want)
    assert corpus_pipeline.substring_stage(spark, df, "").count() == len(rows)
    assert sorted(str(tuple(r)) for r in corpus_pipeline.substring_stage(spark, exact, "").collect()) == want


def test_stages_of_nothing(spark, sf_dir):
    empty = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_library_works_without_this_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    for name in ("waymark", "__spark_entry__.py"):
        src = root / name
        (shutil.copytree if src.is_dir() else shutil.copy)(src, tmp_path / name)
    shutil.rmtree(tmp_path / "waymark" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'road_ranging' in q and not [n for n in q if n.startswith('op') or n == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
