"""BPE and packing: exact round trips against the tokenizers library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from waymark.llm import _scan, bpe, packing
from waymark.llm._spark import ship
from waymark.llm.queries import tokenizer_path

PIECES = [
    "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", "''", " ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "a", "bc", "é", "ß", "１", "½", "²", "漢字", "🙂", "🙂\u200d♀\ufe0f", "\u0301", "!", "...", "$$$",
    "12", "3", "<|endoftext|>", "\u0378", "x'sing", "'LL", " 's", "don't", "we'll've", "\x00", "\x1c", "\x85", "Ⅷ", "ª", "_", "\u200b", "hello", "World", " the", "\ud7ff", "\U0010ffff",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def compiled():
    return bpe.build(tokenizer_path(), [b"hello", b" the", b"World", b" 12", "é".encode(), b"x" * 40, b"tionthe", b"thetion"])


def texts(n=3000):
    r = random.Random(1)
    return [
        *("".join(r.choice(PIECES) for _ in range(r.randint(0, 14))) for _ in range(n)), "", "a" * 500, "ab" * 300, "é" * 200, " " * 100 + "x", "\u3000" * 3 + "y", "x" * 70 + " " + "!" * 90,
        "".join(r.choice("abcdefgh") for _ in range(3000)),
    ]


def test_ids_are_those_of_the_library(library, compiled):
    all_ = texts()
    want = [e.ids for e in library.encode_batch(all_, add_special_tokens=False)]
    at = 0
    for c in _scan.chunks(pa.array(all_), 5000):
        ids, offs = bpe.encode(compiled, c)
        back = bpe.decode(bpe.load(compiled), ids, offs)
        for i in range(c.last - c.first):
            assert ids[offs[i] : offs[i + 1]].tolist() == want[at]
            assert back[i].decode() == library.decode(want[at], skip_special_tokens=False)
            at += 1
    assert at == len(all_)


def test_decoding_any_ids(library, compiled):
    r = np.random.default_rng(0)
    for _ in range(50):
        ids = r.integers(0, 50257, 12)
        assert bpe.decode(bpe.load(compiled), ids, np.array([0, 12]))[0].decode() == library.decode(ids.tolist(), skip_special_tokens=False)


def test_transducer_is_minimal_and_numbers_its_words():
    r = random.Random(4)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 7))).encode() for _ in range(400)} | {b"tion", b"ation", b"nation"})
    t = bpe.compile_lexicon(words)
    probe = words + [w + b"z" for w in words[:50]] + [b"q", b"abcabcabcabc"]
    sizes = np.array([len(w) for w in probe])
    ends = np.cumsum(sizes)
    got = bpe.walk(t, np.frombuffer(b"".join(probe), np.uint8), ends - sizes, ends)
    known = {w: i for i, w in enumerate(words)}
    assert got.tolist() == [known.get(w, -1) for w in probe]
    shared = bpe.compile_lexicon([a + b"ation" for a in (b"x", b"y", b"z")])
    assert len(shared["final"]) == 7  # the start, and one chain for all three
    assert (bpe.walk(bpe.compile_lexicon([]), np.frombuffer(b"ab", np.uint8), np.array([0]), np.array([2])) == -1).all()


def test_round_trip_over_a_table(spark, library):
    import hashlib

    ship(spark)
    some = [(i, t) for i, t in enumerate([*texts(60), None, "the the the cat cat"])]
    df = spark.createDataFrame([(i, t, "x") for i, t in some], "doc_id long, text string, id string").repartition(3)
    got = {r.id: r for r in bpe.round_trip(df, tokenizer_path(), most=50).collect()}
    for i, t in some:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    encoded = bpe.encode_documents(df, tokenizer_path(), most=0)
    assert {r.id: r.text for r in bpe.decode_documents(encoded, tokenizer_path()).collect()} == {i: library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for i, t in some}
    assert bpe.round_trip(df.limit(0), tokenizer_path()).count() == 0


def test_frequent_words_are_bounded(spark):
    ship(spark)
    df = spark.createDataFrame([("the cat the cat the dog dog",), (None,), ("",)], "text string")
    assert set(bpe.frequent_words(df, most=2)) <= {b" the", b" cat", b" dog"} and len(bpe.frequent_words(df, most=2)) <= 2


# --- packing --------------------------------------------------------------------------


@pytest.mark.parametrize("shape", ["uniform", "one length", "short", "empty", "pairs"])
def test_plan_uses_every_tail_once(shape):
    r = np.random.default_rng(3)
    h = {
        "uniform": r.integers(0, 40, 256), "one length": np.bincount([150] * 77, minlength=256), "short": np.bincount(r.integers(1, 4, 500), minlength=256),
        "empty": np.zeros(256, int), "pairs": np.bincount([100] * 10 + [156] * 10, minlength=256),
    }[shape]
    p = packing.plan(h, 256)
    fill = {}
    used = np.zeros(256, int)
    for i, (length, low, first, offset) in enumerate(zip(p.length, p.low, p.first, p.offset, strict=True)):
        later = [b for a, b in zip(p.length, p.low, strict=True) if a == length and b > low]
        n = min([*later, p.used[length]]) - low
        used[length] += n
        for j in range(n):
            fill.setdefault(first + j, []).append((offset, length))
        assert i >= 0
    assert all(sum(x for _, x in parts) == 256 and sorted(a for a, _ in parts) == np.append(0, np.cumsum([x for _, x in sorted(parts)])[:-1]).tolist() for parts in fill.values())
    assert len(fill) == p.planned and (used == p.used).all() and (used[1:] <= h[1:]).all()
    assert p.residual == ((h - used) * np.arange(256))[1:].sum()
    sizes = np.diff(p.bounds())
    assert all(s & (s - 1) == 0 for s in sizes) and sizes.sum() == p.residual % 256
    if shape == "pairs":
        assert p.planned == 10 and p.residual == 0


def test_least_squares_match_a_solvable_histogram():
    h = np.zeros(64, int)
    h[[20, 44, 10]] = 7, 7, 0
    combos = packing.combinations(h, 64)
    assert combos.tolist() == [[20, 44, 0]] and packing.nnls(combos, h) == pytest.approx([7], rel=1e-6)


@pytest.mark.parametrize("window", [1024, 16])
def test_pieces_cover_every_id_once(spark, library, window):
    ship(spark)
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(["the", "cat", "sat", "é", "!"]) for _ in range(r.choice([0, 3, 30, 200])))) for i in range(80)] + [(500, None), (501, ""), (500, "again the same id")]
    df = spark.createDataFrame([(i, t, 5, 6) for i, t in rows], "doc_id long, text string, start int, rank int").repartition(3)
    got = [tuple(x) for x in packing.pack(df, tokenizer_path(), window=window).collect()]
    docs, seqs = {}, {}
    for doc, start, length, crc, n, seq, offset in got:
        docs.setdefault((doc, n), []).append((start, length, crc))
        seqs.setdefault(seq, []).append((offset, length))
    want = {}
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.setdefault((i, len(ids)), []).append(ids)
    assert set(docs) == set(want)
    for key, ids in want.items():
        assert sum(length for _, length, _ in docs[key]) == key[1] * len(ids)
        for start, length, crc in docs[key]:
            assert crc in {zlib.crc32(x[start : start + length].tobytes()) for x in ids}
    padding = 0
    for parts in seqs.values():
        parts.sort()
        total = sum(x for _, x in parts)
        assert [a for a, _ in parts] == np.append(0, np.cumsum([x for _, x in parts])[:-1]).tolist() and total <= window
        padding += window - total if total & (total - 1) else 0
    assert padding == 0
    assert packing.pack(df.limit(0), tokenizer_path()).count() == 0
