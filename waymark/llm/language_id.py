"""Language ID: nearest of several clustered centroids per language.

A text's vector holds the TF-IDF weights of its hashed n-grams of 1 to 3
letters (A-Z and the capitals of Latin-1 folded, everything that isn't a letter
a word boundary), of unit length. Document frequencies are counted over every
training text. Centroids come from spherical k-means within each language, on
a bounded sample of training vectors; the sample bound is a parameter. A text
gets the language of the centroid with the greatest cosine. ``score`` sets
the best cosine of each language against the others; ``rejected`` says that the
distance to the nearest centroid is beyond what ``reject_quantile`` of that
centroid's own training vectors show.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _scan
from ._scan import U64

BUCKETS = 4096
SAMPLE = 800
#: Sampled texts of all languages together, which the driver holds.
SAMPLE_TOTAL = 8000
CENTROIDS = 4
#: Documents counted at once, since counts are dense.
ROWS = 256
#: Sampled rows are chosen by a hash modulo this, fine enough for any number of rows.
GRAIN = 1 << 40
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    """Each byte folded: small letters, bytes of longer characters as they are, else a boundary (0)."""
    t = np.zeros(256, np.uint8)
    t[0x80:] = np.arange(0x80, 0x100)
    for b in range(ord("a"), ord("z") + 1):
        t[b] = t[b - 32] = b
    return t


LETTERS = _letters()


def gram_counts(c: _scan.Chunk, buckets: int = BUCKETS) -> np.ndarray:
    """documents x buckets counts of hashed 1-, 2- and 3-grams of bytes."""
    n = len(c.offs) - 1
    b = LETTERS[c.data]
    latin = np.zeros(len(b), bool)
    latin[1:] = (c.data[:-1] == 0xC3) & (c.data[1:] >= 0x80) & (c.data[1:] <= 0x9E) & (c.data[1:] != 0x97)
    b = b + (latin * np.uint8(0x20))
    doc = np.repeat(np.arange(n), np.diff(c.offs))
    out = np.zeros(n * buckets, np.int64)
    code = b.astype(U64)
    for k in (1, 2, 3):
        if k > 1:
            code = (code[:-1] << U64(8)) | b[k - 1 :].astype(U64)
        if not len(code):
            break
        ok = (b[: len(code)] > 0) if k == 1 else (doc[: len(code)] == doc[k - 1 :]) & (code != 0)
        if k == 3:
            ok &= b[1 : len(code) + 1] > 0  # a boundary only at an end
        at = ((code * U64(0x9E3779B97F4A7C15) + U64(k * 0xC2B2AE3D27D4EB4F % 2**64)) >> U64(64 - buckets.bit_length() + 1)).astype(np.int64)
        out += np.bincount(doc[: len(code)][ok] * buckets + at[ok], minlength=n * buckets)
    return out.reshape(n, buckets)


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return (v / np.maximum(np.sqrt((v * v).sum(1)), 1e-12)[:, None]).astype(np.float32)


def has_letter(c: _scan.Chunk) -> np.ndarray:
    ascii_ = (LETTERS[c.data] > 0) & (c.data < 0x80)
    out = np.diff(np.append(0, np.cumsum(ascii_))[c.offs]) > 0
    for i in np.flatnonzero(~out).tolist():
        out[i] = any(ch.isalpha() for ch in c.doc(i).decode())
    return out


def _document_frequency(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for c in _scan.chunks(batch.column(0), rows=ROWS):
                df += (gram_counts(c, buckets) > 0).sum(0)
                n += c.last - c.first
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets + 1), pa.int32()), pa.array(np.append(df, n), pa.int64())], names=["bucket", "df"])

    return run


def _sample_vectors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _scan.chunks(batch.column(1), rows=ROWS):
                x = gram_counts(c, buckets)
                blobs = [np.minimum(row, 65535).astype("<u2").tobytes() for row in x]
                yield pa.RecordBatch.from_arrays([batch.column(0)[c.first : c.last], pa.array(blobs, pa.binary())], names=["lang", "counts"])

    return run


@dataclass
class Model:
    """Unit centroids, the language and the least accepted cosine of each; ``scale`` sharpens scores."""

    langs: list[str]
    centroids: np.ndarray
    lang_of: np.ndarray
    floor: np.ndarray
    idf: np.ndarray
    scale: float = 25.0

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, rejected) of each unit vector."""
        cos = x @ self.centroids.T
        best = cos.argmax(1)
        top = np.stack([cos[:, self.lang_of == i].max(1) for i in range(len(self.langs))], 1)
        odds = np.exp(self.scale * (top - top.max(1, keepdims=True)))
        return self.lang_of[best], odds.max(1) / odds.sum(1), cos[np.arange(len(x)), best] < self.floor[best]


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k unit centroids, seeded by farthest points from the mean."""
    seeds = [x.mean(0) / max(float(np.linalg.norm(x.mean(0))), 1e-12)]
    while len(seeds) < min(k, len(x)):
        seeds.append(x[(x @ np.stack(seeds).T).max(1).argmin()])
    c = np.stack(seeds)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        for i in range(len(c)):
            if (own == i).any():
                m = x[own == i].mean(0)
                c[i] = m / max(float(np.linalg.norm(m)), 1e-12)
    own = (x @ c.T).argmax(1)
    return c[np.unique(own)]


def fit(docs: DataFrame, train: F.Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS, sample: int = SAMPLE, centroids: int = CENTROIDS, reject_quantile: float = 0.005, sample_total: int = SAMPLE_TOTAL, most_languages: int = 1000) -> Model | None:
    """Learn from the rows that ``train`` accepts and whose language isn't null.

    Document frequencies use all of them; centroids about ``sample`` rows of
    each language, ``sample_total`` together, chosen by a hash of the id. None if there is nothing to learn.
    More than ``most_languages`` values of the language are an error, since the driver holds some rows for each.
    """
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    df = rows.select(text_col).mapInArrow(_document_frequency(buckets), "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).collect()
    count = np.zeros(buckets + 1)
    for r in df:
        count[r["bucket"]] = r["df"]
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(lang_col)).count().limit(most_languages + 1).collect()}  # one row per language
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not sizes:
        return None
    idf = np.log((count[-1] + 1) / (count[:-1] + 1)) + 1
    sample = max(1, min(sample, sample_total // len(sizes)))
    share = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, sample / n))])
    chosen = rows.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(GRAIN)) < share[F.col(lang_col)] * GRAIN).select(F.col(lang_col).alias("lang"), text_col)
    vectors = chosen.mapInArrow(_sample_vectors(buckets), "lang string, counts binary").collect()
    langs, cs, of, floor = sorted(sizes), [], [], []
    for i, lang in enumerate(langs):
        mine = [np.frombuffer(r["counts"], "<u2") for r in vectors if r["lang"] == lang]
        if not mine:
            continue
        x = unit_vectors(np.stack(mine), idf)
        c = spherical_kmeans(x, centroids)
        cos = x @ c.T
        for j in range(len(c)):
            near = cos[cos.argmax(1) == j, j]
            floor.append(float(np.quantile(near, reject_quantile)) - 0.05 if len(near) else 0.0)
        cs.append(c)
        of += [i] * len(c)
    if not cs:
        return None
    known = sorted(set(of))
    return Model([langs[i] for i in known], np.concatenate(cs).astype(np.float32), np.array([known.index(i) for i in of]), np.array(floor), idf)


def _predict(model: Model | None, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _scan.chunks(batch.column(1), _scan.CHUNK_BYTES // 2, ROWS):
                n = c.last - c.first
                lang, score, far = np.zeros(n, np.int64), np.zeros(n), np.ones(n, bool)
                letters = has_letter(c) & (model is not None)
                names = [UNDETERMINED]
                if model is not None:
                    lang, score, far = model.predict(unit_vectors(gram_counts(c, buckets), model.idf))
                    names = [*model.langs, UNDETERMINED]
                lang = np.where(letters, lang, len(names) - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[c.first : c.last], pa.array(np.array(names, object)[lang], pa.string()), pa.array(np.where(letters, score, 0.0), pa.float64()), pa.array(far | ~letters)],
                    names=["id", "lang_pred", "score", "rejected"],
                )

    return run


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(id, lang_pred, score, rejected), one row per input row.

    Null texts, and those without a letter, are ``und`` with score 0. All others
    get a learned language, also where the distance rejects it. Without
    anything learned all are ``und``. Rows that repeat count by themselves; an
    empty table gives an empty result; further columns are ignored.
    """
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_predict(model, buckets), "id long, lang_pred string, score double, rejected boolean")
