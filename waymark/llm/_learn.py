"""What the two document classifiers share: a labelled, bounded sample of feature rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _scan
from ._spark import cut, held_out

#: At most about so many labelled rows are fitted to.
SAMPLE = 20_000


def _rows(measure: Callable[[_scan.Chunk], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _scan.chunks(batch.column(1)):
                x = measure(c, *(column[c.first : c.last] for column in batch.columns[2:]))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[c.first : c.last], lists], names=["id", "x"])

    return run


def feature_rows(docs: DataFrame, measure: Callable[..., np.ndarray], id_col: str, text_col: str, *more) -> DataFrame:
    """(id, x array<double>): the statistics of every whole text, made once; only they are shuffled, no text. ``more``: columns that ``measure`` is given too."""
    return cut(docs.select(F.col(id_col).cast("long"), text_col, *more).mapInArrow(_rows(measure), "id long, x array<double>"), narrow=True)


def known_labels(labels: DataFrame, label_col: str, label_id: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """(id, y) of about ``sample`` labels of rows that aren't held out, chosen by a hash of the id.

    Null labels and ids are left out; of several labels of a document the largest counts.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(label_id).isNotNull() & ~held_out(label_id))
    known = known.groupBy(F.col(label_id).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    share = min(1.0, sample / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))


def labelled_sample(rows: DataFrame, labels: DataFrame, label_col: str, label_id: str = "doc_id", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, id) of the rows that ``known_labels`` chooses, ordered by id."""
    got = rows.join(known_labels(labels, label_col, label_id, sample), "id").select("id", "x", "y").collect()
    got = {r["id"]: r for r in got}
    ids = sorted(got)
    x = np.array([got[i]["x"] for i in ids], float) if ids else np.zeros((0, 1))
    return x, np.array([got[i]["y"] for i in ids], int), np.array(ids, np.int64)


def _scores(score: Callable[[np.ndarray], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            n = len(lists)
            x = np.asarray(lists.flatten()).reshape(n, -1) if n else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(x) if n else np.zeros(0), pa.float64())], names=["id", "score"])

    return run


def scored(rows: DataFrame, score: Callable[[np.ndarray], np.ndarray], threshold: float) -> DataFrame:
    """(id, held_out, score, predicted)."""
    out = rows.mapInArrow(_scores(score), "id long, score double")
    return out.select("id", held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def nearest_gap(at: np.ndarray, others: np.ndarray, far: int) -> np.ndarray:
    """Distance of each position to the nearest of the sorted others, ``far`` at most."""
    if not len(others) or not len(at):
        return np.full(len(at), far)
    i = np.searchsorted(others, at)
    right = others[np.minimum(i, len(others) - 1)]
    left = others[np.maximum(i - 1, 0)]
    return np.minimum(np.minimum(np.abs(right - at), np.abs(at - left)), far)


def hashes_of(words: Sequence[str], fold: np.ndarray) -> np.ndarray:
    """Sorted hashes of words as a scan of folded bytes gives them."""
    raw = [fold[np.frombuffer(w.encode(), np.uint8)] for w in words]
    sizes = np.array([len(r) for r in raw])
    flat = np.concatenate(raw)
    ends = np.cumsum(sizes)
    return np.unique(_scan.span_hash(flat.astype(_scan.U64) + _scan.U64(1), ends - sizes, ends, _scan.BYTE_BASES[0]))


def member(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return known[at] == h
