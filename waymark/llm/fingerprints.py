"""Document fingerprints, and what two versions of a document differ by (operator 13); the tables themselves are in ``paragraph_sketch``."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import paragraph_sketch as ps
from ._scan import chunks, signed
from ._spark import partitions, ship

#: Ranges of ids per shuffle partition, so that each partition gets about as much.
RANGES = 4


def _texts(column: pa.Array) -> pa.Array:
    return pc.fill_null(column, "").cast(pa.large_string())


def _sketches(cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, text) -> (id, n_paragraphs, fingerprint)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b.column(1), rows=ps.MOST_CELLS // cells):
                items = ps.digests(c)
                t = ps.tables(items, cells)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.first, c.last - c.first), pa.array(np.diff(items.offs), pa.int64()), pa.array([t.text(i) for i in range(c.last - c.first)])], names=["id", "n_paragraphs", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = ps.CELLS) -> DataFrame:
    """(id, n_paragraphs, fingerprint), one row per row of ``docs``.

    Equal texts have equal fingerprints. A null text counts as empty, and an empty one has a table of zeros;
    a text of any length is read whole. Repeated and null ids keep a row each, an empty table gives an empty result, further columns are ignored.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_sketches(cells), f"id {kind}, n_paragraphs long, fingerprint string")


def _changes(cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def lists(n: int, row: np.ndarray, d: np.ndarray) -> pa.Array:
        order = np.lexsort((signed(d), row))
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[order], np.arange(n + 1)), pa.int32()), pa.array(signed(d[order])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old, new = _texts(b.column(1)), _texts(b.column(2))
            for c in chunks(old, rows=ps.MOST_CELLS // cells):
                n = c.last - c.first
                ids = b.column(0).slice(c.first, n)
                was, now = ps.digests(c), _digests(new.slice(c.first, n))
                got = ps.differences(was, now, cells)
                gone, come = got.side > 0, got.side < 0
                yield pa.RecordBatch.from_arrays([ids, lists(n, got.row[gone], got.digest[gone]), lists(n, got.row[come], got.digest[come]), pa.array(got.cells)], names=["id", "removed", "added", "cells"])

    return run


def changed_paragraphs(old: DataFrame, new: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = ps.CELLS) -> DataFrame:
    """(id, removed, added, cells): the paragraph digests in only the old and only the new version of each document in both tables.

    ``cells`` says how large a table they came out of. Null texts count as empty; a null id meets nothing, and of rows
    that repeat an id each old one meets each new one. Further columns are ignored.
    """
    ship(old.sparkSession)
    kind = old.schema[id_col].dataType.simpleString()
    a = old.select(F.col(id_col).alias("id"), F.col(text_col).alias("old"))
    both = a.join(new.select(F.col(id_col).alias("id"), F.col(text_col).alias("new")), "id")
    return both.mapInArrow(_changes(cells), f"id {kind}, removed array<long>, added array<long>, cells long")


def _digests(texts: pa.Array) -> ps.Items:
    """Digests of texts whose bytes may be more than one chunk's."""
    parts = [ps.digests(c) for c in chunks(texts)]
    sizes = np.concatenate([np.zeros(0, np.int64), *(np.diff(p.offs) for p in parts)])
    return ps.Items(np.concatenate([np.zeros(0, np.uint64), *(p.digests for p in parts)]), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


def count_up_to(bounds: list, value: Column) -> Column:
    """How many of the ascending bounds are at most the value: a binary search."""
    known = F.array(*[F.lit(b) for b in bounds])
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(F.get(known, at + s - 1) <= value, at + s).otherwise(at))


def in_order(docs: DataFrame) -> DataFrame | None:
    """(id, text, extra) in partitions and orders of rows in which each row that isn't ``extra`` is followed by the next document's.

    Ids are cut into ranges at ids that occur, the last range's rows being followed by the first document. The first row of each
    range also goes to the range before, as the extra one at its end. So the texts move once,
    and what is next needs no join and no number. None where there is no row.
    """
    parts = partitions(docs.sparkSession)
    tie = F.xxhash64("text")
    null = docs.where("id is null").agg(F.count(F.lit(1)), F.min(tie)).first()
    ranges = docs.select("id").where("id is not null").repartitionByRange(RANGES * parts, "id").groupBy(F.spark_partition_id()).agg(F.min("id").alias("low"))
    bounds = sorted({r["low"] for r in ranges.collect()})  # a row per range
    if not bounds and not null[0]:
        return None
    at = F.coalesce(count_up_to(bounds, F.col("id")), F.lit(0)) if bounds else F.lit(0)
    begin = (F.get(F.array(*[F.lit(b) for b in bounds]), F.col("at") - 1) == F.col("id")) if bounds else F.lit(False)
    first = F.when(F.col("id").isNull(), F.col("tie") == F.lit(null[1])).otherwise(begin)
    start = 0 if null[0] else 1
    before = F.when(F.col("at") == start, F.lit(len(bounds))).otherwise(F.col("at") - 1)
    rows = docs.select("id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", tie).withColumn("at", at.cast("int"))
    copies = F.array(F.struct(F.col("at").alias("range"), F.lit(False).alias("extra")), F.when(F.coalesce(first, F.lit(False)), F.struct(before.cast("int").alias("range"), F.lit(True).alias("extra"))))
    dealt = rows.withColumn("copy", F.explode(F.filter(copies, lambda c: c.isNotNull()))).select("id", "text", "tie", "copy.range", "copy.extra")
    return dealt.repartition(parts, "range").sortWithinPartitions("range", "extra", F.asc_nulls_first("id"), "tie").select("id", "text", "extra")


def _edits(cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order (id, text, extra) -> the fingerprints and likenesses of all but the extra ones."""

    def some(ids: pa.Array, texts: pa.Array, extra: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All rows but the last, which is only there as the next one."""
        for c in chunks(texts.slice(0, len(texts) - 1), rows=ps.MOST_CELLS // cells):
            mine = np.flatnonzero(~extra[c.first : c.last])
            if not len(mine):
                continue
            plain = texts.slice(c.first, c.last - c.first + 1).to_pylist()
            edited, n_chars = [], []
            for i in mine:
                t = plain[i]
                half = len(t) // 2
                n_chars.append(len(t))
                edited.append(t[: len(t) - half] + plain[i + 1][:half])
            here = _digests(texts.slice(c.first, c.last - c.first + 1))
            own, then = here.take(mine), here.take(mine + 1)
            changed = _digests(pa.array(edited, pa.large_string()))
            to_edited, to_next = ps.differences(own, changed, cells), ps.differences(own, then, cells)
            a, b, d = (np.diff(v.offs) for v in (own, changed, then))
            apart = [np.bincount(v.row, minlength=len(mine)) for v in (to_edited, to_next)]
            mark, changed_mark = ps.tables(own, cells), ps.tables(changed, cells)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(mine + c.first)), pa.array(n_chars, pa.int64()), pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                    pa.array([mark.text(i) for i in range(len(mine))]), pa.array([changed_mark.text(i) for i in range(len(mine))]),
                    pa.array(ps.likeness(a, b, apart[0])), pa.array(ps.likeness(a, d, apart[1])),
                    pa.array(a, pa.int64()), pa.array(apart[0], pa.int64()), pa.array(to_edited.cells), pa.array(to_next.cells),
                ],
                names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_paragraphs", "edited_apart", "edited_cells", "next_cells"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, whose next one is still to come
        for b in batches:
            rows = pa.Table.from_batches([b] if held is None else [held, b]).combine_chunks()
            if not rows.num_rows:
                continue
            ids, texts, extra = (rows.column(i).combine_chunks() for i in range(3))
            yield from some(ids, _texts(texts), extra.to_numpy(zero_copy_only=False).astype(bool))
            last = rows.slice(rows.num_rows - 1)
            held = last.take(pa.array([0])).combine_chunks().to_batches()[0]  # a copy, so that the batch can go

    return run


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = ps.CELLS) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, ...), one row per document.

    The edited text is the document's with its last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document, by ascending id; after the last comes the first, so a sole document is its own
    next. ``near_*``: shared paragraphs over all, from what the subtracted tables give up: 1 for equal texts, two empty ones included. A null text counts
    as empty. Rows that repeat an id follow each other by a hash of their texts, and those without an id come
    first, in one range. An empty table gives an empty result; further columns are ignored.
    ``n_paragraphs``: digests of the document; ``edited_apart``: those in which it and the edited text differ; ``*_cells``: the size of table they came out of.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    out = f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_paragraphs long, edited_apart long, edited_cells long, next_cells long"
    ordered = in_order(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    return docs.sparkSession.createDataFrame([], out) if ordered is None else ordered.mapInArrow(_edits(cells), out)
