"""Substring dedup: De Bruijn compaction of repeated token k-mers.

Edges of the graph are windows of ``k`` consecutive words (a k-mer joins its
first k - 1 words to its last k - 1). The job:

1. *Edges.* Each task hashes the windows of groups of whole documents. Of
   windows equal within a group, all but the first by (doc_id, start) are
   repeats already and name that first one as their source; only first ones
   travel, packed into one binary row per (group, hash bucket). So a passage
   that a third of all documents hold costs one record per group of documents,
   and no task ever gathers the documents of one key.
2. *Sources.* Each bucket of hashes finds, for every repeated edge, the
   smallest (doc_id, start) and answers the groups of all others with it.
3. *Compaction.* Consecutive repeated edges of a document whose sources are
   consecutive too form a nonbranching path; each is kept as one row
   (doc, start, edges, source doc, source start). Where the graph branches, the
   source jumps and a new path begins.
4. *Verification.* Distinct source spans are joined to the documents, hashed
   there with an independent function, and joined back to the paths. A path
   whose words at its own coordinates don't have the same hash is not removed.

A word is removed if a verified path covers it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from . import _scan
from ._scan import U64
from ._spark import cut, partitions, release

K = 20
GROUP_BYTES = 4 << 20
#: Text whose edges one bucket resolves at once.
BUCKET_BYTES = 1 << 19
_EDGES = "bucket int, grp long, n int, hist binary, low binary, doc binary, pos binary, sdoc binary, spos binary"
_PATHS = "doc long, start int, edges int, src long, src_start int"
_NO_ID = np.int64(2**63 - 1)


def _pack(values: np.ndarray) -> bytes:
    """Unsigned offsets from the least value, in as few bytes as they need: width, least, offsets."""
    low = int(values.min()) if len(values) else 0
    rest = (values.astype(np.int64) - low).view(U64)
    width = next(w for w in (1, 2, 4, 8) if not len(rest) or int(rest.max()) < 1 << (8 * w))
    return bytes([width]) + low.to_bytes(8, "little", signed=True) + rest.astype(f"u{width}").tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (np.frombuffer(raw, f"u{raw[0]}", offset=9).astype(U64) + U64(int.from_bytes(raw[1:9], "little"))).view(np.int64)


def _firsts(h: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (h, doc, pos), and for each in that order the place of its hash's first."""
    order = np.argsort(h, kind="stable")
    hs = h[order]
    new = np.ones(len(h), bool)
    new[1:] = hs[1:] != hs[:-1]
    run = np.cumsum(new) - 1
    many = np.flatnonzero((np.diff(np.append(np.flatnonzero(new), len(h))) > 1)[run])
    if len(many):  # the usual rows come in order already
        o = order[many]
        order[many] = o[np.lexsort((pos[o], doc[o], run[many]))]
    return order, np.flatnonzero(new)[run]


class _Group:
    """The windows of some whole documents."""

    def __init__(self, bits: int):
        self.bits, self.bytes, self.parts, self.ids = bits, 0, [], []

    def add(self, chunk: _scan.Chunk, ids: np.ndarray, k: int) -> None:
        w = _scan.words(chunk)
        g, whole = _scan.gram_hashes(_scan.word_hashes(chunk, w), w.offs, k)
        at = np.flatnonzero(whole)
        doc = np.repeat(np.arange(len(ids)), w.counts)[at]
        self.parts.append((g[at], ids[doc], at - w.offs[doc]))
        self.bytes += len(chunk.data)
        self.ids.append(ids)

    def rows(self) -> Iterator[tuple]:
        h, doc, pos = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        ids = np.concatenate(self.ids)
        self.parts, self.ids, self.bytes = [], [], 0
        if not len(h):
            return
        grp = int(_scan.signed(_scan.mix(np.array([ids.min(), ids.max(), len(ids)]).view(U64))).sum())
        order, first = _firsts(h, doc, pos)
        h, doc, pos = h[order], doc[order], pos[order]
        again = (doc != doc[first]) | (pos != pos[first])
        if again.any():
            f = first[again]
            yield grp & ((1 << self.bits) - 1), grp, 0, b"", b"", _pack(doc[again]), _pack(pos[again]), _pack(doc[f]), _pack(pos[f])
        one = first == np.arange(len(h))
        h, doc, pos = h[one], doc[one], pos[one]
        ends = np.searchsorted(h >> U64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=U64)) if self.bits else np.array([0, len(h)])
        low = h.view("u2").reshape(-1, 4)[:, :3]
        top = (h >> U64(48)).astype(np.int64) & ((1 << (16 - self.bits)) - 1)
        for b in np.flatnonzero(np.diff(ends)).tolist():
            s = slice(ends[b], ends[b + 1])
            hist = _pack(np.bincount(top[s], minlength=1 << (16 - self.bits)))
            yield b, grp, int(s.stop - s.start), hist, np.ascontiguousarray(low[s].T).tobytes(), _pack(doc[s]), _pack(pos[s]), b"", b""


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


_BIN = pa.binary()
_EDGE_ARROW = pa.schema([("bucket", pa.int32()), ("grp", pa.int64()), ("n", pa.int32()), ("hist", _BIN), ("low", _BIN), ("doc", _BIN), ("pos", _BIN), ("sdoc", _BIN), ("spos", _BIN)])
_ANSWER_ARROW = pa.schema([("grp", pa.int64()), ("doc", _BIN), ("pos", _BIN), ("sdoc", _BIN), ("spos", _BIN)])
_PATH_ARROW = pa.schema([("doc", pa.int64()), ("start", pa.int32()), ("edges", pa.int32()), ("src", pa.int64()), ("src_start", pa.int32())])


def _ids(column: pa.Array) -> np.ndarray:
    return np.asarray(column.fill_null(int(_NO_ID)), dtype=np.int64)


def _scan_edges(bits: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            group = _Group(bits)
            for batch in batches:
                ids = _ids(batch.column(0))
                for c in _scan.chunks(batch.column(1), _scan.CHUNK_BYTES // 2):
                    group.add(c, ids[c.first : c.last], k)
                    if group.bytes >= GROUP_BYTES:
                        yield from group.rows()
            if group.parts:
                yield from group.rows()

        yield from _batches(rows(), _EDGE_ARROW)

    return run


def _resolve(bits: int):
    """Sources of the repeated edges of one bucket, answered to the groups that sent them."""

    def run(table: pa.Table) -> pa.Table:
        sent = [r for r in table.to_pylist() if r["n"]]
        out = [(r["grp"], r["doc"], r["pos"], r["sdoc"], r["spos"]) for r in table.select(["n", "grp", "doc", "pos", "sdoc", "spos"]).to_pylist() if not r["n"]]
        if sent:
            hs = []
            for r in sent:
                low = np.frombuffer(r["low"], "u2").reshape(3, -1).astype(U64)
                top = np.repeat(np.arange(1 << (16 - bits), dtype=U64), _unpack(r["hist"]))
                hs.append(low[0] | low[1] << U64(16) | low[2] << U64(32) | top << U64(48))
            h, doc, pos = np.concatenate(hs), np.concatenate([_unpack(r["doc"]) for r in sent]), np.concatenate([_unpack(r["pos"]) for r in sent])
            who = np.repeat(np.arange(len(sent)), [r["n"] for r in sent])
            order, first = _firsts(h, doc, pos)
            again = np.flatnonzero((doc[order] != doc[order][first]) | (pos[order] != pos[order][first]))
            src, own = order[first[again]], order[again]
            own_by = np.argsort(who[own], kind="stable")
            own, src = own[own_by], src[own_by]
            ends = np.searchsorted(who[own], np.arange(len(sent) + 1))
            for i in np.flatnonzero(np.diff(ends)).tolist():
                s = slice(ends[i], ends[i + 1])
                out.append((sent[i]["grp"], _pack(doc[own[s]]), _pack(pos[own[s]]), _pack(doc[src[s]]), _pack(pos[src[s]])))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, _ANSWER_ARROW.types, strict=True)], schema=_ANSWER_ARROW)

    return run


def _compact(table: pa.Table) -> pa.Table:
    """The answers to one group of documents, joined to nonbranching paths."""
    doc, pos, src, spos = (np.concatenate([_unpack(x) for x in table[c].to_pylist()]) for c in ("doc", "pos", "sdoc", "spos"))
    order = np.lexsort((spos, src, pos, doc))
    doc, pos, src, spos = doc[order], pos[order], src[order], spos[order]
    once = np.ones(len(doc), bool)
    once[1:] = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])
    doc, pos, src, spos = doc[once], pos[once], src[once], spos[once]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1) | (src[1:] != src[:-1]) | (spos[1:] != spos[:-1] + 1)
    at = np.flatnonzero(new)
    return pa.Table.from_arrays(
        [pa.array(x, t) for x, t in zip((doc[at], pos[at], np.diff(np.append(at, len(doc))), src[at], spos[at]), _PATH_ARROW.types, strict=True)], schema=_PATH_ARROW
    )


def paths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(doc, start, edges, src, src_start): each repeated nonbranching path outside its source, unverified."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    # buckets follow the input: twice as many for twice the text, and enough to go round the partitions
    bits = min(16, max((total // BUCKET_BYTES).bit_length(), (4 * partitions(docs.sparkSession)).bit_length()))
    edges = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_scan_edges(bits, k), _EDGES)
    answers = edges.groupBy("bucket").applyInArrow(_resolve(bits), "grp long, doc binary, pos binary, sdoc binary, spos binary")
    return cut(answers.groupBy("grp").applyInArrow(_compact, _PATHS), free=True)


def _span_words(spans: pa.Array, w: _scan.Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat index, first word, end word) of those spans of a list column that lie inside their documents."""
    flat = spans.flatten()
    row = np.repeat(np.arange(len(spans)), np.asarray(spans.value_lengths().fill_null(0)))
    start, edges = (np.asarray(flat.field(i), dtype=np.int64) for i in (0, 1))
    ok = np.flatnonzero((start >= 0) & (edges > 0) & (start + edges + k - 1 <= w.counts[row]))
    first = w.offs[row[ok]] + start[ok]
    return ok, first, first + edges[ok] + k - 1


def _span_hashes(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _scan.chunks(batch.column(1)):
                w = _scan.words(c)
                spans = batch.column(2)[c.first : c.last]
                ok, s, e = _span_words(spans, w, k)
                check = _scan.span_hash(_scan.word_hashes(c, w, _scan.BYTE_BASES[1]), s, e, _scan.WORD_BASES[1])
                src = np.repeat(_ids(batch.column(0))[c.first : c.last], np.asarray(spans.value_lengths().fill_null(0)))[ok]
                flat = spans.flatten()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(src), flat.field(0).take(pa.array(ok)), flat.field(1).take(pa.array(ok)), pa.array(_scan.signed(check))], names=["src", "src_start", "edges", "check"]
                )

    return run


def _covered(c: _scan.Chunk, w: _scan.Words, spans: pa.Array, k: int) -> np.ndarray:
    """Which words verified paths cover."""
    ok, s, e = _span_words(spans, w, k)
    mark = np.zeros(len(w.starts) + 1, np.int64)
    if len(ok):
        own = _scan.signed(_scan.span_hash(_scan.word_hashes(c, w, _scan.BYTE_BASES[1]), s, e, _scan.WORD_BASES[1]))
        good = own == np.asarray(spans.flatten().field(2), dtype=np.int64)[ok]
        np.add.at(mark, s[good], 1)
        np.add.at(mark, e[good], -1)
    return np.cumsum(mark[:-1]) > 0


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """data[start:start + length] of each span, end to end."""
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
    return data[at]


def _digests(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _scan.chunks(batch.column(1)):
                w = _scan.words(c)
                gone = _covered(c, w, batch.column(2)[c.first : c.last], k)
                stay = np.flatnonzero(~gone)
                size = w.ends[stay] - w.starts[stay] + 1  # with the byte after each word, made a space
                data = np.append(c.data, np.uint8(32))
                joined = gather(data, w.starts[stay], size)
                after = np.cumsum(size)
                joined[after - 1] = 32
                upto = np.append(0, after)[np.searchsorted(stay, w.offs)]
                raw = memoryview(joined)
                shas = [hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
                removed = np.diff(np.append(0, np.cumsum(gone))[w.offs])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[c.first : c.last], pa.array(w.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                    names=["id", "n_words", "n_removed", "kept_sha256"],
                )

    return run


def _texts(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _scan.chunks(batch.column(1)):
                w = _scan.words(c)
                gone = _covered(c, w, batch.column(2)[c.first : c.last], k)
                doc = np.repeat(np.arange(len(w.counts)), w.counts)[gone]
                until = np.append(w.starts, len(c.data))[np.flatnonzero(gone) + 1]  # up to the next word, or the document's end
                mark = np.zeros(len(c.data) + 1, np.int64)
                np.add.at(mark, w.starts[gone], 1)
                np.add.at(mark, np.minimum(until, c.offs[doc + 1]), -1)
                stay = np.cumsum(mark[:-1]) == 0
                offs = np.append(0, np.cumsum(stay))[c.offs]
                text = pa.LargeStringArray.from_buffers(len(w.counts), pa.py_buffer(offs.astype(np.int64).tobytes()), pa.py_buffer(c.data[stay].tobytes())).cast(pa.string())
                more = [column[c.first : c.last] for column in batch.columns[3:]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[c.first : c.last], text, *more], names=["id", "kept_text", *(["carried"] if more else [])])

    return run


def _with_spans(docs: DataFrame, id_col: str, text_col: str, k: int, carry: Sequence[str] = ()) -> DataFrame:
    """(id, text, spans): documents with the verified paths that cover them; ``carry``: columns that come along as ``carried``."""
    path = paths(docs, id_col, text_col, k)
    release(docs.sparkSession)  # the edges' shuffle files go before the texts are shuffled
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(_NO_ID))).alias("id"), F.col(text_col).alias("text"))
    wanted = path.select("src", "src_start", "edges").distinct().groupBy("src").agg(F.collect_list(F.struct("src_start", "edges")).alias("spans"))
    checks = texts.join(wanted, F.col("id") == F.col("src")).select("id", "text", "spans").mapInArrow(_span_hashes(k), "src long, src_start int, edges int, check long")
    spans = path.join(checks.distinct(), ["src", "src_start", "edges"]).groupBy("doc").agg(F.collect_list(F.struct("start", "edges", "check")).alias("spans"))
    if carry:
        texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(_NO_ID))).alias("id"), F.col(text_col).alias("text"), F.struct(*carry).alias("carried"))
    return texts.join(spans, F.col("id") == F.col("doc"), "left").select("id", "text", "spans", *(["carried"] if carry else []))


def _null_back(column: str):
    return F.when(F.col(column) != F.lit(int(_NO_ID)), F.col(column)).alias(column)


def removed_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256), one row per input row.

    Words are maximal runs of bytes other than space and U+0009 to U+000D,
    unchanged. Each word covered by a window of ``k`` words that also starts
    earlier (smaller id, or same document and earlier start) is removed;
    windows are judged on the input. Null text has no words, and its kept text
    is empty; texts of fewer than ``k`` words lose nothing. Rows that repeat
    an id are one document: they don't remove each other's words if their texts
    are equal, and where their texts differ only what verifies is removed. A
    null id comes after all others. An empty table gives an empty result;
    further columns are ignored.
    """
    out = _with_spans(docs, id_col, text_col, k).mapInArrow(_digests(k), "id long, n_words long, n_removed long, kept_sha256 string")
    return out.withColumn("id", _null_back("id"))


def remaining_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, carry: Sequence[str] = ()) -> DataFrame:
    """(id, kept_text, carried), one row per input row: each text without its removed words and the white space after them, else unchanged.

    ``carry``: columns of the row that come along in the struct ``carried``, which is absent without any.
    """
    kind = StructType().add("id", LongType()).add("kept_text", StringType())
    if carry:
        kind.add(docs.select(F.struct(*carry).alias("carried")).schema["carried"])
    return _with_spans(docs, id_col, text_col, k, carry).mapInArrow(_texts(k), kind).withColumn("id", _null_back("id"))
