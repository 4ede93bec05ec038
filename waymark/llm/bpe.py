"""Byte-level BPE: a minimal acyclic transducer for frequent words, exact merging for the rest.

The frequent words of the corpus are counted over all documents and compiled on the driver
into a minimal deterministic automaton (common prefixes and common suffixes are
shared). Each arc carries the number of words that sort before its own, so the
sum along a path is the word's index, which leads to its ids. Automaton, id
lists, merge table and token bytes lie in one file that Spark ships to the
executors and their workers map into memory.

Workers cut whole chunks of text into words and walk the automaton for all words
of a chunk at once, byte by byte. Words that it doesn't know are merged exactly:
all of one length together, the lowest-ranked leftmost pair of each per step.
Documents that hold a special token's text or a code point that this
Python's Unicode tables don't know are encoded by the tokenizers library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _scan
from ._scan import U64
from ._spark import cut
from .substring_dedup import gather

LEXICON_WORDS = 1 << 16
LONGEST = 64
NEVER = np.int32(2**31 - 1)
# classes of characters
OTHER, LETTER, NUMBER, BLANK, SPACE, UNKNOWN = range(6)
#: The white space characters of Unicode, beside the plain blank.
SPACES = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


# --- words -------------------------------------------------------------------


@lru_cache(maxsize=2)
def _classes(size: int) -> np.ndarray:
    """The class of each code point below ``size``."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([UNKNOWN if (c := unicodedata.category(chr(i))) == "Cn" else kinds.get(c[0], OTHER) for i in range(size)], np.uint8)
    spaces = np.array(SPACES)
    out[spaces[spaces < size]] = SPACE
    out[0x20] = BLANK
    return out


def _char_classes(data: np.ndarray) -> np.ndarray:
    """Per byte, the class of its character."""
    out = np.append(_classes(0x800)[:128], np.zeros(128, np.uint8))[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
        size = 2 + (data[lead] >= 0xE0).astype(int) + (data[lead] >= 0xF0)
        x = [b[lead + i] & 0x3F for i in (1, 2, 3)]
        head = b[lead]
        point = np.select([size == 2, size == 3], [(head & 0x1F) << 6 | x[0], (head & 0x0F) << 12 | x[0] << 6 | x[1]], (head & 0x07) << 18 | x[0] << 12 | x[1] << 6 | x[2])
        kind = _classes(0x800 if point.max() < 0x800 else 0x110000)[np.minimum(point, 0x10FFFF)]
        for i in range(4):
            out[lead[size > i] + i] = kind[size > i]
    return out


def pretokens(c: _scan.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, each document's first token, n + 1 of them; whether a document holds unknown code points).

    Runs of letters, numbers or other characters, each with the blank before
    it; the contractions 's 't 're 've 'm 'll 'd; and white space, of which
    the last character before a word is a token of its own unless it is that blank.
    """
    data, n = c.data, len(c.data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(c.offs), np.int64), np.zeros(len(c.offs) - 1, bool)
    kind = _char_classes(data)
    odd = np.zeros(len(c.offs) - 1, bool)
    if (strange := kind == UNKNOWN).any():
        odd[np.searchsorted(c.offs, np.flatnonzero(strange), "right") - 1] = True
    group = np.where(kind == BLANK, np.uint8(SPACE), kind)
    edge = np.zeros(n, bool)
    edge[c.offs[c.offs < n]] = True
    new = edge.copy()
    new[1:] |= group[1:] != group[:-1]
    rs = np.flatnonzero(new)
    re_ = np.append(rs[1:], n)
    g = group[rs]
    white = g == SPACE
    ends_doc = np.append(edge, True)[re_]  # the run ends its document
    # the blank before a word
    has_blank = np.zeros(len(rs), bool)
    has_blank[1:] = ~white[1:] & ~edge[rs[1:]] & (kind[rs[1:] - 1] == BLANK)
    start = np.zeros(n + 1, bool)
    start[np.where(has_blank, rs - 1, rs)[~white]] = True
    # white space: one token up to its last character, which stands alone if it isn't a blank
    mid = white & ~ends_doc
    last = re_ - 1
    while True:  # back to the character's first byte
        back = mid & ((data[last] & 0xC0) == 0x80)
        if not back.any():
            break
        last = last - back
    start[rs[white & ends_doc]] = True
    start[rs[mid & (last > rs)]] = True
    start[last[mid & (kind[last] != BLANK)]] = True
    # contractions
    quote = np.flatnonzero((data[rs] == 0x27) & (re_ - rs == 1) & ~has_blank & ~ends_doc & (np.append(g[1:], 0) == LETTER))
    if len(quote):
        p, end = rs[quote], re_[quote + 1]
        b = np.append(data, np.zeros(2, np.uint8))
        one, two = b[p + 1], b[p + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        pairs = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        long = ~short & pairs & (end - p >= 3)
        for which, size in ((short, 2), (long, 3)):
            start[p[which] + 1] = False
            more = which & (p + size < end)
            start[p[more] + size] = True
    starts = np.flatnonzero(start[:n])
    return starts, np.searchsorted(starts, c.offs), odd


# --- the vocabulary and its merges ---------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in character of each byte: itself, or the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _slots(key: np.ndarray, bits: int) -> np.ndarray:
    return (key * U64(0x9E3779B97F4A7C15)) >> U64(64 - bits)


def merge_tables(model: dict) -> dict[str, np.ndarray]:
    """Arrays of a tokenizer file: bytes of the tokens, the ids of single bytes, and a hash table of the merges."""
    letters = byte_alphabet()
    vocab = dict(model["model"]["vocab"])
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    size = max([*vocab.values(), *special.values()]) + 1
    tokens: list[bytes] = [b""] * size
    for t, i in vocab.items():
        tokens[i] = bytes(letters[ch] for ch in t)
    for t, i in special.items():
        tokens[i] = t.encode()
    single = np.zeros(256, np.int32)
    for ch, b in letters.items():
        single[b] = vocab[ch]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
    key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], U64)
    made = np.array([vocab[a + b] for a, b in pairs], np.int32)
    bits = max(8, (8 * len(pairs)).bit_length())
    keys, rank = np.full(1 << bits, _scan.NO_HASH), np.full(1 << bits, NEVER)
    slot, todo = _slots(key, bits).astype(np.int64), np.arange(len(key))
    while len(todo):  # those that find their slot empty take it, one for each slot
        s = slot[todo]
        free = keys[s] == _scan.NO_HASH
        _, first = np.unique(s[free], return_index=True)
        win = todo[free][first]
        keys[slot[win]], rank[slot[win]] = key[win], win
        todo = np.setdiff1d(todo, win)
        slot[todo] = (slot[todo] + 1) & ((1 << bits) - 1)
    lengths = np.array([len(t) for t in tokens], np.int64)
    return {
        "token_bytes": np.frombuffer(b"".join(tokens), np.uint8), "token_offs": np.append(0, np.cumsum(lengths)), "single": single,
        "pair_key": keys, "pair_rank": rank, "made": made, "special": np.frombuffer("\0".join(special).encode(), np.uint8),
    }


def pair_ranks(t: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The rank of merging a and b, or NEVER."""
    key = a.astype(U64) << U64(32) | b.astype(U64)
    keys, rank = t["pair_key"], t["pair_rank"]
    bits = len(keys).bit_length() - 1
    slot = _slots(key, bits).astype(np.int64)
    found = keys[slot]
    out = np.where(found == key, rank[slot], NEVER)
    open_ = np.flatnonzero((found != key) & (found != _scan.NO_HASH))
    while len(open_):
        slot[open_] = (slot[open_] + 1) & (len(keys) - 1)
        found = keys[slot[open_]]
        hit = found == key[open_]
        out[open_[hit]] = rank[slot[open_[hit]]]
        open_ = open_[~hit & (found != _scan.NO_HASH)]
    return out


def merge_words(t: dict[str, np.ndarray], data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids end to end, number of ids) of the given words, by exact merging."""
    count = np.zeros(len(starts), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    low = 0
    for top in (2, 4, 6, 8, 10, 12, 16, 20, 24, 32, 48, LONGEST):
        rows = np.flatnonzero((sizes > low) & (sizes <= top))
        low = top
        if not len(rows):
            continue
        at = np.minimum(starts[rows, None] + np.arange(top), len(data) - 1)
        sym = np.where(np.arange(top) < sizes[rows, None], t["single"][data[at]], -1)
        pr = np.full((len(rows), top - 1), NEVER)
        i, j = np.nonzero(sym[:, 1:] >= 0)
        pr[i, j] = pair_ranks(t, sym[i, j], sym[i, j + 1])
        while True:
            p = pr.argmin(1) if pr.shape[1] else np.zeros(len(rows), np.int64)
            best = pr[np.arange(len(rows)), p] if pr.shape[1] else np.full(len(rows), NEVER)
            live = best < NEVER
            if not live.all():
                n = (sym[~live] >= 0).sum(1)
                count[rows[~live]] = n
                parts.append((np.repeat(rows[~live], n), sym[~live][sym[~live] >= 0]))
                rows, sym, pr, p, best = rows[live], sym[live], pr[live], p[live], best[live]
            if not len(rows):
                break
            me = np.arange(len(rows))
            sym[me, p] = t["made"][best]
            cols = np.arange(sym.shape[1] - 1)
            sym = np.take_along_axis(sym, cols + (cols > p[:, None]), 1)
            cols = cols[:-1]
            pr = np.take_along_axis(pr, cols + (cols >= p[:, None]), 1)
            for shift in (-1, 0):  # the pairs beside the new symbol
                q = p + shift
                ok = np.flatnonzero((q >= 0) & (q < pr.shape[1]))
                ok = ok[sym[ok, q[ok] + 1] >= 0]
                pr[ok, q[ok]] = pair_ranks(t, sym[ok, q[ok]], sym[ok, q[ok] + 1])
    for r in np.flatnonzero(sizes > LONGEST).tolist():
        ids = _merge_long(t, data[starts[r] : starts[r] + sizes[r]])
        count[r] = len(ids)
        parts.append((np.full(len(ids), r), ids))
    if not parts:
        return np.zeros(0, np.int32), count
    who = np.concatenate([a for a, _ in parts])
    return np.concatenate([b for _, b in parts])[np.argsort(who, kind="stable")].astype(np.int32), count


def _merge_long(t: dict[str, np.ndarray], word: np.ndarray) -> np.ndarray:
    """Merging of one long word with a heap of pairs."""
    sym = t["single"][word].tolist()
    n = len(sym)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    first = pair_ranks(t, np.array(sym[:-1]), np.array(sym[1:])).tolist()
    heap = [(r, i, sym[i], sym[i + 1]) for i, r in enumerate(first) if r < NEVER]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        if i >= 0 and (j := after[i]) >= 0 and (r := int(pair_ranks(t, np.array([sym[i]]), np.array([sym[j]]))[0])) < NEVER:
            heapq.heappush(heap, (r, i, sym[i], sym[j]))

    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i]
        if sym[i] != a or j < 0 or sym[j] != b:
            continue
        sym[i], sym[j], after[i] = int(t["made"][r]), -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return np.array([s for s in sym if s >= 0], np.int32)


# --- the transducer -------------------------------------------------------------


def compile_lexicon(words: Iterable[bytes]) -> dict[str, np.ndarray]:
    """A minimal acyclic automaton of the sorted words, in displaced rows.

    ``base[state] + byte`` is an arc's slot; ``owner`` tells whose arc it is,
    ``target`` where it leads, ``before`` how many words its choice passes over.
    """
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path, last = [0], b""

    def close(depth: int) -> None:
        """Replace the states of the last word below ``depth`` by equal registered ones."""
        while len(path) - 1 > depth:
            s = path.pop()
            key = (final[s], tuple(sorted(arcs[s].items())))
            arcs[path[-1]][last[len(path) - 1]] = register.setdefault(key, s)

    for w in sorted(set(words)):
        common = len(os.path.commonprefix([w, last]))
        close(common)
        for b in w[common:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][b] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        last = w
    close(0)
    live, seen = [0], {0: 0}
    for s in live:
        for target in arcs[s].values():
            if target not in seen:
                seen[target] = len(live)
                live.append(target)
    total: dict[int, int] = {}

    def words_from(s: int) -> int:
        stack = [s]
        while stack:
            x = stack[-1]
            if missing := [y for y in arcs[x].values() if y not in total]:
                stack += missing
            else:
                total[x] = final[x] + sum(total[y] for y in arcs[x].values())
                stack.pop()
        return total[s]

    words_from(0)
    room = 512 + 256 + 4 * sum(len(arcs[s]) for s in live)
    owner, target, before = np.full(room, -1, np.int32), np.zeros(room, np.int32), np.zeros(room, np.int32)
    base, free = np.zeros(len(live), np.int32), np.ones(room + 256, bool)
    for s in sorted(live, key=lambda s: -len(arcs[s])):
        if not arcs[s]:
            continue
        labels = sorted(arcs[s])
        fits = free[labels[0] : labels[0] + room].copy()
        for b in labels[1:]:
            fits &= free[b : b + room]
        at = int(fits.argmax())
        base[seen[s]] = at
        passed = int(final[s])
        for b in labels:
            free[at + b] = False
            owner[at + b], target[at + b], before[at + b] = seen[s], seen[arcs[s][b]], passed
            passed += total[arcs[s][b]]
    used = int(np.flatnonzero(owner >= 0).max(initial=0)) + 257
    return {"base": base, "owner": owner[:used], "target": target[:used], "before": before[:used], "final": np.array([final[s] for s in live])}


def walk(t: dict[str, np.ndarray], data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The index of each word in the sorted lexicon, or -1; all words advance together."""
    out = np.full(len(starts), -1, np.int64)
    me = np.arange(len(starts))
    pos, state, index = starts, np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int32)
    base, owner, target, before, final = (t[k] for k in ("base", "owner", "target", "before", "final"))
    while len(me):
        slot = base[state] + data[pos]
        slot = np.minimum(slot, len(owner) - 1)
        ok = owner[slot] == state
        me, pos, slot, index = me[ok], pos[ok] + 1, slot[ok], index[ok]
        index = index + before[slot]
        state = target[slot]
        over = pos == ends[me]
        done = over & final[state]
        out[me[done]] = index[done]
        go = ~over
        me, pos, state, index = me[go], pos[go], state[go], index[go]
    return out


# --- encoding ---------------------------------------------------------------------


def save(arrays: dict[str, np.ndarray]) -> str:
    """One file of all arrays behind a header, to be mapped into memory."""
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = [str(a.dtype), at, len(a)]
        at += -(-a.nbytes // 8) * 8
    raw = json.dumps(head).encode()
    raw += b" " * (-len(raw) % 8)
    path = os.path.join(tempfile.mkdtemp(prefix="waymark-"), f"bpe-{uuid.uuid4().hex}.bin")
    with open(path, "wb") as f:
        f.write(len(raw).to_bytes(8, "little") + raw)
        for a in arrays.values():
            f.write(np.ascontiguousarray(a).tobytes() + b"\0" * (-a.nbytes % 8))
    return path


@lru_cache(maxsize=4)
def load(path: str) -> dict[str, np.ndarray]:
    raw = np.memmap(path, np.uint8, "r")
    size = int.from_bytes(raw[:8].tobytes(), "little")
    head = json.loads(raw[8 : 8 + size].tobytes())
    return {k: raw[8 + size + at : 8 + size + at + n * np.dtype(kind).itemsize].view(kind) for k, (kind, at, n) in head.items()}


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(load(path)["json"].tobytes().decode())


def build(tokenizer: str, words: Iterable[bytes]) -> str:
    """Compile a tokenizer file and the words of the lexicon to one file; its path."""
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    t = merge_tables(json.loads(text))
    ordered = sorted({w for w in words if 0 < len(w) <= LONGEST})
    size = np.array([len(w) for w in ordered], np.int64)
    flat = np.frombuffer(b"".join(ordered), np.uint8) if ordered else np.zeros(1, np.uint8)
    ids, count = merge_words(t, flat, np.cumsum(size) - size, size)
    return save(t | compile_lexicon(ordered) | {"word_ids": ids, "word_offs": np.append(0, np.cumsum(count)), "json": np.frombuffer(text.encode(), np.uint8)})


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one of each distinct word, the place of each word's own among them), checked byte by byte."""
    h = _scan.span_hash(data.astype(U64) + U64(1), starts, ends, _scan.BYTE_BASES[0])
    _, rep, own = np.unique(h, return_index=True, return_inverse=True)
    size = ends - starts
    if (size == size[rep][own]).all() and (gather(data, starts, size) == gather(data, starts[rep][own], size)).all():
        return rep, own
    return np.arange(len(starts)), np.arange(len(starts))


def encode(path: str, c: _scan.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(ids end to end, n + 1 offsets) of the chunk's documents."""
    t = load(path)
    starts, first, odd = pretokens(c)
    ends = np.append(starts[1:], len(c.data))
    known = walk(t, c.data, starts, ends)
    miss = np.flatnonzero(known < 0)
    rep, own = distinct_words(c.data, starts[miss], ends[miss])
    made, count = merge_words(t, c.data, starts[miss[rep]], (ends - starts)[miss[rep]])
    offs = t["word_offs"]
    begin, size = offs[known], offs[known + 1] - offs[known]
    begin[miss], size[miss] = (len(t["word_ids"]) + np.cumsum(count) - count)[own], count[own]
    ids = gather(np.append(t["word_ids"], made), begin, size)
    upto = np.append(0, np.cumsum(size))[first]
    if len(raw := t["special"]):
        text = c.data.tobytes()
        for s in raw.tobytes().split(b"\0"):
            at = text.find(s)
            while at >= 0:
                odd[np.searchsorted(c.offs, at, "right") - 1] = True
                at = text.find(s, at + 1)
    if odd.any():
        parts = [np.array(_library(path).encode(c.doc(i).decode(), add_special_tokens=False).ids, np.int32) if odd[i] else ids[upto[i] : upto[i + 1]] for i in range(len(odd))]
        ids, upto = np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))
    return ids, upto


def decode(t: dict[str, np.ndarray], ids: np.ndarray, offs: np.ndarray) -> list[bytes]:
    """Each document's text in UTF-8; what isn't UTF-8 becomes U+FFFD."""
    size = np.diff(t["token_offs"])[ids]
    raw = gather(t["token_bytes"], t["token_offs"][ids], size).tobytes()
    at = np.append(0, np.cumsum(size))[offs].tolist()
    out = [raw[a:b] for a, b in zip(at, at[1:])]
    try:
        raw.decode()
        whole = True
    except UnicodeDecodeError:
        whole = False
    return out if whole and not any(x and x[0] & 0xC0 == 0x80 for x in out) else [x.decode("utf-8", "replace").encode() for x in out]


def _count_words(most: int, longest: int = 32, flush: int = 4 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for c in _scan.chunks(batch.column(0), flush):
                starts, _, _ = pretokens(c)
                ends = np.append(starts[1:], len(c.data))
                ok = ends - starts <= longest
                starts, ends = starts[ok], ends[ok]
                if not len(starts):
                    continue
                _, at, n = np.unique(_scan.span_hash(c.data.astype(U64) + U64(1), starts, ends, _scan.BYTE_BASES[0]), return_index=True, return_counts=True)
                at, n = at[n > 1], n[n > 1]
                raw = c.data.tobytes()
                for s, e, k in zip(starts[at].tolist(), ends[at].tolist(), n.tolist()):
                    total[raw[s:e]] += k
                if len(total) > 4 * most:
                    total = Counter(dict(total.most_common(most)))
        top = total.most_common(most)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], names=["word", "n"])

    return run


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = LEXICON_WORDS) -> list[bytes]:
    """At most the ``most`` most frequent words of all documents, counted in every text.

    A task counts words that occur twice in about 4 MB of text and sends its
    own ``most`` top ones, so counts of rarer words may fall short; they only
    decide which words the automaton holds, never an id.
    """
    counts = cut(docs.select(text_col).mapInArrow(_count_words(most), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    # the least count that no more than ``most`` words reach, from a histogram in sixteenths of a doubling
    step = F.floor(F.log2("n") * 16).cast("int")
    total, least = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        total += r["count"]
        if total > most:
            break
        least = r["step"]
    if least is None:
        return []
    return [bytes(r["word"]) for r in counts.where(step >= least).select("word").collect()]


def shipped(spark: SparkSession, path: str) -> str:
    """Send a compiled file to all executors; the name it has there."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def _encode_decode(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = SparkFiles.get(name)
        for batch in batches:
            for c in _scan.chunks(batch.column(1)):
                ids, offs = encode(path, c)
                raw = memoryview(ids.astype("<u4"))
                at = offs.tolist()
                shas = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at, at[1:])]
                back = [hashlib.sha256(x).hexdigest() for x in decode(load(path), ids, offs)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[c.first : c.last], pa.array(np.diff(offs), pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def _encode_ids(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = SparkFiles.get(name)
        for batch in batches:
            for c in _scan.chunks(batch.column(1)):
                ids, offs = encode(path, c)
                yield pa.RecordBatch.from_arrays([batch.column(0)[c.first : c.last], pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids, pa.int32()))], names=["id", "ids"])

    return run


def _decode_ids(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = load(SparkFiles.get(name))
        for batch in batches:
            lists = batch.column(1)
            sizes = np.asarray(lists.value_lengths().fill_null(0))
            texts = decode(t, np.asarray(lists.flatten(), dtype=np.int64), np.append(0, np.cumsum(sizes)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.decode() for x in texts], pa.string())], names=["id", "text"])

    return run


def lexicon(docs: DataFrame, tokenizer: str, text_col: str = "text", most: int = LEXICON_WORDS) -> str:
    """Count, compile and ship; the file's name on the executors. With ``most`` 0 there is no counting: the lexicon is the vocabulary's own words."""
    if most:
        words: Iterable[bytes] = frequent_words(docs, text_col, most)
    else:
        with open(tokenizer, encoding="utf-8") as f:
            letters = byte_alphabet()
            words = [bytes(letters[ch] for ch in t) for t in json.load(f)["model"]["vocab"] if all(ch in letters for ch in t)]
    return shipped(docs.sparkSession, build(tokenizer, words))


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", most: int = LEXICON_WORDS) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256), one row per input row.

    Ids are those of the tokenizers library for the whole text without added
    special tokens, truncation or padding; a special token's own text in a
    document gets its id, as there. Null counts as empty and has no ids. Rows
    that repeat count by themselves; an empty table gives an empty result.
    """
    name = lexicon(docs, tokenizer, text_col, most)
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_encode_decode(name), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", most: int = LEXICON_WORDS) -> DataFrame:
    """(id, ids array<int>) of every text."""
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_encode_ids(lexicon(docs, tokenizer, text_col, most)), "id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every list of ids; null lists give empty texts."""
    name = shipped(encoded.sparkSession, build(tokenizer, []))
    return encoded.select(F.col(id_col).cast("long"), ids_col).mapInArrow(_decode_ids(name), "id long, text string")
