"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of lexicon words, their nearness to words
of the second person, shares of capitals and of words all in capitals,
punctuation and exclamation rates, and rates of obfuscation (lexicon words that
show only once digits and signs are read as the letters they stand for, words
that mix letters with digits or signs inside). Beside the fixed lexicon there is
a learned one: words, and beginnings of words, that labelled toxic texts hold
more often than others, weighed by smoothed log odds over the texts of all
languages, since no column but the text is an input of a score.
A labelled text is measured with weights learned from the other folds. Trees are fitted to the logistic
loss by second-order steps on binned features, on a bounded sample of
labelled rows; each fifth of it is scored by trees of the other four to calibrate
the scores by isotonic regression.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _learn, _scan
from ._spark import cut

THRESHOLD = 0.3
#: Common words of abuse, and words of the second person.
LEXICON = (
    "asshole bastard bitch bullshit clown coward crap cretin creep cunt damned degenerate dickhead dimwit dirtbag disgrace disgusting dumb dumbass dunce fag "
    "faggot fool freak fuck fucker fucking garbage halfwit hate idiot idiotic idiots ignorant imbecile jackass jerk kys liar loser losers lunatic maggot moron moronic "
    "morons motherfucker nasty nigger nincompoop parasite pathetic pervert pig prick psycho rat repulsive retard retarded rubbish scum scumbag shit shitty sicko "
    "slut stupid stupidity trash twat ugly vermin vile weirdo whore wimp worthless wretch "
    "abschaum arschloch dummkopf hurensohn schlampe vollidiot wichser connard connasse crétin enculé ordure salaud salope cabrón estúpido gilipollas imbécil pendejo puta"
).split()
SECOND_PERSON = "you your yours yourself yourselves youre ya u ur thou thee du dich dir dein deine euch euer ihr tu toi ton ta vous votre vos te tú usted ustedes vosotros".split()
NAMES = (
    "log_words", "lexicon_density", "log_lexicon_words", "distinct_share", "near_second_person", "second_person_density", "capitals", "shouted_words",
    "punctuation", "exclamations", "mixed_words", "obfuscated_density", "log_obfuscated",
)
#: What the learned lexicon adds.
LEARNED_NAMES = ("learned_density", "log_learned_words", "log_learned_kinds", "learned_top")
#: Lengths in bytes of word beginnings; a learned word or beginning is in so many toxic texts at least, and its surprise in nats and log odds are at least these.
BEGINNINGS = (4, 5, 6, 7, 8, 9)
LEAST_TOXIC, LEAST_SURPRISE, LEAST_ODDS, MOST_ENTRIES = 4, 10.0, 1.5, 65_536
FOLDS = 5

_FOLD = np.zeros(256, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
for _b in range(ord("a"), ord("z") + 1):
    _FOLD[_b] = _FOLD[_b - 32] = _b
#: Letters that digits and signs stand for; other signs inside a word are skipped.
_STAND_FOR = _FOLD.copy()
for _sign, _letter in zip("01345789@$!|+", "oieastbgasiit", strict=True):
    _STAND_FOR[ord(_sign)] = ord(_letter)
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True


def _known(words: Sequence[str]) -> np.ndarray:
    return _learn.hashes_of(words, _FOLD)


def measure(c: _scan.Chunk, lexicon: np.ndarray, second: np.ndarray, near: int = 6) -> np.ndarray:
    """documents x features."""
    n = len(c.offs) - 1
    folded = _FOLD[c.data]
    w = _scan.words(c, _FOLD == 0)
    h = _scan.span_hash(folded.astype(_scan.U64) + _scan.U64(1), w.starts, w.ends, _scan.BYTE_BASES[0])
    doc = np.repeat(np.arange(n), w.counts)
    at_bad, at_you = np.flatnonzero(_learn.member(h, lexicon)), np.flatnonzero(_learn.member(h, second))
    per = lambda d: np.bincount(d, minlength=n).astype(float)
    bad, you, words = per(doc[at_bad]), per(doc[at_you]), w.counts.astype(float)
    # a gap across documents is pushed beyond reach
    apart = np.arange(n) * (near + 1)
    gap = _learn.nearest_gap(at_bad + apart[doc[at_bad]], at_you + apart[doc[at_you]], near + 1)
    close = np.bincount(doc[at_bad], weights=(gap <= near), minlength=n)
    kinds = np.unique(np.stack([doc[at_bad].astype(np.uint64), h[at_bad]]), axis=1)[0].astype(int) if len(at_bad) else np.zeros(0, int)
    sums = lambda mask: np.diff(np.append(0, np.cumsum(mask))[c.offs]).astype(float)
    upper = _UPPER[c.data]
    letters = np.maximum(sums(folded > 0), 1)
    caps = np.append(0, np.cumsum(upper))
    shouted = (caps[w.ends] - caps[w.starts] == w.ends - w.starts) & (w.ends - w.starts >= 3)
    size = np.maximum(np.diff(c.offs), 1)
    # words at white space, read with digits and signs as letters
    t = _scan.words(c)
    tdoc = np.repeat(np.arange(n), t.counts)
    read = _STAND_FOR[c.data]
    stay = read > 0
    upto = np.append(0, np.cumsum(stay))
    rh = _scan.span_hash(read[stay].astype(_scan.U64) + _scan.U64(1), upto[t.starts], upto[t.ends], _scan.BYTE_BASES[0])
    hidden = _learn.member(rh, lexicon) & (upto[t.ends] > upto[t.starts])
    plain = np.zeros(len(t.starts), bool)
    if len(at_bad):
        plain[np.searchsorted(t.starts, w.starts[at_bad], "right") - 1] = True
    hidden &= ~plain
    inner = (_PUNCT | _DIGIT)[c.data]
    inner[1:-1] &= (folded[:-2] > 0) & (folded[2:] > 0)
    inside = np.append(0, np.cumsum(inner))
    mixed = inside[np.maximum(t.ends - 1, t.starts)] - inside[np.minimum(t.starts + 1, t.ends)] > 0
    hid = per(tdoc[hidden])
    many = np.maximum(words, 1)
    tokens = np.maximum(t.counts, 1)
    return np.stack([
        np.log1p(words), bad / many, np.log1p(bad), per(kinds) / np.maximum(bad, 1), close / np.maximum(bad, 1), you / many, sums(upper) / letters,
        per(doc[shouted]) / many, sums(_PUNCT[c.data]) / size, sums(c.data == 0x21) / tokens, per(tdoc[mixed]) / tokens, hid / tokens, np.log1p(hid),
    ], 1)


def entry_keys(c: _scan.Chunk, w: _scan.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of words, keys) for whole words and for each length of beginnings."""
    values = _FOLD[c.data].astype(_scan.U64) + _scan.U64(1)
    up, down = _scan.powers(_scan.BYTE_BASES[0], len(values))
    total = np.append(_scan.U64(0), np.cumsum(values * up[: len(values)], dtype=_scan.U64))
    size = w.ends - w.starts
    for length in (0, *BEGINNINGS):
        at = np.flatnonzero(size >= max(length, 3))
        start = w.starts[at]
        end = start + length if length else w.ends[at]
        yield at, _scan.mix((total[end] - total[start]) * down[start] ^ _scan.U64(length))


@dataclass
class Learned:
    """Sorted keys of words and beginnings, with their log odds."""

    keys: np.ndarray
    weights: np.ndarray
    table: np.ndarray | None = None

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in h, places in keys) of those that are known."""
        if not len(self.keys):
            return np.zeros(0, int), np.zeros(0, int)
        if self.table is None:
            self.table = np.zeros(1 << 20, bool)
            self.table[self.keys >> _scan.U64(44)] = True
        maybe = np.flatnonzero(self.table[h >> _scan.U64(44)])
        at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == h[maybe]
        return maybe[hit], at[hit]

    def measure(self, c: _scan.Chunk) -> np.ndarray:
        """documents x ``LEARNED_NAMES``; a word counts with the largest weight of itself and its beginnings."""
        n, w = len(c.offs) - 1, _scan.words(c, _FOLD == 0)
        best, entry = np.zeros(len(w.starts)), np.zeros(len(w.starts), int)
        for at, h in entry_keys(c, w):
            i, k = self.find(h)
            i = at[i]
            more = self.weights[k] > best[i] if len(k) else np.zeros(0, bool)
            best[i[more]], entry[i[more]] = self.weights[k[more]], k[more]
        hit = np.flatnonzero(best)
        doc = np.repeat(np.arange(n), w.counts)[hit]
        kinds = np.unique(np.stack([doc, entry[hit]]), axis=1)[0] if len(hit) else doc
        top = np.zeros(n)
        np.maximum.at(top, doc, best[hit])
        return np.stack([np.bincount(doc, best[hit], n) / np.maximum(w.counts, 1), np.log1p(np.bincount(doc, minlength=n)), np.log1p(np.bincount(kinds, minlength=n)), top], 1)


def _once(c: _scan.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(document, key), each key once per document."""
    w = _scan.words(c, _FOLD == 0)
    doc, key = (np.concatenate(x) for x in zip(*entry_keys(c, w), strict=True))
    doc = np.repeat(np.arange(len(w.counts)), w.counts)[doc]
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return doc[new], key[new]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n): in how many texts a key is."""
    for batch in batches:
        for c in _scan.chunks(batch.column(1)):
            u, n = np.unique(_once(c)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_scan.signed(u)), pa.array(n)], names=["key", "n"])


def _tallies(known: Learned):
    """(key, fold, n, y): of the texts that hold a known key, how many, and the sum of their labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _scan.chunks(batch.column(1)):
                doc, key = _once(c)
                i, k = known.find(key)
                fold, y = (np.asarray(batch.column(j)[c.first : c.last]) for j in (2, 3))
                u, of = np.unique(k * FOLDS + fold[doc[i]], return_inverse=True)
                n, total = np.bincount(of, minlength=len(u)), np.bincount(of, y[doc[i]], len(u))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (u // FOLDS, u % FOLDS, n, total)], names=["key", "fold", "n", "y"])

    return run


def weigh(keys: np.ndarray, n: np.ndarray, y: np.ndarray, rows: float, toxic: float) -> Learned:
    """The entries whose share of toxic texts (y of n) is surprising (toxic of rows in all), by log odds."""
    rest, share = n - y, (toxic + 0.5) / (rows + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        surprise = np.nan_to_num(y * np.log(y / (n * share))) + np.nan_to_num(rest * np.log(rest / (n * (1 - share))))
    odds = np.log((y + 0.5) / (toxic + 1)) - np.log((rest + 0.5) / (rows - toxic + 1))
    good = np.flatnonzero((odds >= LEAST_ODDS) & (y > n * share) & (surprise >= LEAST_SURPRISE))
    good = np.sort(good[np.argsort(-surprise[good], kind="stable")[:MOST_ENTRIES]])
    return Learned(keys[good], odds[good])


def learn(texts: DataFrame) -> tuple[Learned, list[Learned]]:
    """The lexicon of all of the labelled texts (key, text, fold, y), and for each fold that of the others."""
    tops = texts.where("y > 0").select("key", "text").mapInArrow(_keys, "key long, n long")
    tops = tops.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TOXIC)
    tops = tops.orderBy(F.desc("n"), "key").limit(4 * MOST_ENTRIES).toArrow()  # rows of Python would take ten times the room
    keys = np.sort(np.asarray(tops["key"]).astype(np.int64).view(_scan.U64))
    rows, toxic = np.zeros(FOLDS), np.zeros(FOLDS)
    for r in texts.groupBy("fold").agg(F.count("y").alias("n"), F.sum("y").alias("y")).collect():
        rows[r["fold"]], toxic[r["fold"]] = r["n"], r["y"]
    n, y = np.zeros((len(keys), FOLDS)), np.zeros((len(keys), FOLDS))
    if len(keys):
        held = texts.select("key", "text", "fold", "y").mapInArrow(_tallies(Learned(keys, np.zeros(0))), "key long, fold long, n long, y double")
        held = held.groupBy("key", "fold").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).toArrow()
        at = np.asarray(held["key"]), np.asarray(held["fold"])
        n[at], y[at] = np.asarray(held["n"]), np.asarray(held["y"])
    without = [[x.sum(-1) - (x[..., f] if f < FOLDS else 0) for x in (n, y, rows, toxic)] for f in range(FOLDS + 1)]
    return weigh(keys, *without[FOLDS]), [weigh(keys, *x) for x in without[:FOLDS]]


@dataclass
class Boosted:
    """Trees of fixed depth as arrays: at node i go to 2i + 1 where x[feature] <= cut, else to 2i + 2."""

    base: float = 0.0
    depth: int = 3
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 2 - (x[rows, f[node]] <= c[node])
            out += v[node - (2**self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.1, bins: int = 64, l2: float = 20.0, least: int = 30) -> Boosted:
    """Fit to labels from 0 to 1; a split needs ``least`` rows on each side."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Boosted(float(np.log(share / (1 - share))), depth)
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) for col in x.T]
    for j, col in enumerate(x.T):  # values that are rare beside one that is common keep a cut
        some = np.unique(col)
        edges[j] = np.unique(np.append(edges[j], (some[:-1] + some[1:])[:8] / 2)) if len(some) > 1 else edges[j]
    binned = np.stack([np.searchsorted(e, col, "left") for e, col in zip(edges, x.T, strict=True)], 1)
    width = max(len(e) for e in edges) + 1
    margin = np.full(len(y), model.base)
    inner = 2**depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, at, node = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(len(y), int)
        split_bin = np.full(inner, width)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-6)
            for j in range(x.shape[1]):
                key = (node - first) * width + binned[:, j]
                gs, hs, ns = (np.bincount(key, v, count * width).reshape(count, width).cumsum(1) for v in (g, h, np.ones(len(y))))
                gt, ht, nt = gs[:, -1:], hs[:, -1:], ns[:, -1:]
                gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                gain[(ns < least) | (nt - ns < least)] = 0
                gain[:, len(edges[j]) :] = 0
                top = gain.argmax(1)
                value = gain[np.arange(count), top]
                for k in np.flatnonzero(value > best).tolist():
                    best[k] = value[k]
                    feature[first + k], split_bin[first + k], at[first + k] = j, top[k], edges[j][top[k]]
            node = 2 * node + 2 - (binned[np.arange(len(y)), feature[node]] <= split_bin[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + l2)
        margin += value[leaf]
        model.feature.append(feature)
        model.cut.append(at)
        model.leaf.append(value)
    return model


def isotonic(score: np.ndarray, y: np.ndarray, least: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators, and blocks of fewer than ``least`` rows: (scores, non-decreasing shares) to interpolate between."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, sum of scores
    for s, t in zip(score[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([float(t), 1.0, s])
        while len(blocks) > 1 and ((p := blocks[-2])[1] < least or p[0] / p[1] >= blocks[-1][0] / blocks[-1][1]):
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(p, last, strict=True)]
    if len(blocks) > 1 and blocks[-1][1] < least:
        last = blocks.pop()
        blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    table = np.array(blocks)
    return table[:, 2] / table[:, 1], table[:, 0] / table[:, 1]


@dataclass
class Model:
    trees: Boosted
    at: np.ndarray
    share: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.trees.margin(x), self.at, self.share), 0.0, 1.0)


class Constant:
    """The score where there is nothing to learn from."""

    def __init__(self, value: float):
        self.value = value

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def fit(x: np.ndarray, y: np.ndarray, ids: np.ndarray) -> Model | Constant:
    """Trees on all rows; calibration on margins that trees of other rows gave, in five folds by a hash of the ids or digests.

    Rows with the same features, such as copies, count once, with the mean of their labels. Where all
    labels are alike, every score is their smoothed share.
    """
    if len(set(y.tolist())) < 2:
        return Constant(float((y.sum() + 0.5) / (len(y) + 10)))
    _, once, of = np.unique(x, axis=0, return_index=True, return_inverse=True)
    of = of.ravel()
    x, ids, y = x[once], ids[once], np.bincount(of, y) / np.bincount(of)
    how = {"least": int(min(30, max(5, len(y) / 100))), "l2": min(20.0, max(2.0, len(y) / 200))}
    fold = np.mod(ids, FOLDS)
    margin = np.zeros(len(y))
    for k in range(FOLDS):
        if (fold == k).any():
            margin[fold == k] = boost(x[fold != k], y[fold != k], **how).margin(x[fold == k])
    return Model(boost(x, y, **how), *isotonic(margin, y, least=int(min(10, max(2, len(y) / 40)))))


class _Measure:
    def __init__(self, lexicon: Sequence[str], learned: Sequence[Learned] = ()):
        self.lexicon, self.second, self.learned = _known(lexicon), _known(SECOND_PERSON), learned

    def __call__(self, c: _scan.Chunk, fold: pa.Array | None = None) -> np.ndarray:
        x = measure(c, self.lexicon, self.second)
        if not self.learned:
            return x
        which = np.asarray(fold) if fold is not None else np.zeros(len(x), int)
        more = np.zeros((len(x), len(LEARNED_NAMES)))
        for k in np.unique(which).tolist():
            more[which == k] = self.learned[k].measure(c)[which == k]
        return np.concatenate([x, more], 1)


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD, sample: int = _learn.SAMPLE, lexicon: Sequence[str] = LEXICON
) -> DataFrame:
    """(id, held_out, score, predicted), one row per input row.

    Every whole text gets a score in 0 to 1; null counts as empty, and empty
    texts are scored like others. Labels come only from rows that aren't held
    out. Without labels of both kinds every score is the smoothed share
    (toxic + 0.5) / (labels + 10), of equal texts once. Only texts are inputs of a score. Rows that
    repeat count by themselves; an empty table gives an empty result; further
    columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    known = F.broadcast(_learn.known_labels(labels, label_col, sample=sample))  # as many rows as the sample has
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text).join(known, "id")
    # copies are one text, in one fold, with the mean of their labels
    texts = texts.groupBy(F.xxhash64("text", F.lit(5)).alias("key")).agg(F.min("text").alias("text"), F.avg("y").alias("y"))
    texts = cut(texts.withColumn("fold", F.expr(f"pmod(key, {FOLDS})").cast("long")))
    whole, parts = learn(texts)
    got = _learn.feature_rows(texts, _Measure(lexicon, parts), "key", "text", "fold").join(texts.select(F.col("key").alias("id"), "y"), "id").orderBy("id").select("id", "x", "y").toArrow()
    x = np.asarray(got["x"].combine_chunks().flatten(), dtype=float).reshape(len(got), -1) if len(got) else np.zeros((0, 1))
    model = fit(x, np.asarray(got["y"], dtype=float), np.asarray(got["id"], dtype=np.int64))
    return _learn.scored(_learn.feature_rows(docs, _Measure(lexicon, [whole]), id_col, text_col), model, threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns."""
    bad = toxicity(docs, labels, id_col, **how).where("predicted = 1").select(F.col("id").alias("__id")).distinct()
    return docs.join(bad, F.col(id_col).cast("long") == F.col("__id"), "left_anti")
