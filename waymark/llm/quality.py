"""Quality: regularised quadratic discriminant analysis of document statistics.

Each class has a Gaussian over transformed statistics of the whole text. Its
covariance is shrunk towards the pooled one and towards a multiple of the
identity, and factorised once (Cholesky); the score is the logistic of the
difference of the two Mahalanobis log densities, with the classes' shares as
priors. Fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from . import _learn, _scan
from .toxicity import _DIGIT, _PUNCT, _UPPER, Constant

THRESHOLD = 0.7
NAMES = (
    "log_words", "word_length", "word_length_spread", "capitals", "punctuation", "signs", "digits", "log_distinct", "repeated_neighbours", "log_lines",
    "repeated_lines", "sentence_ends", "top_byte", "high_bytes",
)
#: Signs that prose rarely has.
_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"#$%&*+/<=>@\\^_`{|}~!")] = True
_LINE = np.zeros(256, bool)
_LINE[[10, 13]] = True


#: Shares that prose usually has, and how many units of such prose a text is eked out with: a few words tell little.
USUAL = {"capitals": 0.02, "punctuation": 0.03, "signs": 0.002, "digits": 0.005, "repeated": 0.01, "ends": 0.12, "top": 0.15, "high": 0.03}
EKED_BYTES, EKED_WORDS, EKED_LINES, WORD_LENGTH, WORD_SQUARE = 200.0, 30.0, 5.0, 5.0, 34.0


def _rate(hits: np.ndarray, of: np.ndarray, usual: float, eked: float) -> np.ndarray:
    """Log odds of a share, with ``eked`` units of the usual share added."""
    return np.log((hits + usual * eked) / (np.maximum(of - hits, 0) + (1 - usual) * eked))


def measure(c: _scan.Chunk) -> np.ndarray:
    """documents x transformed statistics."""
    n = len(c.offs) - 1
    w = _scan.words(c)
    h = _scan.word_hashes(c, w)
    doc = np.repeat(np.arange(n), w.counts)
    words = w.counts.astype(float)
    sums = lambda mask: np.diff(np.append(0, np.cumsum(mask))[c.offs]).astype(float)
    size = np.diff(c.offs).astype(float)
    length = (w.ends - w.starts).astype(float)
    mean = (np.bincount(doc, length, n) + WORD_LENGTH * EKED_WORDS) / (words + EKED_WORDS)
    spread = np.sqrt(np.maximum((np.bincount(doc, length**2, n) + WORD_SQUARE * EKED_WORDS) / (words + EKED_WORDS) - mean**2, 0))

    def distinct(of: np.ndarray, key: np.ndarray) -> np.ndarray:
        u, at = np.unique(_scan.mix(key ^ (of.astype(_scan.U64) * _scan.U64(0x9E3779B97F4A7C15))), return_index=True)
        return np.bincount(of[at], minlength=n).astype(float)

    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    lines = _scan.words(c, _LINE)
    ldoc = np.repeat(np.arange(n), lines.counts)
    lh = _scan.word_hashes(c, lines)
    letters = sums(~_PUNCT[c.data] & ~_DIGIT[c.data] & ~_scan.SPACE[c.data])
    hist = np.bincount(np.repeat(np.arange(n), np.diff(c.offs)) * 256 + c.data, minlength=n * 256).reshape(n, 256)
    hist[:, 32] = 0
    many = lines.counts.astype(float)
    u, by = USUAL, EKED_BYTES
    return np.stack([
        np.log1p(words), np.log(mean), np.log1p(spread), _rate(sums(_UPPER[c.data]), letters, u["capitals"], by), _rate(sums(_PUNCT[c.data]), size, u["punctuation"], by),
        _rate(sums(_SIGNS[c.data]), size, u["signs"], by), _rate(sums(_DIGIT[c.data]), size, u["digits"], by), np.log1p(distinct(doc, h)),
        _rate(np.bincount(doc[same], minlength=n), words, u["repeated"], EKED_WORDS), np.log1p(many), _rate(many - distinct(ldoc, lh), many, u["repeated"], EKED_LINES),
        _rate(sums(c.data == 0x2E), words, u["ends"], EKED_WORDS), _rate(hist.max(1), size, u["top"], by), _rate(sums(c.data >= 0xC0), size, u["high"], by),
    ], 1)


@dataclass
class Discriminant:
    """Two Gaussians: means, inverses of the Cholesky factors of their covariances (solved once, when fitted), half log determinants and log shares."""

    centre: np.ndarray
    scale: np.ndarray
    mean: np.ndarray
    whiten: np.ndarray
    offset: np.ndarray
    temper: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -12, 12)
        density = []
        for m, w, o in zip(self.mean, self.whiten, self.offset, strict=True):
            d = w @ (z - m).T
            density.append(o - 0.5 * (d * d).sum(0))
        return 1 / (1 + np.exp(-np.clip(self.temper * (density[1] - density[0]), -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, pooled: float = 0.3, ridge: float = 0.02, temper: float = 0.5) -> Discriminant | Constant:
    """``pooled``, ``ridge``: weights, for very many labels, of the pooled covariance and of the identity in each class's; ``temper`` scales log density differences, whose statistics aren't independent.

    Both weights rise as labels get fewer than dimensions, so that a class of one label has the pooled covariance alone; no density is known of a class without any.
    """
    if min((y == 0).sum(), (y == 1).sum()) == 0:
        return Constant(float((y.sum() + 1) / (len(y) + 2)))
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - centre) / scale, -12, 12)
    covs = [np.cov(z[y == k], rowvar=False, bias=True) for k in (0, 1)]
    counts = np.array([(y == k).sum() for k in (0, 1)])
    both = (covs[0] * counts[0] + covs[1] * counts[1]) / counts.sum()
    factors = []
    dims = x.shape[1]
    ridge = ridge ** (len(y) / (len(y) + dims))
    for cov, n in zip(covs, counts, strict=True):
        share = pooled ** ((n - 1) / (n - 1 + dims))
        cov = (1 - share) * cov + share * both
        factors.append(np.linalg.cholesky((1 - ridge) * cov + ridge * max(np.trace(cov) / len(cov), 1e-3) * np.eye(len(cov))))
    offset = np.array([-np.log(np.diag(f)).sum() + np.log(c / counts.sum()) for f, c in zip(factors, counts, strict=True)])
    return Discriminant(centre, scale, np.stack([z[y == k].mean(0) for k in (0, 1)]), np.stack([np.linalg.solve(f, np.eye(len(f))) for f in factors]), offset, temper)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD, sample: int = _learn.SAMPLE) -> DataFrame:
    """(id, held_out, score, predicted), one row per input row.

    Every whole text gets a score in 0 to 1; null counts as empty, and empty
    texts are scored like others. Labels come only from rows that aren't held
    out. Without any of one label the score is a constant, their
    smoothed share. Rows that repeat count by themselves; an empty table gives
    an empty result; further columns are ignored.
    """
    rows = _learn.feature_rows(docs, measure, id_col, text_col)
    x, y, _ = _learn.labelled_sample(rows, labels, label_col, sample=sample)
    return _learn.scored(rows, fit(x, y), threshold)
