"""Quality classifier (9): a generalised additive model with pairwise
interactions, fitted by cyclic boosting of shallow trees.

Each feature has a lookup table over its bins; round after round, each feature
in turn gets a tree of at most three leaves fitted to the current residuals of
its binned values, and the tree's leaf values are added to the table at a small
learning rate.  The strongest pairs of features (by the gain of a cut in four
on the remaining residuals) then get two-dimensional tables the same way.  A
score is a sum of table entries, looked up for whole batches at once, through
the logistic function.

The model is fitted on at most ``max_rows`` labelled rows (those of smallest id
hash, so that the same rows are taken at every run); every document is scored
on its whole text.

Defined cases: a null text counts as empty (all features 0) and is scored like
any other; labels other than 0 and 1 are ignored; without both labels in the
sample the score is the sample's share of ones (0.5 without any row); repeated
rows each get a row; :func:`score` passes other columns through, its output
column replaces an input column of that name.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, sliced, without

MAX_ROWS = 20_000
BINS = 48
ROUNDS = 120
PAIRS = 6
PAIR_BINS = 12
PAIR_ROUNDS = 60
RATE = 0.15

FEATURES = ("words", "word_length", "symbols", "upper", "digits", "marks", "commas", "bars",
            "lines", "other_ascii", "distinct", "repeats", "repeated_pairs", "dup_lines",
            "capital_words", "bare_words")

# Byte classes: 0 other, 1 lower letter, 2 upper letter, 3 digit, 4 symbol, 5 exclamation or
# question mark, 6 comma or stop, 7 bar, 8 line end, 9 other white space, 10 beyond ASCII
_CLASS = np.zeros(256, np.uint8)
for _c, _set in ((1, b"abcdefghijklmnopqrstuvwxyz"), (2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                 (3, b"0123456789"), (4, b"#*$%&<>@^~=+_\\{}[]"), (5, b"!?"), (6, b".,;:"),
                 (7, b"|"), (8, b"\n"), (9, b" \t\r\x0b\x0c"), (10, bytes(range(128, 256)))):
    _CLASS[list(_set)] = _c


def features(text: bytes | None) -> list[float]:
    """The ``FEATURES`` of one whole text."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    c = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=11)
    letters = c[1] + c[2] + c[10] or 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = set(zip(words, words[1:], strict=False))
    bare = sum(map(bytes.isalpha, words))
    capital = sum(map(bytes.isupper, words))
    return [np.log1p(n), (len(text) - c[8] - c[9]) / n, c[4] / n, c[2] / letters, c[3] / n, c[5] / n,
            c[6] / n, c[7] / n, len(lines) / n, c[0] / n, len(set(words)) / n,
            sum(map(eq, words, words[1:])) / n, 1 - len(pairs) / max(1, n - 1),
            1 - len(set(lines)) / len(lines), capital / n, bare / n]


@dataclass
class Gam:
    """Cut points per feature, their tables, and the pairs' tables."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (cut, tab) in enumerate(zip(self.cuts, self.tables, strict=True)):
            out += tab[np.searchsorted(cut, x[:, j], side="right")]
        for a, b, tab in self.pairs:
            out += tab[np.searchsorted(self.pair_cuts[a], x[:, a], side="right"),
                       np.searchsorted(self.pair_cuts[b], x[:, b], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _leaf(g, h):
    """Newton step of a leaf with gradient sum ``g`` and curvature ``h``."""
    return g / (h + 1.0)


def _gain(g, h):
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of at most three leaves over ordered bins: value per bin."""
    out = np.full(len(g), _leaf(g.sum(), h.sum()))
    parts = [(0, len(g))]
    for _ in range(2):
        best = None
        for lo, hi in parts:
            if hi - lo < 2:
                continue
            left_g, left_h = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            all_g, all_h = g[lo:hi].sum(), h[lo:hi].sum()
            gain = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            k = int(np.argmax(gain))
            if best is None or gain[k] > best[0]:
                best = (gain[k], lo, lo + k + 1, hi)
        if best is None or best[0] <= 1e-9:
            break
        _, lo, mid, hi = best
        parts.remove((lo, hi))
        parts += [(lo, mid), (mid, hi)]
        for a, b in ((lo, mid), (mid, hi)):
            out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a 2-d histogram in four: gain, and value per cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def four(c):
        top, left, total = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        a = c[:-1, :-1]
        return a, top - a, left - a, total - top - left + a

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    qs = list(zip(four(cg), four(ch), strict=True))
    gain = sum(_gain(a, b) for a, b in qs) - _gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [_leaf(a[i, j], b[i, j]) for a, b in qs]
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = values
    return float(gain[i, j]), out


def fit_rows(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS,
             rate: float = RATE) -> Gam:
    """The model of a bounded sample."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        d = x.shape[1]
        return Gam(float(np.log(share / (1 - share))), [np.zeros(0)] * d, [np.zeros(1)] * d)
    p = y.mean()
    model = Gam(float(np.log(p / (1 - p))))
    d = x.shape[1]
    model.cuts = [_cut_points(x[:, j], BINS) for j in range(d)]
    bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    f = np.full(len(y), model.base)
    for _ in range(rounds):
        for j in range(d):
            prob = 1 / (1 + np.exp(-f))
            m = len(model.tables[j])
            step = rate * _tree(np.bincount(bins[j], y - prob, m),
                                np.bincount(bins[j], prob * (1 - prob), m))
            model.tables[j] += step
            f += step[bins[j]]
    model.pair_cuts = [_cut_points(x[:, j], PAIR_BINS) for j in range(d)]
    coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.pair_cuts)]

    def histogram(a, b, weights):
        rows, cols = len(model.pair_cuts[a]) + 1, len(model.pair_cuts[b]) + 1
        return np.bincount(coarse[a] * cols + coarse[b], weights, rows * cols).reshape(rows, cols)

    prob = 1 / (1 + np.exp(-f))
    found = sorted(((_quadrants(histogram(a, b, y - prob), histogram(a, b, prob * (1 - prob)))[0], a, b)
                    for a in range(d) for b in range(a)), reverse=True)[:pairs]
    tables = {(a, b): np.zeros((len(model.pair_cuts[a]) + 1, len(model.pair_cuts[b]) + 1))
              for _, a, b in found}
    for _ in range(PAIR_ROUNDS):
        for (a, b), tab in tables.items():
            prob = 1 / (1 + np.exp(-f))
            step = rate * _quadrants(histogram(a, b, y - prob), histogram(a, b, prob * (1 - prob)))[1]
            tab += step
            f += step[coarse[a], coarse[b]]
    model.pairs = [(a, b, t) for (a, b), t in tables.items()]
    return model


def _feature_rows(at: int, keep: list[int], names: list[str]):
    def run(batches):
        for batch in sliced(batches):
            rows = [features(t.encode() if (t := v.as_py()) is not None else None)
                    for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [pa.array(rows, pa.list_(pa.float64()))], names=names)
    return run


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", max_rows: int = MAX_ROWS) -> Gam:
    """Fit on the labelled documents among the ``max_rows`` labels of smallest
    id hash.  Their ids are broadcast (at most ``max_rows``), and only their
    features reach the driver."""
    sample = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y")) \
        .orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows)
    picked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")) \
        .join(F.broadcast(sample), "_id").select("_y", "_text")
    rows = picked.mapInArrow(_feature_rows(1, [0], ["y", "x"]), "y double, x array<double>") \
        .limit(max_rows).collect()
    rows.sort(key=lambda r: (r["y"], r["x"]))  # the same model whatever the order of arrival
    x = np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES))
    return fit_rows(x, np.array([r["y"] for r in rows]))


def score(docs: DataFrame, model: Gam, text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) with ``score``."""
    docs = without(bounded_batches(docs), ["score"], text_col)
    keep = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    at, columns = docs.columns.index(text_col), [docs.columns.index(c) for c in keep]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in sliced(batches):
            x = np.array([features(t.encode() if (t := v.as_py()) is not None else None)
                          for v in batch.column(at)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in columns] + [pa.array(shared.value.score(x))],
                names=[batch.schema.names[i] for i in columns] + ["score"])

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in keep]
                                             + [T.StructField("score", T.DoubleType())]))
