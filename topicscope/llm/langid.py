"""Language ID (3): hyperdimensional profiles.

Every letter has a random vector of +1/-1 components.  An n-gram's vector binds
(multiplies) its letters' vectors, each permuted (rolled) by its place; a text's
vector bundles (adds) its n-grams' vectors; a language's prototype bundles its
training texts.  A text's language is the prototype of largest cosine.

Text is lower-cased; every run of other characters than letters counts as one
blank, and a text starts and ends with a blank.  Whole texts are used.

Training: each task adds up its n-gram counts per language and emits one row
per (language, component), summed by Spark; the prototypes (languages x
``dim`` integers) are broadcast, and more than ``max_languages`` languages are
refused, which bounds that broadcast.

Defined cases: a null text, or one without letters, gets ``und`` with score 0;
without any labelled text every text gets ``und``; equal cosines go to the
first language in alphabetical order; repeated rows each count and each get a
row; :func:`predict` passes other columns through, and its output columns
replace input columns of the same names.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, sliced, without

UNKNOWN = "und"
DIM = 512
NGRAM = 3
SEED = 20
#: Letters below this code point have a slot of their own, others share as many.
_OWN = 2048
_SLOTS = 2 * _OWN
#: Characters worked on at once.
_CHUNK = 1 << 20

_tables: dict = {}


def _letters() -> np.ndarray:
    """Code point -> letter slot (0: not a letter)."""
    if "letters" not in _tables:
        slot = np.zeros(sys.maxunicode + 1, np.int16)
        points = np.array([c for c in range(sys.maxunicode + 1) if chr(c).isalpha()])
        slot[points] = np.where(points < _OWN, points, _OWN + points % _OWN)
        _tables["letters"] = slot
    return _tables["letters"]


def _vectors(dim: int) -> np.ndarray:
    """Letter slot -> random vector; slot 0 is the blank."""
    if dim not in _tables:
        rng = np.random.default_rng(SEED)
        _tables[dim] = rng.integers(0, 2, (_SLOTS, dim), np.int8) * np.int8(2) - np.int8(1)
    return _tables[dim]


def letter_slots(text: str) -> np.ndarray:
    """Slots of a text's letters with single blanks between and around words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    slots = _letters()[points]
    blank = slots == 0
    keep = ~blank
    if len(keep):
        keep[1:] |= blank[1:] & ~blank[:-1]
    slots = slots[keep]
    if not slots.any():
        return np.zeros(0, np.int64)
    inner = slots[int(slots[0] == 0):len(slots) - int(slots[-1] == 0)]
    return np.concatenate(([0], inner, [0])).astype(np.int64)


def ngram_codes(slots: np.ndarray, n: int = NGRAM) -> np.ndarray:
    m = len(slots) - n + 1
    code = np.zeros(max(m, 0), np.int64)
    for i in range(n):
        code = code * _SLOTS + slots[i:i + max(m, 0)]
    return code


def bind(codes: np.ndarray, dim: int, n: int = NGRAM) -> np.ndarray:
    """Vector of each n-gram: letters permuted by place, then multiplied."""
    letters = _vectors(dim)
    out = np.ones((len(codes), dim), np.int8)
    for place in range(n):
        at = codes // _SLOTS ** (n - 1 - place) % _SLOTS
        used, back = np.unique(at, return_inverse=True)
        out *= np.roll(letters[used], n - 1 - place, axis=1)[back]
    return out


def _grams(text: str | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and counts of a whole text."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique(ngram_codes(letter_slots(text), n), return_counts=True)


class _Bound(dict):
    """n-gram code -> its row in a growing table of vectors."""

    def __init__(self, dim: int, n: int, limit: int = 20_000):
        self.dim, self.n, self.limit = dim, n, limit
        self.table = np.zeros((0, dim), np.int8)
        self.codes = np.zeros(0, np.int64)

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct ``codes``, from the table where they are in it."""
        at = np.searchsorted(self.codes, codes)
        known = np.zeros(len(codes), bool)
        inside = at < len(self.codes)
        known[inside] = self.codes[at[inside]] == codes[inside]
        if not known.all():
            fresh = codes[~known]
            if len(self.codes) + len(fresh) > self.limit:
                if len(codes) > self.limit:
                    return bind(codes, self.dim, self.n)
                self.codes, self.table, fresh = np.zeros(0, np.int64), self.table[:0], codes
            merged = np.concatenate((self.codes, fresh))
            order = np.argsort(merged, kind="stable")
            self.codes = merged[order]
            self.table = np.concatenate((self.table, bind(fresh, self.dim, self.n)))[order]
            at = np.searchsorted(self.codes, codes)
        return self.table[at]


def bundle(codes: np.ndarray, counts: np.ndarray, bound: _Bound) -> np.ndarray:
    """The text's vector: the n-grams' vectors times their counts, added up."""
    out = np.zeros(bound.dim, np.float64)
    for at in range(0, len(codes), 4096):  # bounded work space for texts of many n-grams
        part = slice(at, at + 4096)
        out += counts[part].astype(np.float32) @ bound.rows(codes[part]).astype(np.float32)
    return out


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
               dim: int = DIM, n: int = NGRAM, max_languages: int = 1000) -> dict[str, np.ndarray]:
    """Prototype of every language among the labelled rows of ``docs``."""
    def partial(batches):
        bound = _Bound(dim, n)
        total: dict[str, np.ndarray] = {}
        for batch in sliced(batches):
            grams: dict[str, list] = {}
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                codes, counts = _grams(text.as_py(), n)
                if len(codes):
                    grams.setdefault(lang.as_py(), []).append((codes, counts))
            for lang, parts in grams.items():
                codes, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([k for _, k in parts]))
                vec = total.setdefault(lang, np.zeros(dim, np.int64))
                for at in range(0, len(codes), 4096):
                    part = slice(at, at + 4096)
                    vec += (counts[part] @ bound.rows(codes[part]).astype(np.float64)).astype(np.int64)
        for lang, vec in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dim), pa.array(np.arange(dim), pa.int32()), pa.array(vec)],
                names=["lang", "k", "v"])

    labelled = bounded_batches(docs).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sums = labelled.mapInArrow(partial, "lang string, k int, v long") \
        .groupBy("lang", "k").agg(F.sum("v").alias("v"))
    rows = sums.limit(max_languages * dim + 1).collect()
    if len(rows) > max_languages * dim:
        raise ValueError(f"more than {max_languages} languages")
    out: dict[str, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["lang"], np.zeros(dim))[r["k"]] = r["v"]
    return {k: out[k] for k in sorted(out)}


def predict(docs: DataFrame, protos: dict[str, np.ndarray], text_col: str = "text",
            dim: int = DIM, n: int = NGRAM, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) with lang_pred and
    score, the cosine with that language's prototype (0 to 1)."""
    new = {"lang_pred", "score"}
    docs = without(bounded_batches(docs), new, text_col)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    at, columns = docs.columns.index(text_col), [docs.columns.index(c) for c in keep]
    langs = list(protos)
    units = np.array([protos[k] / (np.linalg.norm(protos[k]) or 1.0) for k in langs]).reshape(-1, dim)
    shared = docs.sparkSession.sparkContext.broadcast(units)

    def run(batches):
        bound = _Bound(dim, n)
        for batch in sliced(batches):
            names, scores = [], []
            for text in batch.column(at):
                codes, counts = _grams(text.as_py(), n)
                if not len(codes) or not langs:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                x = bundle(codes, counts, bound)
                cos = shared.value @ x / (np.linalg.norm(x) or 1.0)
                best = int(np.argmax(cos))
                names.append(langs[best])
                scores.append(float(min(1.0, max(0.0, cos[best]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in columns] + [pa.array(names, pa.string()),
                                                      pa.array(scores, pa.float64())],
                names=[batch.schema.names[i] for i in columns] + ["lang_pred", "score"])

    fields = [docs.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()),
                                               T.StructField("score", T.DoubleType())]
    return docs.mapInArrow(run, T.StructType(fields))
