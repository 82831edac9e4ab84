"""Benchmark decontamination (10): one Aho-Corasick automaton over the
normalised benchmark texts, every document scanned once.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.
Each item contributes its windows of ``window`` consecutive words (an item of
fewer words, but not none, is one window).  A document word inside any
occurrence of a window is *hit*.

The automaton is a broadcast of the benchmark's windows, whose size is checked:
the benchmark is cut into blocks of at most ``block_bytes`` of text, and a
benchmark beyond one block is scanned block by block in narrow passes, each
written before the next (no shuffle, nothing dropped, one automaton a task).

Defined cases: a null or wordless text has no words and no hits; benchmark rows
with a null id or without words are ignored; repeated rows of an item count
once; every document row gets one result row, repeated rows included; other
columns are passed through by :func:`scan`, whose output columns replace input
columns of the same names.
"""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, drop_staged, staged, without

WINDOW = 13
BLOCK_BYTES = 32 << 20

#: Byte table of the normalisation: A-Z to a-z, other ASCII but 0-9 a-z to space.
_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_TABLE = bytes(ord(chr(b).lower()) if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20
               for b in range(256))

HITS = T.ArrayType(T.StructType([T.StructField("first_word", T.LongType()),
                                 T.StructField("last_word", T.LongType()),
                                 T.StructField("start", T.LongType()),
                                 T.StructField("end", T.LongType())]))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def windows_of(words: list[bytes], window: int) -> list[tuple[bytes, ...]]:
    if len(words) <= window:
        return [tuple(words)] if words else []
    return [tuple(words[i:i + window]) for i in range(len(words) - window + 1)]


def build_automaton(items: list[tuple[str, bytes]], window: int):
    """Automaton over `` w1 w2 ... `` strings (one latin-1 character per byte,
    blank on both ends); a match's value is (words, item ids)."""
    owners: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        for w in windows_of(words_of(text), window):
            owners.setdefault(w, set()).add(item)
    auto = ahocorasick.Automaton()
    for w, ids in owners.items():
        auto.add_word(" " + b" ".join(w).decode("latin-1") + " ", (len(w), tuple(sorted(ids))))
    if owners:
        auto.make_automaton()
    return auto


def _runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def match(text: bytes | None, auto) -> tuple[int, np.ndarray | None, set[str]]:
    """(number of words, covered flag per word or None, items that occur)."""
    words = words_of(text)
    if not words or not len(auto):
        return len(words), None, set()
    joined = b" " + b" ".join(words) + b" "
    found = list(auto.iter(joined.decode("latin-1")))
    if not found:
        return len(words), None, set()
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    last = np.searchsorted(blanks, np.array([e for e, _ in found])) - 1
    first = last - np.array([n for _, (n, _) in found]) + 1
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, last + 1, -1)
    items = {i for _, (_, ids) in found for i in ids}
    return len(words), np.cumsum(step[:-1]) > 0, items


def _spans(text: bytes, covered: np.ndarray) -> list[dict]:
    """Runs of hit words with their code point offsets in the original text."""
    norm = np.frombuffer(text.translate(_TABLE), np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], norm.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    raw = np.frombuffer(text, np.uint8)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return [{"first_word": int(a), "last_word": int(b), "start": int(points[starts[a]]),
             "end": int(points[ends[b]])} for a, b in zip(*_runs(covered), strict=True)]


_built: dict[str, object] = {}


def _automaton(shared, window: int):
    """The broadcast block's automaton, built once per Python process."""
    if shared.id not in _built:
        _built.clear()
        _built[shared.id] = build_automaton(shared.value, window)
    return _built[shared.id]


class _Shared:
    """A broadcast together with an id that survives pickling."""

    def __init__(self, broadcast, key: str):
        self.broadcast, self.id = broadcast, key

    @property
    def value(self):
        return self.broadcast.value


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """Number of blocks of about ``block_bytes``, and a function that reads one."""
    items = benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item"),
        F.encode(F.col(text_col), "UTF-8").alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))

    def block(k: int) -> list[tuple[str, bytes]]:
        rows = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        return [(r["item"], bytes(r["text"])) for r in rows.collect()]

    return n, block


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text",
         window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
         keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) with n_words, n_hit, items (sorted ids, as strings) and hits
    (runs of hit words with their offsets in the original text)."""
    new = ("n_words", "n_hit", "items", "hits")
    docs = without(bounded_batches(docs), new, text_col)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    results = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
               T.StructField("items", T.ArrayType(T.StringType())), T.StructField("hits", HITS)]
    sc = docs.sparkSession.sparkContext
    at = docs.columns.index(text_col)
    n, block = _blocks(benchmark, item_col, item_text_col, block_bytes)
    out, scanned = docs, None
    for k in range(n):
        shared = _Shared(sc.broadcast(block(k)), uuid.uuid4().hex)
        names = keep if k == n - 1 else docs.columns
        fields = [docs.schema[c] for c in names] + results
        out = out.mapInArrow(_scanner(shared, window, at, [docs.columns.index(c) for c in names],
                                      k > 0), T.StructType(fields))
        if k < n - 1:  # one block's automaton at a time in a task
            before, out = scanned, staged(out, "scanned")
            scanned = out
            shared.broadcast.unpersist()
            if before is not None:
                drop_staged(before)
    return out


def _scanner(shared: _Shared, window: int, at: int, keep: list[int], later: bool):
    """Scans with one block; ``later``: the last four columns hold what the
    blocks before have found."""
    hits_type = pa.list_(pa.struct([(f.name, pa.int64()) for f in HITS.elementType.fields]))

    def run(batches):
        auto = _automaton(shared, window)
        for batch in batches:
            n_words, n_hit, items, hits = [], [], [], []
            for i, text in enumerate(batch.column(at)):
                raw = text.as_py()
                raw = None if raw is None else raw.encode()
                n, covered, found = match(raw, auto)
                if later and (before := batch.column(batch.num_columns - 1)[i].as_py()):
                    covered = np.zeros(n, bool) if covered is None else covered
                    for h in before:
                        covered[h["first_word"]:h["last_word"] + 1] = True
                    found |= set(batch.column(batch.num_columns - 2)[i].as_py())
                n_words.append(n)
                n_hit.append(0 if covered is None else int(covered.sum()))
                items.append(sorted(found))
                hits.append([] if covered is None else _spans(raw, covered))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [
                    pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                    pa.array(items, pa.list_(pa.string())), pa.array(hits, hits_type)],
                names=[batch.schema.names[i] for i in keep] + ["n_words", "n_hit", "items", "hits"])
    return run


def contaminated(n_hit="n_hit", n_words="n_words"):
    """The contract's rule: some hit, and at least a twentieth of the words."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))

