"""Best-fit packing (13): vector best-fit over the histogram of piece lengths.

A bin (sequence) has three capacities: tokens, documents (pieces) and attention
cost (the sum of its pieces' squared lengths).  Pieces are placed by decreasing
length, each into the bin that scores best of those in which every constraint
holds: ``norm`` takes the smallest weighted norm of what the bin has left,
``dot`` the largest weighted dot product of the piece's needs and what is left.
A new bin is opened only if no open one can take the piece.

Pieces of one length are alike, and so are bins with the same rest.  So the
packing is decided for all documents at once from the number of pieces of each
length (:func:`plan`): at most one number per token of a sequence, whatever the
number of documents.  A step of the plan puts a run of pieces of one length
into a run of like bins; each length makes at most two new kinds of bins, so the
plan is bounded by the square of the sequence length too.  The data themselves
never meet: every task cuts and numbers its own pieces, counts per (task,
length) give the numbers before a task's, and a piece's place follows from its
length and number.  There are no shards and no rest bins of shards.

One row per piece: doc_id, piece, start, length, ids_crc32 (of its ids as
little-endian unsigned 32-bit integers), doc_tokens, sequence_id, offset, and,
if asked for, its ids.

Defined cases: a null or empty text has only the end id and is one piece; a
document longer than a sequence is cut into whole sequences, its first piece
holds the rest; repeated rows, and rows that share an id or have none, are
documents of their own; equal scores go to the bin opened first; an empty table
gives no piece; other columns are not read.
"""

from __future__ import annotations

import json
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, sliced, staged
from .parts import byte_chars, byte_tokenizer

WINDOW = 2048
END = 0
#: Weights of tokens, documents and attention cost in a bin's score, each as a share of its capacity.
WEIGHTS = (1.0, 0.01, 0.01)

#: Texts beyond these go to the tokenizer itself: other characters than Latin (whose classes
#: both libraries know alike), or a run that the faster one takes quadratic time for.
OTHER = re.compile("[^\x00-\u024F]")
LONG_RUN = re.compile(r"\S{500}|\s{500}")
#: No text of up to this many characters needs a look for long runs.
SHORT_TEXT = 4000

_encoders: dict = {}


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file of byte-level BPE.

    Most texts are encoded by ``tiktoken`` with the file's own vocabulary and rule: a
    byte-level BPE whose ids follow the order of its merges (checked on loading) is
    the same model there, and several times faster.
    """

    def __init__(self, path: str):
        import tiktoken
        self.tok = byte_tokenizer(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary, merges = model["vocab"], model["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        chars = byte_chars()
        self.fast = None
        if all(vocabulary.get(x + y) == 256 + i for i, (x, y) in enumerate(pairs)):
            ranks = {bytes(chars[c] for c in t): i for t, i in vocabulary.items() if i < 256 + len(pairs)}
            self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    def ids(self, text: str | None) -> bytes:
        """The text's ids, 4 bytes each (null: none)."""
        if not text:
            return b""
        if self.fast is None or OTHER.search(text) or len(text) > SHORT_TEXT and LONG_RUN.search(text):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cuts(n: int, window: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: whole windows behind the rest."""
    first = n % window or min(n, window)
    return [(0, first)] + [(s, window) for s in range(first, n, window)]


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The cut documents; ``number`` counts a task's pieces of one length from 0."""
    closing = np.array([end], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "task", "number"]

    def run(batches):
        enc = encoder(path)
        task = TaskContext.get().partitionId()
        counted = np.zeros(window + 1, np.int64)
        for batch in sliced(batches):
            which, rows, ids = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                doc = enc.ids(text) + closing
                for k, (s, m) in enumerate(cuts(len(doc) // 4, window)):
                    cut = doc[4 * s:4 * (s + m)]
                    which.append(i)
                    rows.append((k, s, m, zlib.crc32(cut), len(doc) // 4, task, counted[m]))
                    counted[m] += 1
                    if with_ids:
                        ids.append(np.frombuffer(cut, "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(which, pa.int64()))]
            values = np.array(rows, np.int64).reshape(-1, 7)
            columns += [pa.array(values[:, 0].astype(np.int32)), *(pa.array(values[:, c]) for c in range(1, 7))]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)

    rows = bounded_batches(docs).select(F.col(id_col).alias("doc_id"), F.decode(F.encode(
        F.col(text_col).cast("string"), "UTF-8"), "UTF-8").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, " + ", ".join(f"{c} long" for c in names[2:])
                           + ", ids array<int>" * with_ids)


def plan(counts: np.ndarray, capacity: tuple[int, int, int], rule: str = "norm",
         weights: tuple[float, float, float] = WEIGHTS) -> np.ndarray:
    """Steps of the packing, one row each: length, first piece, pieces, first bin,
    pieces per bin, offset of the bin's first one.

    ``counts[n]`` is the number of pieces of ``n`` tokens; ``capacity`` are a
    bin's tokens, documents and attention cost.  With ``norm`` a bin that takes a
    piece becomes the best one for the next piece of that length, so it is filled
    with as many as it can take; with ``dot`` each like bin takes one in turn.
    """
    cap, w = np.array(capacity, np.int64), np.array(weights)
    rest = np.empty((0, 3), np.int64)       # what each kind of bin has left
    first, many = np.empty(0, np.int64), np.empty(0, np.int64)
    steps, bins = [], 0
    for n in np.flatnonzero(counts)[::-1].tolist():
        need = np.array([n, 1, n * n], np.int64)
        if (need > cap).any():
            raise ValueError(f"a piece of {n} tokens is beyond the capacity of a bin")
        left, number = int(counts[n]), 0
        while left:
            fits = np.flatnonzero((rest >= need).all(axis=1))
            if len(fits):
                share = rest[fits] / cap
                score = (w * share * share).sum(axis=1) if rule == "norm" else -(w * share * (need / cap)).sum(axis=1)
                at = int(fits[score.argmin()])
                per = int((rest[at] // need).min()) if rule == "norm" else 1
                here, has = int(first[at]), int(many[at])
                before = rest[at].copy()
            else:
                per = int((cap // need).min())  # no other bin can take it: one is filled, then the next
                here, has, before, at = bins, -(-left // per), cap, None
                bins += has
            # whole bins of this kind, or one bin with what is left
            some = min(has, left // per)
            put = per if some else left
            some = max(some, 1)
            steps.append((n, number, some * put, here, put, capacity[0] - int(before[0])))
            number, left = number + some * put, left - some * put
            kinds = [(before - put * need, here, some)]
            if some < has:
                kinds.append((before, here + some, has - some))
            keep = np.ones(len(first), bool)
            if at is not None:
                keep[at] = False
            kinds = [k for k in kinds if k[0][0] > 0 and k[0][1] > 0]
            rest = np.concatenate([rest[keep], *[k[0][None] for k in kinds]])
            first = np.concatenate([first[keep], [k[1] for k in kinds]]).astype(np.int64)
            many = np.concatenate([many[keep], [k[2] for k in kinds]]).astype(np.int64)
            order = np.argsort(first, kind="stable")
            rest, first, many = rest[order], first[order], many[order]
    return np.array(steps, np.int64).reshape(-1, 6)


def pack(docs: DataFrame, path: str, window: int = WINDOW, documents: int | None = None,
         attention: int | None = None, rule: str = "norm", weights: tuple[float, float, float] = WEIGHTS,
         end: int = END, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of all documents (see the module's text).  ``documents`` and
    ``attention`` are a sequence's capacities (default: as many as its tokens allow);
    a piece that alone costs more attention than that is cut shorter."""
    capacity = (window, documents or window, attention or window * window)
    longest = min(window, math.isqrt(capacity[2]))
    cut = staged(pieces(docs, path, longest, end, id_col, text_col, with_ids), "pieces")
    per_task = staged(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = np.zeros(window + 1, np.int64)
    for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row per token
        counts[r["length"]] = r["n"]
    steps = plan(counts, capacity, rule, weights)
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    shared = docs.sparkSession.sparkContext.broadcast(steps)

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = cut.join(before, ["task", "length"]).withColumn("number", F.col("number") + F.col("before"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "number"] + ["ids"] * with_ids
    out = names[:6] + ["sequence_id", "offset"] + ["ids"] * with_ids

    def placed(batches):
        length, start, _, bins, per, offset = shared.value.T
        for batch in batches:
            n, k = batch.column(3).to_numpy(), batch.column(6).to_numpy()
            # the last step of this length that begins at or before this number
            at = np.searchsorted(length << 44 | start, n << 44 | k, "right") - 1
            i = k - start[at]
            columns = [*batch.columns[:6], pa.array(bins[at] + i // per[at]),
                       pa.array(offset[at] + i % per[at] * n), *batch.columns[7:]]
            yield pa.RecordBatch.from_arrays(columns, names=out)

    kind = docs.schema[id_col].dataType.simpleString()
    return numbered.select(names).mapInArrow(
        placed, f"doc_id {kind}, piece int, " + ", ".join(f"{c} long" for c in out[2:8]) + ", ids array<int>" * with_ids)
