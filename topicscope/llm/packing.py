"""Packing (2): lexical retrieval packing into windows of a fixed size.

Documents are tokenised once; token counts, document frequencies and the mean
length are taken over all documents.  Documents are dealt into shards of about
``SHARD_TOKENS`` tokens by content (:func:`groups`, :func:`deal`): those whose
rarest shared terms agree form a group, groups fill the shards in order, and a
group larger than a shard is split by a hash of its rows.  Each shard is a BM25
inverted index of its own, and a seed finds the neighbours in its shard only.  In a shard, the next unused document is the seed of a
window; the index returns its unused neighbours by BM25 (the seed's distinct
tokens are the query), which fill the window greedily: every neighbour that
fits whole, best first, then the best of the rest is cut to fill the window to
the end.  What is left of a cut document is the seed of the next window.  So
only the last window of a shard holds padding.

One row per piece: doc_id, start (tokens of its document before it), length,
ids_crc32 (of its ids as little-endian unsigned 32-bit integers), doc_tokens,
sequence_id, offset, and, if asked for, its ids.

A shard's index is bounded: its tokens are, however many rows share an id, text
or source.  Document frequencies are at most one number per token id.

Defined cases: a null or empty text has only the end id and is one piece;
documents longer than a window fill windows of their own until the rest fits;
repeated rows are documents of their own; an empty table gives no piece; other
columns are not read.  Equal scores go by row.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, bounded_batches, drop_staged, staged
from .tokens import encoder

WINDOW = 4096
END = 2
SHARD_TOKENS = 1 << 20
K1, B = 1.2, 0.75
_IDS = 1 << 16
#: Shards that a task of a large input takes, one at a time.
SHARDS_A_TASK = 64
#: Parts of a term's group, by its documents' second term.
PARTS = 16


def tokenise(docs: DataFrame, path: str, end: int = END, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """row, doc_id, ids (binary, little-endian unsigned 16-bit), n_tokens; the
    last row of each task also has the task's document frequencies (terms, df)."""
    names = ["row", "doc_id", "ids", "n_tokens", "terms", "df"]

    def with_counts(columns, df=None):
        n = len(columns[0])
        term = [None] * n
        count = [None] * n
        if df is not None:
            at = np.flatnonzero(df)
            term[-1], count[-1] = at, df[at]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(term, pa.list_(pa.int64())), pa.array(count, pa.list_(pa.int64()))],
            names=names)

    def run(batches):
        enc = encoder(path)
        df = np.zeros(_IDS, np.int64)
        held = None
        for block in blocks(batches):
            if held is not None:
                yield with_counts(held)
            ids, bounds = enc.encode(block.column(2).cast(pa.string()), end)
            for a, b in itertools.pairwise(bounds.tolist()):
                df[np.unique(ids[a:b])] += 1
            held = [block.column(0), block.column(1), pa.Array.from_buffers(
                        pa.binary(), block.num_rows,
                        [None, pa.py_buffer(2 * bounds), pa.py_buffer(ids.astype("<u2"))]),
                    pa.array(np.diff(bounds), pa.int64())]
        if held is not None:
            yield with_counts(held, df)

    rows = bounded_batches(docs).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.encode(F.col(text_col).cast("string"), "UTF-8").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, doc_id {kind}, ids binary, n_tokens long, "
                                "terms array<long>, df array<long>")


def statistics(tokens: DataFrame) -> tuple[int, int, np.ndarray]:
    """Documents, tokens, and the document frequency of every id."""
    n, total = tokens.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    df = np.zeros(_IDS, np.int64)
    counts = tokens.where(F.col("terms").isNotNull()).select(F.inline(F.arrays_zip("terms", "df")))
    for r in counts.groupBy("terms").agg(F.sum("df").alias("df")).collect():  # at most 65,536 rows
        df[r["terms"]] = r["df"]
    return n, total, df


def groups(tokens: DataFrame, df: np.ndarray, n: int) -> DataFrame:
    """row, doc_id, ids, n_tokens and the content group: the document's rarest
    term that another document has and less than half of all have, and a part by
    the next rarest (the smaller id among equals)."""
    rarity = np.where((df >= 2) & (2 * df < n), df * np.int64(_IDS) + np.arange(_IDS), np.int64(1) << 62)
    shared = tokens.sparkSession.sparkContext.broadcast(rarity)
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches):
        rarity = shared.value
        for batch in batches:
            found = np.zeros(batch.num_rows, np.int64)
            for i, ids in enumerate(batch.column(2)):
                r = np.unique(rarity[np.frombuffer(ids.as_py(), "<u2")])
                first = int(r[0]) % _IDS
                second = int(r[1]) % _IDS if len(r) > 1 else 0
                found[i] = first * PARTS + (second * 2654435761 >> 16) % PARTS
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)],
                                             names=["row", "doc_id", "ids", "n_tokens", "group"])

    return tokens.select("row", "doc_id", "ids", "n_tokens").mapInArrow(
        run, f"row long, doc_id {kind}, ids binary, n_tokens long, group long")


def deal(sizes: np.ndarray, shard_tokens: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Per group its first shard and its number of shards, and the number of all
    shards; ``sizes`` are the groups' tokens.  Groups fill a shard in order; one
    of more than a shard's tokens has shards of its own."""
    first, several = np.zeros(len(sizes), np.int32), np.ones(len(sizes), np.int32)
    shard, held = 0, 0
    for g in np.flatnonzero(sizes).tolist():
        size = int(sizes[g])
        if held and held + size > shard_tokens:
            shard, held = shard + 1, 0
        first[g] = shard
        if size > shard_tokens:
            several[g] = -(-size // shard_tokens)
            shard, held = shard + int(several[g]), 0
        else:
            held += size
    return first, several, shard + (held > 0)


class Index:
    """BM25 inverted index of one shard; ``idf`` and ``mean`` come from all documents."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        self.n = len(docs)
        parts = [np.unique(d, return_counts=True) for d in docs]
        sizes = np.array([len(t) for t, _ in parts])
        term = np.concatenate([t for t, _ in parts])
        tf = np.concatenate([c for _, c in parts]).astype(np.float32)
        doc = np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        length = np.array([len(d) for d in docs], np.float32)
        norm = np.float32(K1) * (np.float32(1 - B) + np.float32(B / mean) * length)
        weight = idf[term].astype(np.float32) * tf * np.float32(K1 + 1) / (tf + norm[doc])
        # postings of one document can't lead to a neighbour, nor those of no weight
        postings = np.bincount(term, minlength=_IDS)
        postings[(postings < 2) | (idf <= 0)] = 0
        several = postings[term] > 0
        self.terms = [t[postings[t] > 0].astype(np.int32) for t, _ in parts]
        order = np.argsort(term[several], kind="stable")
        self.doc, self.weight = doc[several][order], weight[several][order]
        self.sizes = postings.astype(np.int32)
        self.first = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for the seed's distinct tokens."""
        terms = self.terms[seed]
        sizes = self.sizes[terms]
        ends = np.cumsum(sizes, dtype=np.int32)
        if not len(ends):
            return np.zeros(self.n)
        where = np.repeat(self.first[terms] - (ends - sizes), sizes)
        where += np.arange(ends[-1], dtype=np.int32)
        return np.bincount(self.doc[where], self.weight[where], self.n)


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean: float,
               window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece."""
    index = Index(docs, idf, mean)
    length = np.array([len(d) for d in docs])
    unused = np.ones(len(docs), bool)
    out: list[tuple[int, int, int, int, int]] = []
    sequence, upcoming, rest = 0, 0, None
    while True:
        if rest is None:
            while upcoming < len(docs) and not unused[upcoming]:
                upcoming += 1
            if upcoming == len(docs):
                return out
            seed, start = upcoming, 0
            unused[seed] = False
        else:
            seed, start = rest
        rest = None
        used = min(window, int(length[seed]) - start)
        out.append((seed, start, used, sequence, 0))
        if start + used < length[seed]:
            rest = (seed, start + used)
        elif used < window:
            free = np.flatnonzero(unused)
            ranked = free[np.argsort(-index.scores(seed)[free], kind="stable")]
            cut = None
            for d, n in zip(ranked.tolist(), length[ranked].tolist(), strict=True):
                if used == window:
                    break
                if n <= window - used:
                    out.append((d, 0, n, sequence, used))
                    unused[d] = False
                    used += n
                elif cut is None:
                    cut = d
            if used < window and cut is not None:
                part = window - used
                out.append((cut, 0, part, sequence, used))
                unused[cut] = False
                rest = (cut, part)
        sequence += 1


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, id_col: str = "doc_id",
         text_col: str = "text", shard_tokens: int = SHARD_TOKENS, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents (see the module's text)."""
    tokens = staged(tokenise(docs, path, end, id_col, text_col), "tokens")
    n, total, df = statistics(tokens)
    # the probabilistic idf, floored at 0: an id of half of all documents or more says nothing
    idf = np.maximum(np.log((n - df + 0.5) / (df + 0.5)), 0.0)
    mean = total / max(n, 1)
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    kind = tokens.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def packed(shard, rows, id_type):
        ids = [np.frombuffer(x[1], "<u2") for x in rows]
        pieces = pack_shard(ids, shared.value, mean, window)
        for at in range(0, len(pieces), 4096):
            part = pieces[at:at + 4096]
            cuts = [ids[d][s:s + m].astype("<u4") for d, s, m, _, _ in part]
            columns = [pa.array([rows[d][0] for d, *_ in part], id_type),
                       pa.array([s for _, s, _, _, _ in part], pa.int64()),
                       pa.array([m for _, _, m, _, _ in part], pa.int64()),
                       pa.array([zlib.crc32(c.tobytes()) for c in cuts], pa.int64()),
                       pa.array([len(ids[d]) for d, *_ in part], pa.int64()),
                       pa.array([(shard << 32) + q for _, _, _, q, _ in part], pa.int64()),
                       pa.array([o for *_, o in part], pa.int64())]
            if with_ids:
                columns.append(pa.array([c.astype(np.int32) for c in cuts], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)

    def run(batches):
        """The shards of a task, one after the other."""
        shard, rows, id_type = None, [], None
        for batch in batches:
            id_type = batch.schema.field(1).type
            of = batch.column(0).to_numpy()
            ends = [*(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for a, b in itertools.pairwise([0, *ends]):
                if a < b and of[a] != shard:
                    if rows:
                        yield from packed(shard, rows, id_type)
                    shard, rows = int(of[a]), []
                rows += zip(*(batch.column(k).slice(a, b - a).to_pylist() for k in (1, 2)), strict=True)
        if rows:
            yield from packed(shard, rows, id_type)

    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names[1:]) \
        + ", ids array<int>" * with_ids
    content = staged(groups(tokens, df, n), "content")
    drop_staged(tokens)
    sizes = np.zeros(_IDS * PARTS, np.int64)
    # at most one number per group: 65,536 x PARTS
    counted = content.groupBy("group").agg(F.sum("n_tokens").alias("size")).toArrow()
    sizes[counted["group"].to_numpy()] = counted["size"].to_numpy()
    first_of, several, shards = deal(sizes, shard_tokens)
    have = np.flatnonzero(sizes)
    # 16 bytes for each of at most 65,536 x PARTS groups
    places = F.broadcast(docs.sparkSession.createDataFrame(pa.table(
        {"group": have, "first": first_of[have], "several": several[have]})))
    # a task takes a run of shards, one at a time
    wanted = max(8 * docs.sparkSession.sparkContext.defaultParallelism, shards // SHARDS_A_TASK)
    run_of = max(1, -(-shards // wanted))
    dealt = content.join(places, "group").select(
        (F.col("first") + F.pmod(F.xxhash64("row"), F.col("several"))).cast("int").alias("shard"),
        "doc_id", "ids", "row")
    tasks = max(1, -(-shards // run_of))
    return dealt.repartitionById(tasks, F.floor(F.col("shard") / run_of).cast("int")) \
        .sortWithinPartitions("shard", "row").select("shard", "doc_id", "ids").mapInArrow(run, schema)
