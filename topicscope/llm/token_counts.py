"""Token counts (4): an exact length histogram.

Documents are encoded once; the histogram (encoded length -> documents) is one
partial and final count per length.  Its suffix sums answer, for a context
limit L, how many documents are longer, how many tokens a cut at L keeps
(sum of min(length, L)), and quantiles of the length, without the texts.

Suffix sums without a single task over all lengths: lengths are dealt into
blocks of ``BLOCK`` consecutive values, sums run inside a block, and a block's
offset comes from the table of block totals, which is itself summed by the
same two levels (its rows are at most the longest length / ``BLOCK``).

Defined cases: a null text is left out of the histogram, an empty text has
length 0; an empty table gives an empty histogram; repeated rows count each.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, sliced

BLOCK = 4096

_encoders: dict = {}


def _encoder(vocabulary: str, pattern: str):
    """Byte-level BPE from a file of ranks, loaded once per Python process."""
    if (vocabulary, pattern) not in _encoders:
        import tiktoken
        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[vocabulary, pattern] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[vocabulary, pattern]


def lengths(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text") -> DataFrame:
    """One row per document with a text: ``length``, its number of tokens.

    ``vocabulary``: path of the rank file on every machine; never special
    tokens: their strings are ordinary text."""
    def run(batches):
        encode = _encoder(vocabulary, pattern).encode_ordinary
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(encode(t)) for t in batch.column(0).to_pylist()], pa.int64())],
                names=["length"])

    return bounded_batches(docs).where(F.col(text_col).isNotNull()).select(F.col(text_col).cast("string")) \
        .mapInArrow(run, "length long")


def histogram(lens: DataFrame) -> DataFrame:
    return lens.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per length L of the histogram: n_docs, docs_longer (> L), docs_reaching
    (>= L), tokens_reaching (their tokens), and truncated_total (the tokens a
    cut of every document at L keeps)."""
    h = hist.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("t"),
                    F.floor(F.col("length") / block).alias("b"))
    down = Window.partitionBy("b").orderBy(F.desc("length")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    totals = h.groupBy("b").agg(F.sum("n_docs").alias("bn"), F.sum("t").alias("bt")) \
        .withColumn("bb", F.floor(F.col("b") / block))
    later = Window.partitionBy("bb").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    outer = totals.groupBy("bb").agg(F.sum("bn").alias("on"), F.sum("bt").alias("ot"))
    # at most (longest / block^2) rows: one for texts of up to 16 million tokens
    beyond = Window.orderBy(F.desc("bb")).rowsBetween(Window.unboundedPreceding, -1)
    outer = outer.select("bb", F.coalesce(F.sum("on").over(beyond), F.lit(0)).alias("on"),
                         F.coalesce(F.sum("ot").over(beyond), F.lit(0)).alias("ot"))
    offsets = totals.join(outer, "bb").select(
        "b", (F.coalesce(F.sum("bn").over(later), F.lit(0)) + F.col("on")).alias("bn"),
        (F.coalesce(F.sum("bt").over(later), F.lit(0)) + F.col("ot")).alias("bt"))
    s = h.join(offsets, "b").select(
        "length", "n_docs", (F.sum("n_docs").over(down) + F.col("bn")).alias("docs_reaching"),
        (F.sum("t").over(down) + F.col("bt")).alias("tokens_reaching"))
    total = hist.agg(F.sum(F.col("length") * F.col("n_docs")).alias("all_tokens"),
                     F.sum("n_docs").alias("all_docs"))
    # one row of totals beside the histogram
    s = s.crossJoin(F.broadcast(total))
    return s.select(
        "length", "n_docs", (F.col("docs_reaching") - F.col("n_docs")).alias("docs_longer"),
        "docs_reaching", "tokens_reaching",
        (F.col("all_tokens") - F.col("tokens_reaching") + F.col("length") * F.col("docs_reaching"))
        .alias("truncated_total"), "all_docs", "all_tokens")


def truncated_totals(sums: DataFrame, limits: DataFrame, limit_col: str = "limit") -> DataFrame:
    """For each row of a table of context limits: total (tokens kept by a cut
    at the limit), docs_longer, from the suffix sums alone.

    A limit between two lengths takes the sums of the next greater length."""
    edge = sums.select(F.col("length").alias("at"), "docs_reaching", "tokens_reaching",
                       "all_tokens", "n_docs")
    want = limits.select(F.col(limit_col).cast("long").alias("limit")).distinct()
    # next greater length per limit: a running minimum over the merged order
    greater = edge.join(F.broadcast(want), F.col("at") > F.col("limit")).groupBy("limit").agg(
        F.min_by(F.struct("docs_reaching", "tokens_reaching"), "at").alias("e"))
    all_tokens = sums.agg(F.coalesce(F.max("all_tokens"), F.lit(0)).alias("all_tokens"))
    return want.join(greater, "limit", "left").crossJoin(F.broadcast(all_tokens)).select(
        "limit", F.coalesce(F.col("e.docs_reaching"), F.lit(0)).alias("docs_longer"),
        (F.col("all_tokens") - F.coalesce(F.col("e.tokens_reaching"), F.lit(0))
         + F.col("limit") * F.coalesce(F.col("e.docs_reaching"), F.lit(0))).alias("total"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length that at least a share ``q`` of the
    documents does not exceed (null for an empty histogram)."""
    enough = F.col("all_docs") - F.col("docs_longer") >= F.ceil(F.lit(q) * F.col("all_docs"))
    return sums.where(enough).agg(F.min("length").alias("length"))
