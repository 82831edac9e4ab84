"""Cross-tokenizer alignment (11): which tokens of a byte-level BPE (A) and of a
sentencepiece model with byte fallback (B) cover the same bytes.

A text is encoded by A with a blank before it; B adds that blank itself.  Token
ends are byte offsets in that string.  They are cut coarsely by the spans the
libraries give -- character offsets of ``tokenizers``, byte spans of the
sentencepiece proto -- and refined where several tokens lie in one character
(parts of a multibyte character, byte-fallback tokens): there the decoded
bytes of the tokens say how far each reaches.  Decoded bytes must give the
string again, or the text has no tokens.

Offsets where tokens of both end cut the tokens into groups; an A and a B
token are linked if their byte ranges overlap, that is, if they hold one of the
stretches between neighbouring ends.  Both tokenizers always end a token before
a single blank between two characters that are no white space (A by its
pre-tokenizer's rule; B because no piece of its vocabulary has a blank behind
another character, which is checked on loading).  So a text's alignment is that
of its parts between such blanks, each distinct part is aligned once, and what
is kept of them is bounded by bytes.

One pass aligns the texts and writes each one's links (a number per pair of ids)
and, per task, how often each pair is linked: parts are counted, and their links
added up at the end.  The counts of all texts are then looked up link by link.
Up to ``BROADCAST_PAIRS`` distinct pairs go to all tasks, more are joined by
pair; both give the same rows.

Defined cases: a null or empty text, and one whose decoded bytes differ (it
holds U+2581), has no tokens: zeros and empty lists; special tokens' strings are
plain text; rows that share an id, or have none, are texts of their own;
repeated rows count as often as they are there; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, bounded_batches, sliced, staged
from .parts import CUT, byte_chars, byte_sizes, byte_tokenizer, cuts_at, in_calls

BLANK = "▁"
#: Aligned parts that a process holds between blocks; beyond that it keeps those met several
#: times of late.  Two Python workers share an executor with the JVM: with blocks of
#: ``BLOCK_BYTES`` the work space of one stays at some hundred MB.
KEPT_PARTS = 150_000
OFTEN = 3
BLOCK_BYTES = 2 << 20
#: Distinct pairs whose counts a task adds up before it writes them.
COUNTED_PAIRS = 1 << 19
#: Distinct pairs that are broadcast (17 bytes each).
BROADCAST_PAIRS = 1 << 21

COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

_aligners: dict = {}


def byte_ends(begin: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where each token ends.  A span's end counts if the span is not empty and the
    next one begins there or later; else the token ends its decoded bytes behind
    the one before."""
    own = end > begin
    own[:-1] &= begin[1:] >= end[:-1]
    # the last token of a clear end at or before each one (-1: none)
    last = np.maximum.accumulate(np.where(own, np.arange(len(own)), -1))
    sums = np.concatenate([[0], np.cumsum(sizes)])
    clear = np.concatenate([end, [0]])  # -1: the beginning
    return clear[last] + sums[1:] - sums[last + 1]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


class Aligner:
    """Both tokenizers, and the alignment of many parts at a time."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        self.a = byte_tokenizer(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        chars = byte_chars()
        names = sorted(self.a.get_vocab(with_added_tokens=False).items(), key=lambda x: x[1])
        self.a_bytes = {i: bytes(chars[c] for c in t) for t, i in names}
        self.b_bytes = []
        for i in range(len(self.b)):
            piece = self.b.id_to_piece(i)
            if BLANK in piece.lstrip(BLANK):
                raise ValueError("a piece of the sentencepiece model has a blank behind another character")
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i)
                                else piece.replace(BLANK, " ").encode())
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_sizes[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.pair_numbers = len(self.a_sizes) * len(self.b_bytes)
        # decimal ids with what follows them in a group: A's "," or "|", then B's "," or ";"
        self.shown = np.array([f"{i}{sign}" for ids, signs in ((len(self.a_sizes), ",|"), (len(self.b_bytes), ",;"))
                               for sign in signs for i in range(ids)], object)
        self.shown_sizes = np.array([len(x) for x in self.shown.tolist()], np.int64)
        self.known = Known(self)

    def tokens(self, text: str):
        """(A's ids, their byte ends, B's ids, their byte ends) of ``text`` with a blank before
        it, or None if the decoded bytes differ."""
        whole = " " + text
        raw = whole.encode()
        a = self.a.encode(whole, add_special_tokens=False)
        proto = [(p.id, p.begin, p.end) for p in self.b.encode(text, return_type="proto").pieces]
        a_ids = a.ids
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != raw \
                or b"".join([self.b_bytes[i] for i, _, _ in proto]) != raw:
            return None
        spans = np.fromiter(chain.from_iterable(a.offsets), np.int64, 2 * len(a_ids)).reshape(-1, 2)
        if len(raw) != len(whole):  # characters to bytes
            codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
            width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
            spans = np.concatenate([[0], np.cumsum(width)])[spans]
        a_ids = np.array(a_ids, np.int64)
        b_ids, begin, end = np.fromiter(chain.from_iterable(proto), np.int64, 3 * len(proto)).reshape(-1, 3).T
        a_ends = byte_ends(spans[:, 0], spans[:, 1], self.a_sizes[a_ids])
        # the proto's spans lie in the text itself, without the blank that B adds
        begin, end = begin + 1, end + 1
        begin[:1] = 0
        return a_ids, a_ends, b_ids, byte_ends(begin, end, self.b_sizes[b_ids])


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _columns(got, stop: np.ndarray, n_b: int):
    """Ids and byte ends of A and B, pairs and group ends of parts that stand in a row, and
    where each part's entries end in them.  A pair's number is ``A's id * n_b + B's id``."""
    a_ids, a_ends, b_ids, b_ends = got
    ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
    ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
    # a stretch that ends here is held by one token of each
    in_a, in_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    common = ends[(a_ends[in_a] == ends) & (b_ends[in_b] == ends)]
    cut_a, cut_b = cuts_at(a_ends, stop), cuts_at(b_ends, stop)
    return [a_ids, a_ends, b_ids, b_ends, a_ids[in_a] * n_b + b_ids[in_b], common], \
        [cut_a, cut_a, cut_b, cut_b, np.searchsorted(ends, stop, "right"), np.searchsorted(common, stop, "right")]


class Known:
    """The alignments of distinct parts, numbered; flat arrays with bounds hold them."""

    def __init__(self, how: Aligner):
        self.how = how
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.whole = np.zeros(0, bool)         # False: its decoded bytes differ
        self.sizes = np.zeros(0, np.int64)     # bytes
        # ids and byte ends (in the part) of both, numbers of the linked pairs, byte ends of
        # groups, the groups as ASCII text (each with a ";" behind it)
        pairs = link_type(self.how.pair_numbers)
        self.flat = [np.zeros(0, t) for t in ("i4", "i4", "i4", "i4", pairs, "i4", "u1")]
        self.bounds = [np.zeros(1, np.int64) for _ in self.flat]

    @property
    def groups(self) -> list[str]:
        """Each part's groups as text."""
        bounds, text = self.bounds[6].tolist(), self.flat[6].tobytes().decode()
        return [text[i:j - 1] if j > i else "" for i, j in pairwise(bounds)]

    def keep(self, often: np.ndarray) -> None:
        """Only the parts of these numbers (ascending), numbered anew."""
        names = np.array(list(self.number), object)[often]
        flat = [_entries(self, i, often, True) for i in range(len(self.flat))]
        bounds = [np.concatenate([[0], np.cumsum(np.diff(b)[often])]) for b in self.bounds]
        sizes, whole = self.sizes[often], self.whole[often]
        self.forget()
        self.number = {p: i for i, p in enumerate(names.tolist())}
        self.sizes, self.whole, self.flat, self.bounds = sizes, whole, flat, bounds

    def learn(self, parts: list[str]) -> None:
        fresh = []
        for call in in_calls(parts):
            got = self.how.tokens(" ".join(call))
            if got is None and len(call) > 1:  # some part's bytes differ: one by one
                for p in call:
                    fresh.append(([p], self.how.tokens(p)))
            else:
                fresh.append((call, got))
        flat, bounds = [[f] for f in self.flat], [[b] for b in self.bounds]
        sizes, whole = [self.sizes], [self.whole]
        for call, got in fresh:
            size = byte_sizes(call)
            stop = np.cumsum(size)
            columns, cuts = [np.zeros(0, np.int64)] * 7, [np.zeros(len(call), np.int64)] * 7
            if got is not None:
                columns, cuts = _columns(got, stop, len(self.how.b_bytes))
                shown, ends = self._text(columns, cuts)
                columns, cuts = [*columns, shown], [*cuts, ends]
            for i, entries in enumerate(columns):
                if i in (1, 3, 5):  # byte ends are those in the part
                    entries = entries - np.repeat(stop - size, np.diff(cuts[i], prepend=0))
                flat[i].append(entries.astype(self.flat[i].dtype))
                bounds[i].append(bounds[i][-1][-1] + cuts[i])
            sizes.append(size)
            whole.append(np.full(len(call), got is not None))
            self.number.update(zip(call, range(len(self.number), len(self.number) + len(call)), strict=True))
        self.flat = [np.concatenate(f) for f in flat]
        self.bounds = [np.concatenate(b) for b in bounds]
        self.sizes, self.whole = np.concatenate(sizes), np.concatenate(whole)

    def _text(self, columns, cuts) -> tuple[np.ndarray, np.ndarray]:
        """The groups as ASCII text, and where each part's text ends in it."""
        a_ids, a_ends, b_ids, b_ends, _, common = columns
        n_a, n_b = len(self.how.a_sizes), len(self.how.b_bytes)
        a_at, b_at = np.searchsorted(a_ends, common, "right"), np.searchsorted(b_ends, common, "right")
        # a token's place: the tokens of the groups before, and for B those of A in its group
        a_in, b_in = (np.repeat(np.arange(len(common)), np.diff(at, prepend=0)) for at in (a_at, b_at))
        entries = np.empty(len(a_ids) + len(b_ids), np.int64)
        a_place = np.arange(len(a_ids)) + np.concatenate([[0], b_at])[a_in]
        b_place = np.arange(len(b_ids)) + a_at[b_in]
        a_last, b_last = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
        a_last[a_at - 1], b_last[b_at - 1] = True, True
        entries[a_place] = a_ids + n_a * a_last
        entries[b_place] = 2 * n_a + b_ids + n_b * b_last
        text = np.frombuffer("".join(self.how.shown[entries].tolist()).encode(), "u1")
        sizes = np.concatenate([[0], np.cumsum(self.how.shown_sizes[entries])])
        return text, sizes[np.concatenate([[0], a_at + b_at])[cuts[5]]]

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        """Numbers of each text's parts; none if it has no tokens."""
        split = [CUT.split(t) if t else [] for t in texts]
        self.learn(sorted(set().union(*split) - self.number.keys()))
        found = [np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts)) for parts in split]
        return [at if self.whole[at].all() else at[:0] for at in found]

    def counts(self) -> np.ndarray:
        """Tokens of A and B, groups and links of each part."""
        return np.stack([np.diff(self.bounds[i]) for i in (0, 2, 5, 4)], axis=1)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    # bytes that are no UTF-8 become U+FFFD once, for both tokenizers
    text = F.decode(F.encode(F.col(text_col).cast("string"), "UTF-8"), "UTF-8")
    return bounded_batches(docs).select(F.monotonically_increasing_id().alias("row"),
                                        F.col(id_col).alias("doc_id"), text.alias("text"))


def aligned(texts: DataFrame, a_path: str, b_path: str, kind: str, spans: bool) -> DataFrame:
    """One row per text with its links (pair numbers, 8 bytes each, or 4 if they fit), and rows
    of each task's counts (no ``row``; ``pair`` and ``n`` have them)."""
    lists = ["a_ids", "a_ends", "b_ids", "b_ends", "group_ends"] if spans else []
    names = ["row", "doc_id", *COUNTS[:4], "groups_sha256", "links", "pair", "n", *lists]
    types = [pa.int64(), None, *[pa.int64()] * 4, pa.string(), pa.binary(), *[pa.list_(pa.int64())] * (2 + len(lists))]

    def run(batches):
        how = aligner(a_path, b_path)
        known = how.known  # what earlier tasks of the process have aligned
        seen, id_type = np.zeros(len(known.number), np.int64), None
        tally = [np.zeros(0, np.int64)] * 2  # pairs, and how often each was linked

        def count() -> None:
            """Adds the links of the parts seen to the tally."""
            pairs = np.concatenate([tally[0], known.flat[4].astype(np.int64)])
            n = np.concatenate([tally[1], np.repeat(seen, np.diff(known.bounds[4]))])
            pairs, n = pairs[n > 0], n[n > 0]
            pairs, inverse = np.unique(pairs, return_inverse=True)
            tally[:] = pairs, np.bincount(inverse, n, len(pairs)).astype(np.int64)

        def counted() -> Iterator[pa.RecordBatch]:
            columns = [pa.nulls(1, t or id_type) for t in types]
            columns[8:10] = [pa.array([x], pa.list_(pa.int64())) for x in tally]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            tally[:] = [np.zeros(0, np.int64)] * 2

        for block in blocks(batches, BLOCK_BYTES):
            id_type = block.schema.field(1).type
            found = known.of(block.column(2).to_pylist())
            seen = np.concatenate([seen, np.zeros(len(known.number) - len(seen), np.int64)])
            seen += np.bincount(np.concatenate(found), minlength=len(seen))
            counts = known.counts()
            rows = np.array([counts[at].sum(axis=0) for at in found], np.int64).reshape(-1, 4)
            groups = [hashlib.sha256(_entries(known, 6, at)[:-1]).hexdigest() if len(at) else "" for at in found]
            links = [_entries(known, 4, at).tobytes() for at in found]
            columns = [block.column(0), block.column(1), *(pa.array(rows[:, c]) for c in range(4)), pa.array(groups),
                       pa.array(links, pa.binary()), *[pa.nulls(len(found), pa.list_(pa.int64()))] * 2]
            if spans:
                columns += [pa.array([_entries(known, i, at).astype(np.int64) for at in found], pa.list_(pa.int64()))
                            for i in (0, 1, 2, 3, 5)]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            if len(known.number) > KEPT_PARTS:
                count()
                if len(tally[0]) > COUNTED_PAIRS:
                    yield from counted()
                often = np.flatnonzero(seen >= OFTEN)
                known.keep(often if len(often) <= KEPT_PARTS // 2 else often[:0])
                seen = np.zeros(len(known.number), np.int64)
        if id_type is not None:
            count()
            yield from counted()

    return texts.mapInArrow(run, f"row long, doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS[:4])
                            + ", groups_sha256 string, links binary, pair array<long>, n array<long>"
                            + "".join(f", {c} array<long>" for c in lists))


def link_type(numbers: int) -> str:
    return "<u4" if numbers <= 1 << 32 else "<i8"


def _entries(known: Known, column: int, parts: np.ndarray, as_held: bool = False) -> np.ndarray:
    """A column's entries of a text's parts; byte ends as those in the text (or as they are held)."""
    bounds, flat = known.bounds[column], known.flat[column]
    first, many = bounds[parts], bounds[parts + 1] - bounds[parts]
    ends = np.cumsum(many)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - many), many)
    if column in (1, 3, 5) and not as_held:
        return flat[at] + np.repeat(np.cumsum(known.sizes[parts]) - known.sizes[parts], many)
    return flat[at]


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """pair, n (links in all texts), best (n is the highest of the pair's B id)."""
    counts = rows.where("row IS NULL").select(F.inline(F.arrays_zip("pair", "n"))) \
        .groupBy("pair").agg(F.sum("n").alias("n"))
    counts = staged(counts.withColumn("b", F.col("pair") % n_b), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))  # at most one row per id of B
    return counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          spans: bool = False, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256, and with ``spans`` the ids and byte ends of all
    tokens (in the text with a blank before it) and of the groups."""
    how = aligner(a_path, b_path)
    width, n_b = link_type(how.pair_numbers), len(how.b_bytes)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = staged(aligned(_texts(docs, id_col, text_col), a_path, b_path, kind, spans), "alignments")
    counts = staged(pair_counts(rows, n_b), "pairs")
    texts = rows.where("row IS NOT NULL").drop("pair", "n")
    lists = texts.columns[8:]
    out = ["doc_id", *COUNTS, "groups_sha256", *lists]
    if counts.count() > broadcast_pairs:
        return _joined(texts, counts, width).select(out)
    held = counts.toArrow().sort_by("pair")
    lookup = docs.sparkSession.sparkContext.broadcast(tuple(held[c].to_numpy() for c in ("pair", "n", "best")))

    def run(batches):
        pairs, n, best = lookup.value
        for batch in sliced(batches):
            links = batch.column(7)
            numbers = np.frombuffer(b"".join(links.to_pylist()), width).astype(np.int64)
            at = np.searchsorted(pairs, numbers)
            ends = np.cumsum(np.array([0, *pc.binary_length(links).to_pylist()], np.int64)) // np.dtype(width).itemsize
            columns = [*batch.columns[1:6], pa.array(_sums(best[at], ends)), pa.array(_sums(n[at], ends)),
                       batch.column(6), *batch.columns[8:]]
            yield pa.RecordBatch.from_arrays(columns, names=out)

    return texts.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
                            + ", groups_sha256 string" + "".join(f", {c} array<long>" for c in lists))


def _joined(texts: DataFrame, counts: DataFrame, width: str) -> DataFrame:
    """The texts with n_best and count_sum, by a join of their distinct pairs."""
    def run(batches):
        for batch in sliced(batches, 64):
            for row, links in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pairs, k = np.unique(np.frombuffer(links, width).astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), row)), pa.array(pairs),
                                                  pa.array(k.astype(np.int64))], names=["row", "pair", "k"])

    links = texts.select("row", "links").mapInArrow(run, "row long, pair long, k long")
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"),
        F.sum(F.col("k") * F.col("n")).alias("count_sum"))
    return texts.join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])
