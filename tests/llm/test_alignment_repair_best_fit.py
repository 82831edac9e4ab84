"""Cross-tokenizer alignment, conversation repair and best-fit packing against
brute-force versions, with the edge cases their docstrings define."""

import collections
import functools
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import SF_CHECK, SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from topicscope.llm import alignment, best_fit, repair
from topicscope.llm.parts import byte_chars
from topicscope.llm.queries import QUERIES

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"w{i % 7919}" for i in range(9_000))
TEXTS = [None, "", " ", "  two  blanks \n\n and\tlines \n", "héllo wörld 😀😀 日本語のテキスト", "<|endoftext|> </s> <unk>",
         "a▁b", "\x00\x1c x  y   z", "don't we'll", "x" * 3000, "𝒳 é �", LONG, "twice", "twice"]


@pytest.fixture(scope="module")
def byte_bpe():
    tok = Tokenizer.from_file(BYTE_BPE)
    tok.encode_special_tokens = True
    return lambda text: tok.encode(text, add_special_tokens=False)


# --- alignment -------------------------------------------------------------------

def plain_alignment(byte_bpe, texts):
    """Token bytes from the vocabularies alone; every pair of tokens compared by a sweep over bytes."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    of_char = byte_chars()
    docs, counts = [], collections.Counter()
    for text in texts:
        a = byte_bpe(" " + (text or ""))
        a_ids = a.ids  # made anew at each access
        b = sp.encode(text or "")
        a_bytes = [bytes(of_char[c] for c in t) for t in a.tokens]
        b_bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, sp.id_to_piece(i)) for i in b)]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            docs.append(None)
            continue
        holds_a = np.repeat(np.arange(len(a_ids)), [len(x) for x in a_bytes])
        holds_b = np.repeat(np.arange(len(b)), [len(x) for x in b_bytes])
        links = sorted(set(zip(holds_a.tolist(), holds_b.tolist(), strict=True)))
        ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            k, m = int(np.searchsorted(ends_a, e, "right")), int(np.searchsorted(ends_b, e, "right"))
            groups.append(",".join(map(str, a_ids[i:k])) + "|" + ",".join(map(str, b[j:m])))
            i, j = k, m
        pairs = [(a_ids[x], b[y]) for x, y in links]
        counts.update(pairs)
        docs.append((len(a_ids), len(b), groups, pairs, a_ids, ends_a.tolist(), b, ends_b.tolist()))
    highest = collections.Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        out.append((d[0], d[1], len(d[2]), len(d[3]), sum(counts[p] == highest[p[1]] for p in d[3]),
                    sum(counts[p] for p in d[3]), hashlib.sha256(";".join(d[2]).encode()).hexdigest()))
    return out, docs


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 0])
@pytest.mark.parametrize("kept", [alignment.KEPT_PARTS, 0])
def test_alignment_equals_plain(spark, byte_bpe, monkeypatch, broadcast_pairs, kept):
    monkeypatch.setattr(alignment, "KEPT_PARTS", kept)
    rows = [(i, t, i, 7) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id int, text string, row long, pair long")
    want, docs = plain_alignment(byte_bpe, TEXTS)
    got = alignment.align(df, BYTE_BPE, PIECE_BPE, spans=True, broadcast_pairs=broadcast_pairs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == want[r["doc_id"]], r["doc_id"]
        d = docs[r["doc_id"]] or (0, 0, [], [], [], [], [], [])
        assert (list(r["a_ids"]), list(r["a_ends"]), list(r["b_ids"]), list(r["b_ends"])) == d[4:]
        assert list(r["group_ends"]) == sorted(set(d[5]) & set(d[7]))


def test_alignment_of_the_table(spark, byte_bpe):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want, _ = plain_alignment(byte_bpe, [r["text"] for r in docs])
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in
           QUERIES["op11_cross_tokenizer_alignment"](spark, SF_SMALL).collect()}
    assert got == {r["doc_id"]: w for r, w in zip(docs, want, strict=True)}


def test_parts_that_are_kept_stay_as_they_were():
    known = alignment.Known(alignment.aligner(BYTE_BPE, PIECE_BPE))
    texts = ["the cat sat", "on the mat é😀 x", "the cat", "a▁b c"]

    def columns(numbers):
        return [[alignment._entries(known, i, at).tolist() for i in range(6)] for at in numbers], \
            [[known.groups[i] for i in at.tolist()] for at in numbers], [known.counts()[at].tolist() for at in numbers]
    numbers = known.of(texts)
    before = columns(numbers)
    known.keep(np.unique(numbers[1]))
    assert set(known.number) == set(alignment.CUT.split(texts[1]))
    assert columns(known.of(texts)) == before


def test_work_space_of_a_task_is_bounded():
    class Rows:  # stands for the texts; hands back the function that runs in the tasks
        def mapInArrow(self, run, schema):
            return run

    alignment.aligner(BYTE_BPE, PIECE_BPE).known.forget()
    run = alignment.aligned(Rows(), BYTE_BPE, PIECE_BPE, "bigint", False)
    rng = random.Random(3)

    def batches(rows=100):
        for at in range(0, 4000, rows):  # words of their own: 720,000 distinct parts
            texts = [" ".join(f"q{rng.getrandbits(40):x}" for _ in range(180)) for _ in range(rows)]
            ids = pa.array(range(at, at + rows))
            yield pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], names=["row", "doc_id", "text"])

    tracemalloc.start()
    try:
        got = [batch.column(0).drop_null().to_pylist() for batch in run(batches())]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        alignment.aligner(BYTE_BPE, PIECE_BPE).known.forget()
    assert sorted(x for rows in got for x in rows) == list(range(4000))
    assert most < 400 << 20


def test_alignment_edges(spark):
    schema = "doc_id string, text string"
    assert alignment.align(spark.createDataFrame([], schema), BYTE_BPE, PIECE_BPE).count() == 0
    rows = alignment.align(spark.createDataFrame([(None, "same text"), (None, "same text"), ("a", None)], schema),
                           BYTE_BPE, PIECE_BPE).collect()
    assert sorted((r["doc_id"] or "", r["n_links"], r["count_sum"]) for r in rows) == [("", 2, 4), ("", 2, 4), ("a", 0, 0)]


def test_spans_are_refined_by_decoded_bytes():
    # two tokens of one character of 4 bytes, then a plain one; an empty span before a whole one
    def ends(spans, sizes):
        begin, end = np.array(spans).T
        return alignment.byte_ends(begin, end, np.array(sizes)).tolist()
    assert ends([(0, 4), (0, 4), (4, 6)], [1, 3, 2]) == [1, 4, 6]
    assert ends([(0, 0), (0, 0), (0, 3)], [1, 1, 1]) == [1, 2, 3]
    assert ends([(0, 2), (2, 3), (3, 7), (3, 7), (3, 7), (7, 8)], [2, 1, 1, 2, 1, 1]) == [2, 3, 4, 6, 7, 8]


# --- conversation repair ----------------------------------------------------------

def plain_damage(turns):
    out = []
    for conv, turn, role, text in turns:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """The contract's columns of one conversation's rows, by a search over (row, state) with whole audits."""
    white = " \t\n\x0b\x0c\r"
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        left = text.strip(white)
        faults.append("blank" if not left else "duplicate" if (role, text) in seen
                      else "truncated" if left[-1] not in ".!?" else None)
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    go = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    full = {"u": "user", "a": "assistant"}

    @functools.cache
    def best(i, state, inserted):
        """(cost, audit, repaired roles and rows)"""
        ways = []
        if i == len(rows):
            if state in ("", "a"):
                ways.append((0, "", ()))
        else:
            cost, audit, rest = best(i + 1, state, 0)
            ways.append((2 + cost, "D" + audit, rest))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                for role, step, price in [(initials[i], "K", 0), ("u", "R", 1), ("a", "R", 1)]:
                    if (state, role) in go:
                        cost, audit, rest = best(i + 1, go[state, role], 0)
                        name = rows[i][2] if step == "K" else full[role]
                        ways.append((price + more + cost, step + audit, ((name, rows[i][3]), *rest)))
        if inserted < 3:
            for role in "ua":
                if (state, role) in go:
                    cost, audit, rest = best(i, go[state, role], inserted + 1)
                    ways.append((5 + cost, "I" + audit, ((full[role], ""), *rest)))
        return min(ways, key=lambda w: w[:2]) if ways else (1 << 40, "", ())

    cost, audit, repaired = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    text = "\n".join(f"{role}:{t}" for role, t in repaired)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
            faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256(text.encode()).hexdigest())


REPAIRED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(spark, turns, block_rows=repair.BLOCK):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    convs, rows = repair.repair(df, block_rows)
    return {r["conv_id"]: tuple(r[c] for c in REPAIRED) for r in
            convs.join(repair.digests(rows), "k", "left").select(
                "k.conv_id", *REPAIRED[:-1], F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))
                .alias("repaired_sha256")).collect()}


def by_conversation(turns):
    convs = collections.defaultdict(list)
    for t in turns:
        convs[t[0]].append(t)
    return {k: plain_repair(v) for k, v in convs.items()}


def some_turns(rng, conv, n):
    texts = ["ok.", "no", "", " \t", "why?", "yes!\n", "so."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "superuser", "", " "]
    return [(conv, rng.choice([None, *range(n + 3)]), rng.choice(roles),
             rng.choice([*texts, f"t{rng.random()}.", f"t{rng.random()}.", f"t{rng.random()}"])) for _ in range(n)]


@pytest.mark.parametrize("block_rows", [repair.BLOCK, 4])
def test_repair_equals_search(spark, block_rows):
    rng = random.Random(block_rows)
    turns = [t for c in range(120) for t in some_turns(rng, c if c else None, rng.randrange(1, 14))]
    assert repaired(spark, turns, block_rows) == by_conversation(turns)


def test_repair_of_the_table(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    want = by_conversation(plain_damage(turns))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r["conv_id"]: tuple(r[c] for c in REPAIRED) for r in
           QUERIES["op12_conversation_repair"](spark, SF_CHECK).collect()}
    assert got == {c: want.get(c, nothing) for c in {t[0] for t in turns}}


def test_a_conversation_of_many_blocks(spark):
    # a third and more of all rows: its rows lie in several tasks and blocks
    rng = random.Random(3)
    turns = [(1, i, rng.choice(["user", "assistant"]), f"{rng.choice('ab')}{i // 2}{rng.choice(['.', ''])}")
             for i in range(300)] + [t for c in range(2, 40) for t in some_turns(rng, c, 8)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    small = "spark.sql.adaptive.coalescePartitions.enabled"  # tiny partitions are put together again
    spark.conf.set(small, "false")
    try:
        spread = repair.ordered(df.repartition(4)).where("k.conv_id = 1").select(F.spark_partition_id()).distinct()
        assert spread.count() > 1
    finally:
        spark.conf.unset(small)
    assert repaired(spark, turns, 16) == by_conversation(turns)


def test_damage_and_edges(spark):
    schema = "conv_id long, turn long, role string, text string, k string, pos long, block long"
    turns = [(c, t, r, x) for c in (None, 1, 2) for t in (None, 1, 2, 2)
             for r, x in [("user", None), (None, "hm."), ("assistant", "a? b! c."), ("assistant", "a? b! c.")]]
    df = spark.createDataFrame([(*t, "k", 1, 1) for t in turns], schema)
    got = collections.Counter(tuple(r) for r in repair.damaged(df).collect())
    assert got == collections.Counter(plain_damage(turns))
    convs, rows = repair.repair(repair.damaged(df))
    want = by_conversation(plain_damage(turns))
    assert {r["k"]["conv_id"]: tuple(r[c] for c in REPAIRED[:-1]) for r in convs.collect()} == \
        {k: v[:-1] for k, v in want.items()}
    # nothing is lost: every row has its edit
    assert rows.where("op != 'I'").count() == len(plain_damage(turns))
    convs, rows = repair.repair(spark.createDataFrame([], schema))
    assert convs.count() == rows.count() == 0


def test_suffixes_are_shared():
    own = repair.Automaton(repair.FINAL, True)
    signatures = ["suaua", "uaua", "xua", "aua", "Sua"]
    for s in signatures:
        own.head(s)
    assert len(own.cost) == 1 + len({s[i:] for s in signatures for i in range(len(s))})


# --- best-fit packing ---------------------------------------------------------------

def plain_best_fit(lengths, capacity, rule="norm", weights=best_fit.WEIGHTS):
    """One piece at a time, longest first; the number of bins."""
    bins = []
    for n in sorted(lengths, reverse=True):
        need, scored = (n, 1, n * n), []
        for i, rest in enumerate(bins):
            if all(r >= x for r, x in zip(rest, need, strict=True)):
                share = [r / c for r, c in zip(rest, capacity, strict=True)]
                scored.append((sum(w * s * s for w, s in zip(weights, share, strict=True)) if rule == "norm" else
                               -sum(w * s * x / c for w, s, x, c in zip(weights, share, need, capacity, strict=True)), i))
        if scored:
            i = min(scored)[1]
        else:
            i = len(bins)
            bins.append(capacity)
        bins[i] = tuple(r - x for r, x in zip(bins[i], need, strict=True))
    return len(bins)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [(64, 64, 4096), (64, 3, 4096), (64, 64, 900), (64, 4, 1500)])
def test_plan_holds_every_capacity(rule, capacity):
    rng = random.Random(str((rule, capacity)))
    longest = min(64, int(capacity[2] ** 0.5))
    lengths = [min(longest, 1 + int(rng.expovariate(1 / 15))) for _ in range(700)]
    counts = np.bincount(lengths, minlength=65)
    bins = collections.defaultdict(list)
    placed = collections.Counter()
    for n, first, many, at, per, offset in best_fit.plan(counts, capacity, rule).tolist():
        assert first == placed[n]
        placed[n] += many
        for i in range(many):
            bins[at + i // per].append((offset + i % per * n, n))
    assert placed == collections.Counter(lengths) and sorted(bins) == list(range(len(bins)))
    for held in bins.values():
        sizes = [n for _, n in held]
        assert sum(sizes) <= capacity[0] and len(sizes) <= capacity[1] and sum(n * n for n in sizes) <= capacity[2]
        ends = [0, *np.cumsum([n for _, n in sorted(held)]).tolist()]
        assert [o for o, _ in sorted(held)] == ends[:-1]
    want = plain_best_fit(lengths, capacity, rule)
    assert len(bins) == want if rule == "norm" else abs(len(bins) - want) <= 0.03 * want + 1


def check_packed(rows, texts, byte_bpe, window):
    """Exact round trip; returns sequences used and tokens."""
    ids = {k: np.array([*byte_bpe(t or "").ids, 0], "<u4") for k, t in texts.items()}
    of_doc, of_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        a = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(a)
        assert r["ids_crc32"] == zlib.crc32(a[r["start"]:r["start"] + r["length"]].tobytes())
        of_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        of_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, a in ids.items():
        at = 0
        for i, (piece, start, n) in enumerate(sorted(of_doc[k])):
            assert piece == i and start == at and (n == window or i == 0)
            at += n
        assert at == len(a) and (len(a) > window or len(of_doc[k]) == 1)
    for held in of_sequence.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at and n > 0
            at += n
        assert at <= window
    return len(of_sequence), sum(map(len, ids.values()))


def test_best_fit_of_the_table(spark, byte_bpe):
    rows = QUERIES["op13_best_fit_packing"](spark, SF_CHECK).collect()
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    used, tokens = check_packed(rows, {r["doc_id"]: r["text"] for r in docs}, byte_bpe, 2048)
    # no packing needs fewer: all tokens, or one sequence for each piece beyond the half
    assert used <= max(-(-tokens // 2048), sum(r["length"] > 1024 for r in rows)) + 1


def test_best_fit_edges(spark, byte_bpe):
    schema = "doc_id int, text string, task long, length string, number long, piece string"
    texts = dict(enumerate(TEXTS))
    df = spark.createDataFrame([(k, t, 1, "x", 2, "y") for k, t in texts.items()], schema)
    assert check_packed(best_fit.pack(df, BYTE_BPE, 64).collect(), texts, byte_bpe, 64)[0] > 0
    assert best_fit.pack(spark.createDataFrame([], schema), BYTE_BPE).count() == 0
    alike = spark.createDataFrame([(None, "the same words")] * 400, "doc_id string, text string").repartition(5)
    rows = best_fit.pack(alike, BYTE_BPE, 16, documents=3, with_ids=True).collect()
    assert collections.Counter(collections.Counter(r["sequence_id"] for r in rows).values()) == {3: 133, 1: 1}
    assert {tuple(r["ids"]) for r in rows} == {(*byte_bpe("the same words").ids, 0)}
    # a piece costs its squared length: none is longer than the root of the attention capacity
    rows = best_fit.pack(alike, BYTE_BPE, 16, attention=9).collect()
    assert max(r["length"] for r in rows) == 3
