"""Conversation structure repair (12) by a suffix-shared automaton.

A conversation's roles should read ``(s?(ua)+)?`` (initials of system, user,
assistant).  Its rows are brought there by the cheapest edits: Keep costs 0,
Rerole to user or assistant 1, Delete 2, Insert an empty user or assistant row
5; a blank row or one that repeats an earlier row (same role and text) must be
deleted; a truncated row that stays costs 5 more.  Of equally cheap edits those
of the least initials (D < I < K < R) are taken.

A row matters by its role's initial and its fault only, so a conversation is a
short string over nine symbols, its signature.  All signatures share one
automaton built from their ends (:class:`Automaton`): a node is a suffix, and
suffixes of any conversations that read alike are one node.  A node holds, for
each state of the grammar, the cost to go and the first step of the best edits,
found once from the node behind it; the four steps have four initials, so ties
need no comparison of longer strings.  A conversation's audit is read off along
the automaton.  Signatures are dealt by ranges of their reversed strings, so
those with a common end meet in one task; a task keeps a bounded number of nodes.

No conversation is gathered whole: rows are sorted by conversation and turn over
all tasks, and a signature covers at most ``BLOCK`` rows of one task.  A
conversation of several blocks takes two more passes of one small row per block:
the cost of every block from each state to each state gives the costs behind
every block (from the end), and these give each block its best edits and the
state it leaves (from the start).

Defined cases: a null role or text is one space, so a null text is blank and a
null role is of no initial the grammar knows; rows without conv_id are one
conversation; rows without turn come first; equal turns go by role, then text,
and rows alike in all of it are neighbours in any order; an empty role has no
initial; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Rows of a block; a power of two.
BLOCK = 1 << 12
#: Nodes that a task keeps.
KEPT_NODES = 200_000

WHITE = " \t\n\x0b\x0c\r"
DELETE, INSERT, TRUNCATED = 2, 5, 5
#: States of the grammar: nothing yet, after s, after u, after a.
STATES = range(4)
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
#: The role that may come next by Rerole or Insert.
WANTED = ["u", "u", "a", "u"]
FAR = 1 << 50
#: Cost behind the last row: a conversation ends empty or after an assistant.
FINAL = (0, FAR, FAR, 0)
ROLES = {"u": "user", "a": "assistant"}


class Automaton:
    """Nodes of all suffixes met, from the end on; ``end`` are the costs behind it.
    ``inserts`` allows Insert there (not where another block follows, which has it)."""

    def __init__(self, end: tuple[int, ...], inserts: bool):
        self.known: dict[tuple[str, int], int] = {}
        self.behind, self.cost, self.step = [-1], [], []
        self._settle([[(c, "")] for c in end], inserts)

    def _settle(self, options: list[list[tuple[int, str]]], inserts: bool = True) -> None:
        """The best of each state's options, Insert included."""
        cost = [min(o)[0] for o in options]
        if inserts:
            for _ in STATES:  # an insert leads to another state of the same node
                cost = [min(c, INSERT + cost[NEXT[s][WANTED[s]]]) for s, c in enumerate(cost)]
            options = [[*o, (INSERT + cost[NEXT[s][WANTED[s]]], "I")] for s, o in enumerate(options)]
        self.cost.append(cost)
        self.step.append([min(o)[1] for o in options])

    def node(self, symbol: str, behind: int) -> int:
        """The node of ``symbol`` before the suffix ``behind``."""
        at = self.known.get((symbol, behind))
        if at is not None:
            return at
        go = self.cost[behind]
        options = [[(DELETE + go[s], "D")] for s in STATES]
        if symbol != "x":
            role, more = symbol.lower(), TRUNCATED if symbol.isupper() else 0
            for s in STATES:
                if role in NEXT[s]:
                    options[s].append((more + go[NEXT[s][role]], "K"))
                options[s].append((1 + more + go[NEXT[s][WANTED[s]]], "R"))
        at = self.known[symbol, behind] = len(self.cost)
        self.behind.append(behind)
        self._settle(options)
        return at

    def head(self, signature: str) -> int:
        at = 0
        for symbol in reversed(signature):
            at = self.node(symbol, at)
        return at

    def edits(self, signature: str, start: int) -> tuple[int, str, list[int], str]:
        """(state behind it, audit, row that each edit is at, role initial of each)."""
        at, s, row = self.head(signature), start, 0
        audit, rows, roles = [], [], []
        while True:
            step = self.step[at][s]
            if not step:
                return s, "".join(audit), rows, "".join(roles)
            role = "-" if step == "D" else signature[row].lower() if step == "K" else WANTED[s]
            audit.append(step)
            rows.append(row)
            roles.append(role)
            if step != "D":
                s = NEXT[s][role]
            if step != "I":
                at, row = self.behind[at], row + 1


def matrix(signature: str, automata: list[Automaton]) -> list[int]:
    """Cost from each state before the block to each state behind it, row by row."""
    return [automata[e].cost[automata[e].head(signature)][s] for s in STATES for e in STATES]


def _own(state: int) -> tuple[int, ...]:
    return tuple(0 if s == state else FAR for s in STATES)


def _through_automata(signatures: DataFrame, make, schema: str) -> DataFrame:
    """``make(automaton, row)`` for (sig, ends) rows, those of a common end together.
    ``automaton(end, inserts)`` hands out the task's automata."""
    names = signatures.columns

    def run(batches):
        automata: dict = {}

        def automaton(end, inserts):
            if (end, inserts) not in automata:
                automata[end, inserts] = Automaton(end, inserts)
            return automata[end, inserts]

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if sum(len(a.cost) for a in automata.values()) > KEPT_NODES:
                    automata.clear()
                out.append({**row, **make(automaton, row)})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    kinds = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    fields = [("sig", "string"), *([("end", "array<long>")] if "end" in names else []),
              *(tuple(f.strip().split(" ", 1)) for f in schema.split(";"))]
    arrow = pa.schema([(n, kinds[k]) for n, k in fields])
    order = [*(["end"] if "end" in names else []), F.reverse("sig")]
    return signatures.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, ", ".join(f"{n} {k}" for n, k in fields))


def _matrices(automaton, row: dict) -> dict:
    return {"matrix": matrix(row["sig"], [automaton(_own(s), False) for s in STATES])}


def _plans(automaton, row: dict) -> dict:
    """For each start state: cost, state behind, audit, rows and roles of the edits."""
    end = tuple(row["end"])
    own = automaton(end, end == FINAL)
    costs, leaves, audits, places, roles = [], [], [], [], []
    for start in STATES:
        costs.append(own.cost[own.head(row["sig"])][start])
        # a state that no way leads on from is never entered
        leave, audit, rows, role = own.edits(row["sig"], start) if costs[-1] < FAR else (start, "", [], "")
        leaves.append(leave)
        audits.append(audit)
        places.append(" ".join(map(str, rows)))
        roles.append(role)
    return {"costs": costs, "leaves": leaves, "audits": "|".join(audits), "places": "|".join(places),
            "roles": "|".join(roles)}


def damaged(turns: DataFrame) -> DataFrame:
    """The conversations with known faults, by crc32(`conv_id:turn`) % 20 (a null is
    one space): 0 drops the row, 1 empties its text, 2 takes its sentence ends, 3
    doubles it, 4 makes it a user's."""
    none = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), none), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), none))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", none), F.coalesce("role", none)
    rows = turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        kind.alias("kind")).where("kind != 0")
    twice = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", F.explode(twice).alias("copy")).drop("copy")


def ordered(turns: DataFrame) -> DataFrame:
    """k (the conversation in a struct, which equals itself when null), turn, role,
    text and pos, ascending in the order of the rows; a conversation may lie in
    several tasks, however its rows are alike."""
    none = F.lit(" ")
    rows = turns.select(F.struct("conv_id").alias("k"), "turn", F.coalesce("role", none).alias("role"),
                        F.coalesce("text", none).alias("text"), F.monotonically_increasing_id().alias("_n"))
    # bounds need only the texts' first characters: what is equal there goes by text within the task
    rows = rows.withColumn("_t", F.substring("text", 1, 64))
    return rows.repartitionByRange("k", "turn", "role", "_t", "text", "_n") \
        .sortWithinPartitions("k", "turn", "role", "_t", "text", "_n") \
        .select("k", "turn", "role", "text", F.monotonically_increasing_id().alias("pos"))


def _marked(rows: DataFrame) -> DataFrame:
    """pos, k, turn, initial and fault (blank, duplicate, truncated or null) of each row."""
    ended = F.rtrim(F.col("text"), F.lit(WHITE))
    lean = rows.select(
        "pos", "k", "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("h"),
        F.substring("role", 1, 1).alias("initial"), (ended == "").alias("blank"),
        (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    again = lean.groupBy("k", "role", "h").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select("k", "role", "h", "first")
    fault = F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate") \
        .when(F.col("cut"), "truncated")
    return lean.join(again, ["k", "role", "h"], "left").select("pos", "k", "turn", "initial", fault.alias("fault"))


def _symbol() -> Column:
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    return F.when(F.col("fault").isin("blank", "duplicate"), "x") \
        .when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)


def _blocks(marked: DataFrame, block_rows: int) -> DataFrame:
    """k, block, first (pos), rows, sig, roles (initials) of at most ``block_rows`` rows each."""
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    row = F.struct("pos", _symbol().alias("y"), initial.alias("i"))
    got = marked.groupBy("k", F.floor(F.col("pos") / block_rows).alias("block")).agg(
        F.sort_array(F.collect_list(row)).alias("m"))
    text = lambda name: F.array_join(F.transform("m", lambda x: x[name]), "")
    return got.select("k", "block", F.col("m")[0]["pos"].alias("first"), F.size("m").alias("rows"),
                      text("y").alias("sig"), text("i").alias("roles"))


def _costs_behind(several: DataFrame) -> DataFrame:
    """k, block, end (costs behind the block) of conversations of several blocks."""
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                go = list(FINAL)
                last = len(row["m"]) - 1
                for i in range(last, -1, -1):
                    b = row["m"][i]
                    out.append({"k": row["k"], "block": b["block"], "end": go})
                    if i == last:  # the inserts behind the last row
                        for _ in STATES:
                            go = [min(c, INSERT + go[NEXT[s][WANTED[s]]]) for s, c in enumerate(go)]
                    go = [min(b["matrix"][4 * s + e] + go[e] for e in STATES) for s in STATES]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("k", batch.schema.field("k").type), ("block", pa.int64()), ("end", pa.list_(pa.int64()))]))

    kind = several.schema["k"].dataType.simpleString()
    rows = several.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("block", "matrix"))).alias("m"))
    return rows.mapInArrow(run, f"k {kind}, block long, end array<long>")


def _entered(several: DataFrame) -> DataFrame:
    """k, block, start (state that the block is entered in), joint (1 if the roles
    where it meets the block before are illegal)."""
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                state, before = 0, None
                for b in row["m"]:
                    joint = int(before is not None and before + b["roles"][0] not in ("su", "ua", "au"))
                    out.append({"k": row["k"], "block": b["block"], "start": state, "joint": joint})
                    state, before = b["leaves"][state], b["roles"][1]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("k", batch.schema.field("k").type), ("block", pa.int64()), ("start", pa.int64()),
                 ("joint", pa.int64())]))

    kind = several.schema["k"].dataType.simpleString()
    ends = F.concat(F.left("roles", F.lit(1)), F.right("roles", F.lit(1))).alias("roles")
    rows = several.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("block", ends, "leaves"))).alias("m"))
    return rows.mapInArrow(run, f"k {kind}, block long, start long, joint long")


def _planned(blocks: DataFrame) -> DataFrame:
    """The blocks with start, joint, cost (to the conversation's end), audit, places and
    roles of their edits."""
    final = F.array(*[F.lit(c).cast("long") for c in FINAL])
    counted = staged(blocks.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k"), "long")
    several = blocks.join(counted, "k", "left_semi")
    matrices = _through_automata(several.select("sig").distinct(), _matrices, "matrix array<long>")
    behind = _costs_behind(several.join(matrices, "sig").select("k", "block", "matrix"))
    known = staged(blocks.join(behind, ["k", "block"], "left").withColumn("end", F.coalesce("end", final)), "blocks")
    plans = staged(_through_automata(
        known.select("sig", "end").distinct(), _plans,
        "costs array<long>; leaves array<long>; audits string; places string; roles string")
        .withColumnRenamed("roles", "edit_roles"), "plans")
    entered = _entered(known.join(counted, "k", "left_semi").join(plans, ["sig", "end"])
                       .select("k", "block", "roles", "leaves"))
    full = known.join(entered, ["k", "block"], "left").join(plans, ["sig", "end"])
    start = F.coalesce(F.col("start"), F.lit(0))
    pick = lambda c: F.element_at(F.split(c, r"\|"), (start + 1).cast("int"))
    return full.select("k", "block", "first", "rows", "sig", F.col("roles").alias("initials"), start.alias("start"),
                       F.coalesce("joint", F.lit(0)).alias("joint"),
                       F.element_at("costs", (start + 1).cast("int")).alias("cost"), pick("audits").alias("audit"),
                       pick("places").alias("places"), pick("edit_roles").alias("roles"))


def repair(turns: DataFrame, block_rows: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(conversations, rows) of the repair of (conv_id, turn, role, text).

    ``conversations``: k (struct of conv_id), gaps, blank, duplicate, truncated,
    illegal, cost, audit.  ``rows``: every row with its edit, those deleted
    included, and the inserted ones: k, block and seq (their order), op, turn
    (null if inserted), role, text.
    """
    rows = staged(ordered(turns), "ordered")
    marked = staged(_marked(rows), "marked")
    blocks = staged(_planned(staged(_blocks(marked, block_rows), "blocks")), "planned")

    legal = F.regexp_count("initials", F.lit("(?=su|ua|au)."))
    by_block = blocks.groupBy("k").agg(
        F.sum(F.col("rows") - 1 - legal + F.col("joint")).alias("illegal"),
        F.min_by("cost", "block").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]),
                     "").alias("audit"))
    faults = marked.groupBy("k").agg(
        *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.min("turn").alias("lo"), F.max("turn").alias("hi"))
    turns_of = marked.where("turn IS NOT NULL").select("k", "turn").distinct() \
        .groupBy("k").agg(F.count(F.lit(1)).alias("distinct_turns"))
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("distinct_turns"), F.lit(0)).cast("long")
    convs = faults.join(turns_of, "k", "left").join(by_block, "k").select(
        "k", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    edits = blocks.where("audit != ''").select("k", "block", "first", F.posexplode(F.arrays_zip(
        F.split("audit", "").alias("op"), F.split("places", " ").cast("array<long>").alias("at"),
        F.split("roles", "").alias("to"))).alias("seq", "e")) \
        .select("k", "block", "seq", (F.col("first") + F.col("e.at")).alias("pos"), "e.op", "e.to")
    role = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    texts = rows.select("pos", "turn", F.col("role").alias("old"), "text")
    kept = edits.where("op != 'I'").join(texts, "pos").select(
        "k", "block", "seq", "op", "turn", F.when(F.col("op") == "R", role[F.col("to")]).otherwise(F.col("old"))
        .alias("role"), "text")
    kind = rows.schema["turn"].dataType
    new = edits.where("op = 'I'").select("k", "block", "seq", "op", F.lit(None).cast(kind).alias("turn"),
                                         role[F.col("to")].alias("role"), F.lit("").alias("text"))
    return convs, kept.unionByName(new)


def digests(rows: DataFrame) -> DataFrame:
    """(k, repaired_sha256) of the repaired rows ``role:text``, joined by line ends.  A digest is
    taken in one go, so a conversation's rows stream through one task, never held together."""
    def run(batches):
        key, sha, out = None, None, []
        for batch in batches:
            for k, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if sha is None or k != key:
                    if sha is not None:
                        out.append({"k": key, "repaired_sha256": sha.hexdigest()})
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            schema = pa.schema([("k", batch.schema.field("k").type), ("repaired_sha256", pa.string())])
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
        if sha is not None:
            yield pa.RecordBatch.from_pylist([{"k": key, "repaired_sha256": sha.hexdigest()}], schema=schema)

    kind = rows.schema["k"].dataType.simpleString()
    left = rows.where("op != 'D'").repartition("k").sortWithinPartitions("k", "block", "seq")
    return left.select("k", "role", "text").mapInArrow(run, f"k {kind}, repaired_sha256 string")
