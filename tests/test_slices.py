"""State per (name, slice), late rows, drains, hand-over, and the record log."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from topicscope.operators import leaderboard as lb
from topicscope.plans import streams
from topicscope.streaming import segment_log, slices
from topicscope.streaming.source import stream_names
from topicscope.streaming.trailing import open_sliding_hours, sliding_hour_counts

BEGIN = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
HOUR = slices.HOUR_US


def line(i, names):
    return "\t".join([f"k{i:05d}"] + [""] * 22 + [";".join(f"{n},1" for n in names), "", "", ""])


def some_records(n=400, hours=7, seed=1):
    """(key, value, timestamp, segment): a name in most records, rare ones, equal instants."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        at = rng.randrange(hours * 3600) if i % 10 else rng.randrange(hours) * 3600
        t = BEGIN + dt.timedelta(seconds=at)
        names = ["hot"] * (rng.random() < 0.7) + [rng.choice(["a", "b", "c", "d"])]
        out.append((f"k{i:05d}", line(i, names), t, f"{t:%H}"))
    return out


def plain_log(records):
    """Every change of every name, arrivals of an instant before what leaves then."""
    mentions = collections.Counter()
    for _, value, t, _ in records:
        for piece in value.split("\t")[23].split(";"):
            mentions[piece.split(",")[0], int(t.timestamp()) * 1_000_000] += 1
    changes = sorted([(n, t, 0, k) for (n, t), k in mentions.items()] + [(n, t + HOUR, 1, -k) for (n, t), k in mentions.items()])
    out, total = set(), collections.Counter()
    for name, t, kind, k in changes:
        total[name] += k
        out.add((name, t, kind, k, total[name]))
    return out


def land(spark, records, path):
    df = spark.createDataFrame(records, "key string, value string, timestamp timestamp, segment string")
    segment_log.publish(df, path, 3)


def run(spark, path, root, segments=1, after="", **how):
    names = stream_names(segment_log.stream_log(spark, path, f"{root}/checkpoint", segments, after))
    q = slices.start_slice_log(names, how.pop("log", f"{root}/log"), f"{root}/checkpoint",
                               trigger={"processingTime": "0 seconds"}, **how)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return q


def whole(spark, root, log=None):
    got = slices.settled(slices.read_log(spark, log or f"{root}/log"), slices.open_rows(spark, f"{root}/checkpoint"))
    rows = [tuple(r) for r in got.select("name", "ts_us", "kind", "delta", "count").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("order", ["forward", "reverse"])
def test_any_order_gives_one_log(spark, scratch, order):
    records = some_records()
    hours = sorted({r[3] for r in records})
    # segment names decide the order of arrival
    names = dict(zip(hours, hours if order == "forward" else reversed(hours)))
    land(spark, [(*r[:3], names[r[3]]) for r in records], f"{scratch}/landing")
    run(spark, f"{scratch}/landing", scratch)
    log = slices.read_log(spark, f"{scratch}/log")
    late = slices.late_rows(log).agg(F.sum("n")).first()[0] or 0
    assert (late > 0) == (order == "reverse")
    assert whole(spark, scratch) == plain_log(records)


PLAIN_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false"}


@pytest.fixture
def plain_store(spark):
    """The state store of a session that the package has not built."""
    before = {k: spark.conf.get(k) for k in PLAIN_STORE}
    for k, v in PLAIN_STORE.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_session_with_another_state_store(spark, scratch, plain_store):
    land(spark, some_records(), f"{scratch}/landing")
    run(spark, f"{scratch}/landing", scratch, segments=3)
    run(spark, f"{scratch}/landing", scratch, segments=3)  # started again from its checkpoint
    assert {k: spark.conf.get(k) for k in PLAIN_STORE} == PLAIN_STORE
    assert whole(spark, scratch) == plain_log(some_records())


def test_unordered_query_in_a_session_with_another_state_store(spark, scratch, plain_store):
    ids = range(3000)
    types = [None, "", "view", "view", "buy"]
    events = spark.createDataFrame(
        [(i, BEGIN + dt.timedelta(seconds=i * 7919 % 400_000), i % 97 if i % 5 else None, types[i % 7 % 5]) for i in ids],
        "event_id long, ts timestamp, user_id long, event_type string")
    events.write.parquet(f"{scratch}/in/events.parquet")
    rows = streams.stream_trailing_unordered(spark, f"{scratch}/in").collect()
    at = collections.Counter((types[i % 7 % 5], i * 7919 % 400_000) for i in ids if types[i % 7 % 5])
    changes = [(n, t, k) for (n, t), k in at.items()] + [(n, t + 3600, -k) for (n, t), k in at.items()]
    want = {(n, t, k, sum(x for m, u, x in changes if m == n and (u < t or (u == t and x >= k))))
            for n, t, k in changes}
    got = [(r["name"], round((r["ts"] - BEGIN.replace(tzinfo=None)).total_seconds()), r["delta"], r["count"]) for r in rows]
    assert len(got) == len(want) and set(got) == want


def test_unordered_query_counts_events_without_an_id(spark, scratch):
    events = [(i if i % 3 else None, BEGIN + dt.timedelta(seconds=i * 7919 % 20_000), 1, "view") for i in range(200)]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string") \
        .write.parquet(f"{scratch}/in/events.parquet")
    rows = streams.stream_trailing_unordered(spark, f"{scratch}/in").collect()
    arrived = [(r["ts"], r["delta"]) for r in rows if r["delta"] > 0]
    assert sorted(arrived) == sorted((t.replace(tzinfo=None), 1) for _, t, _, _ in events) and len(rows) == 400


def test_a_hot_name_is_many_keys(spark, scratch):
    land(spark, some_records(), f"{scratch}/landing")
    run(spark, f"{scratch}/landing", scratch, segments=2, watermark="30 hours")
    state = spark.read.format("statestore").option("stateVarName", "rows").load(f"{scratch}/checkpoint")
    hot = state.where("key.name = 'hot'").groupBy("partition_id").agg(F.countDistinct("key.slice")).collect()
    assert len(hot) > 1 and sum(r[1] for r in hot) >= 4 * 7
    # nothing was closed: all of it comes from the state
    assert whole(spark, scratch) == plain_log(some_records())


def test_state_goes_on_with_another_number_of_partitions(spark, scratch):
    records = some_records()
    first = [r for r in records if r[3] < "04"]
    land(spark, first, f"{scratch}/landing")
    run(spark, f"{scratch}/landing", f"{scratch}/old", log=f"{scratch}/log")
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    later = spark.createDataFrame([r for r in records if r[3] >= "04"],
                                  "key string, value string, timestamp timestamp, segment string")
    segment_log.publish(later, f"{scratch}/later", 3)
    spark.conf.set(key, "3")
    try:
        initial, closed = slices.handed_over(spark, f"{scratch}/old/checkpoint")
        assert closed > 0
        run(spark, f"{scratch}/later", f"{scratch}/new", after="03", log=f"{scratch}/log2", initial=initial,
            closed_before_ms=closed)
    finally:
        spark.conf.set(key, before)
    state = spark.read.format("statestore").option("stateVarName", "rows").load(f"{scratch}/new/checkpoint")
    assert {r[0] for r in state.select("partition_id").distinct().collect()} <= {0, 1, 2}
    both = slices.read_log(spark, f"{scratch}/log").unionByName(slices.read_log(spark, f"{scratch}/log2"))
    got = slices.settled(both, slices.open_rows(spark, f"{scratch}/new/checkpoint"))
    rows = {tuple(r) for r in got.select("name", "ts_us", "kind", "delta", "count").collect()}
    assert rows == plain_log(records)


def test_sliding_hours_are_drained_from_the_state(spark, scratch):
    records = some_records(60, 3)
    land(spark, records, f"{scratch}/landing")
    names = stream_names(segment_log.stream_log(spark, f"{scratch}/landing", f"{scratch}/checkpoint", 1))
    q = sliding_hour_counts(names).writeStream.outputMode("append").format("parquet") \
        .option("path", f"{scratch}/windows").option("checkpointLocation", f"{scratch}/checkpoint") \
        .trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    closed = spark.read.schema("start timestamp, end timestamp, name string, count long").parquet(f"{scratch}/windows")
    still_open = open_sliding_hours(spark, f"{scratch}/checkpoint")
    rows = closed.unionByName(still_open).select(F.unix_seconds("start"), "name", "count").collect()
    want = collections.Counter()
    for _, value, t, _ in records:
        minute = int(t.timestamp()) // 60 * 60
        for piece in value.split("\t")[23].split(";"):
            for k in range(60):
                want[minute - 60 * k, piece.split(",")[0]] += 1
    assert closed.count() and still_open.count()
    assert collections.Counter({(r[0], r[1]): r[2] for r in rows}) == want and len(rows) == len(want)


def test_log_is_read_in_the_order_of_its_segments(spark, scratch):
    path = f"{scratch}/landing"
    records = some_records(50)
    land(spark, records, path)
    rows = segment_log.read_log(spark, path).collect()
    assert {(r["key"], r["value"], r["segment"]) for r in rows} == {(r[0], r[1], r[3]) for r in records}
    by_partition = collections.defaultdict(list)
    for r in rows:
        by_partition[r["partition"]].append((r["offset"], r["segment"], r["timestamp"]))
    for held in by_partition.values():
        assert [o for o, *_ in sorted(held)] == list(range(len(held)))
        assert sorted(held) == sorted(held, key=lambda x: x[1:] + (x[0],))
    seen = []

    def one(batch, _):
        seen.append(sorted({r["segment"] for r in batch.select("segment").distinct().collect()}))

    def go():
        q = segment_log.stream_log(spark, path, f"{scratch}/checkpoint", 3).writeStream.foreachBatch(one) \
            .option("checkpointLocation", f"{scratch}/checkpoint").trigger(processingTime="0 seconds").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    go()
    names = sorted({r[3] for r in records})
    assert [n for b in seen for n in b] == names and max(map(len, seen)) <= 3
    # a restart goes on behind the last segment
    late = spark.createDataFrame([("x", "y", BEGIN, "99")], "key string, value string, timestamp timestamp, segment string")
    late.write.parquet(f"{scratch}/other")
    segment_log.publish(late, f"{scratch}/more", 3)
    import os
    os.rename(f"{scratch}/more/segment=99", f"{path}/segment=99")
    go()
    assert [n for b in seen for n in b] == [*names, "99"]
    assert segment_log.last_key(spark, path, "none").first()[0] == "x"
    assert segment_log.last_key(spark, f"{scratch}/nothing", "none").first()[0] == "none"


def test_names_decide_ties_and_the_set_is_the_exact_top(spark):
    rng = random.Random(5)
    totals, current = collections.Counter(), spark.createDataFrame([], "name string, count long")
    for _ in range(6):
        mentioned = [rng.choice("abcdefghijklm") for _ in range(9)]
        totals.update(mentioned)
        updates = spark.createDataFrame([(n, totals[n]) for n in set(mentioned)], "name string, count long")
        rows = lb.step(current, updates, 5, "name").where("member").select("name", "count").collect()
        assert sorted(map(tuple, rows)) == sorted(sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:5])
        current = spark.createDataFrame(rows, "name string, count long")
