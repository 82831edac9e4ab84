"""Trailing-hour counts and changelog, batch forms."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from topicscope.functions.time import from_epoch_millis
from topicscope.operators.trailing import (trailing_changelog, trailing_changelog_unbucketed,
                                           trailing_count)
from topicscope.sources.tables import load_table

FIX = [(1, "A", 0), (2, "A", 0), (3, "B", 1000), (4, "A", 3600000), (5, "A", 3600001)]


def _fixture(spark):
    df = spark.createDataFrame(FIX, "id long, name string, ms long")
    return df.select("id", "name", from_epoch_millis("ms").alias("ts"))


def test_trailing_count_fixture(spark):
    got = {r["id"]: r["count"] for r in trailing_count(_fixture(spark), "name", "ts").collect()}
    assert got == {1: 2, 2: 2, 3: 1, 4: 3, 5: 2}
    plain = {r["id"]: r["count"] for r in
             trailing_count(_fixture(spark), "name", "ts", bucketed=False).collect()}
    assert plain == got


def test_changelog_fixture(spark):
    ch = trailing_changelog(_fixture(spark), "name", "ts", "id")
    rows = ch.orderBy("name", "ts", F.col("delta").desc(), "seq").collect()
    a = [(r["ts"].hour, r["ts"].minute, r["ts"].second, r["ts"].microsecond // 1000,
          r["delta"], r["count"]) for r in rows if r["name"] == "A"]
    assert [x[-1] for x in a] == [1, 2, 3, 2, 1, 2, 1, 0]
    b = [r["count"] for r in rows if r["name"] == "B"]
    assert b == [1, 0]


def test_bucketed_equals_single_partition_form(spark):
    ev = load_table(spark, SF_CHECK, "events")
    a = trailing_changelog(ev, "event_type", "ts", "event_id")
    b = trailing_changelog_unbucketed(ev, "event_type", "ts", "event_id")
    assert a.count() == b.count() == 2 * ev.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_changelog_never_negative_and_ends_at_zero(spark):
    ev = load_table(spark, SF_CHECK, "events")
    ch = trailing_changelog(ev, "event_type", "ts", "event_id")
    assert ch.where(F.col("count") < 0).count() == 0
    last = ch.groupBy("name").agg(F.max_by("count", F.struct("ts", (-F.col("delta")), "seq"))
                                  .alias("c"))
    assert {r["c"] for r in last.collect()} == {0}


def test_null_times_count_only_their_peers(spark):
    rows = [(1, "A", None), (2, "A", None), (3, "A", 0), (4, "A", 1000)]
    df = spark.createDataFrame(rows, "id long, name string, ms long") \
              .select("id", "name", from_epoch_millis("ms").alias("ts"))
    got = {r["id"]: r["count"] for r in trailing_count(df, "name", "ts").collect()}
    plain = {r["id"]: r["count"] for r in trailing_count(df, "name", "ts", bucketed=False).collect()}
    assert got == plain == {1: 2, 2: 2, 3: 1, 4: 2}
    assert trailing_changelog(df, "name", "ts", "id").count() == 4


@pytest.mark.parametrize("minutes", [5, 15, 30])
def test_latest_per_tick_equals_aggregate(spark, minutes):
    from topicscope.operators.trailing import latest_per_tick
    ev = load_table(spark, SF_CHECK, "events")
    tick = minutes * 60 * 1_000_000
    fast = latest_per_tick(ev, "event_type", "ts", "event_id", tick)
    ch = trailing_changelog(ev, "event_type", "ts", "event_id") \
        .withColumn("tick", F.window("ts", f"{minutes} minutes").start)
    slow = ch.groupBy("tick", "name").agg(
        F.max_by("count", F.struct("ts", (-F.col("delta")).alias("k"), "seq")).alias("count"))
    assert fast.count() == slow.count()
    assert fast.exceptAll(slow.select("tick", "name", "count")).count() == 0


def _one_by_one(times, counts, total, arrivals, watermark_us, window):
    """The state function's rule written out per arrival: before each
    arrival, entries with time + window < arrival leave; at the end, those
    with time + window < watermark."""
    live = dict(zip(times, counts))
    out = []

    def leave(limit):
        nonlocal total
        for t in sorted(live):
            if t + window < limit:
                total -= live[t]
                out.append((t + window, -live.pop(t), total))

    for t, n in sorted(arrivals.items()):
        leave(t)
        live[t] = live.get(t, 0) + n
        total += n
        out.append((t, n, total))
    if watermark_us is not None:
        leave(watermark_us)
    return sorted(live.items()), total, out


def test_vectorised_state_step_equals_one_by_one():
    import random

    import numpy as np

    from topicscope.streaming.trailing import NO_BOUND, advance
    rnd = random.Random(11)
    window = 50
    for _ in range(400):
        live = sorted(rnd.sample(range(0, 120), rnd.randint(0, 8)))
        counts = [rnd.randint(1, 3) for _ in live]
        total = sum(counts)
        arrivals = {t: rnd.randint(1, 4) for t in rnd.sample(range(0, 260), rnd.randint(0, 10))}
        wm = rnd.choice([None, rnd.randint(0, 300)])
        want_live, want_total, want = _one_by_one(live, counts, total, arrivals, wm, window)
        arr = sorted(arrivals.items())
        t, c, got_total, ev_t, ev_d, run = advance(
            np.array(live, np.int64), np.array(counts, np.int64), total,
            np.array([a for a, _ in arr], np.int64), np.array([n for _, n in arr], np.int64),
            NO_BOUND if wm is None else wm, window)
        assert list(zip(t.tolist(), c.tolist())) == want_live
        assert got_total == want_total
        assert list(zip(ev_t.tolist(), ev_d.tolist(), run.tolist())) == want


def test_buckets_smaller_than_the_window_and_a_hot_hour(spark):
    """One name with a third of the rows packed into one hour, a null name,
    and buckets of 1 and 5 minutes: the same log and counts as one partition
    per name."""
    hot = [(i, "H", 7_200_000 + i * 997) for i in range(3000)]          # 3 s apart
    cold = [(10_000 + i, "C" if i % 3 else None, i * 61_000) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "id long, name string, ms long") \
              .select("id", "name", from_epoch_millis("ms").alias("ts"))
    plain = trailing_changelog_unbucketed(df, "name", "ts", "id")
    exact = {r["id"]: r["count"] for r in
             trailing_count(df, "name", "ts", bucketed=False).collect()}
    for minutes in (1, 5, 15):
        b = minutes * 60_000_000
        got = trailing_changelog(df, "name", "ts", "id", bucket_micros=b)
        assert got.count() == plain.count() == 2 * df.count()
        assert got.exceptAll(plain).count() == 0
        counts = {r["id"]: r["count"] for r in
                  trailing_count(df, "name", "ts", bucket_micros=b).collect()}
        assert counts == exact


def test_bucket_must_divide_window(spark):
    import pytest
    with pytest.raises(ValueError):
        trailing_changelog(_fixture(spark), "name", "ts", "id", bucket_micros=7 * 60_000_000)


@pytest.mark.parametrize("window", [90_000_000, 1_000_001])
def test_any_window_length(spark, window):
    df = _fixture(spark)
    got = trailing_changelog(df, "name", "ts", "id", window_micros=window)
    want = trailing_changelog_unbucketed(df, "name", "ts", "id", window_micros=window)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plain = {r["id"]: r["count"] for r in
             trailing_count(df, "name", "ts", window, bucketed=False).collect()}
    assert {r["id"]: r["count"] for r in trailing_count(df, "name", "ts", window).collect()} == plain
