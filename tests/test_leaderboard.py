"""Bounded set, delta, snapshot and minimum."""

from topicscope.operators import leaderboard as lb


def _hist(spark, rows):
    return spark.createDataFrame(rows, "name string, count long")


def test_admit_sequence_capacity_two(spark):
    cur = _hist(spark, [])
    seen = []
    for name, count in [("x", 1), ("y", 2), ("z", 1), ("z", 2), ("x", 5)]:
        nxt = lb.admit(cur, _hist(spark, [(name, count)]), n=2)
        nxt = spark.createDataFrame(nxt.collect(), "name string, count long")
        seen.append(sorted((r["name"], r["count"]) for r in lb.delta(cur, nxt).collect()))
        cur = nxt
    # z@1 is refused (not greater than the minimum 1); z@2 displaces x
    assert seen[2] == []
    assert seen[3] == [("x", 0), ("z", 2)]
    final = {(r["name"], r["count"]) for r in cur.collect()}
    assert ("x", 5) in final and len(final) == 2


def test_equal_count_does_not_displace(spark):
    cur = _hist(spark, [("a", 3), ("b", 3)])
    nxt = lb.admit(cur, _hist(spark, [("c", 3)]), n=2)
    assert {r["name"] for r in nxt.collect()} == {"a", "b"}


def test_zero_admitted_while_room(spark):
    nxt = lb.admit(_hist(spark, [("a", 3)]), _hist(spark, [("b", 0)]), n=2)
    assert {(r["name"], r["count"]) for r in nxt.collect()} == {("a", 3), ("b", 0)}


def test_minimum_delta_snapshot(spark):
    prev = _hist(spark, [("a", 5), ("b", 2), ("c", 2)])
    cur = _hist(spark, [("a", 6), ("c", 2), ("d", 9)])
    m = lb.minimum(prev).first()
    assert (m["name"], m["count"]) == ("b", 2)
    assert {tuple(r) for r in lb.delta(prev, cur).collect()} == {("a", 6), ("b", 0), ("d", 9)}
    assert {tuple(r) for r in lb.snapshot(prev, cur).collect()} == \
        {("a", 6), ("c", 2), ("d", 9), ("b", 0)}
    msg = lb.json_message(lb.delta(prev, cur)).first()["json"]
    assert msg == '[{"name":"a","count":6},{"name":"b","count":0},{"name":"d","count":9}]'


def test_top_n_capacity_100_vs_101(spark):
    rows = [(f"n{i:03d}", i) for i in range(101)]
    top = lb.top_n(_hist(spark, rows), 100).collect()
    assert len(top) == 100 and "n000" not in {r["name"] for r in top}


def test_step_equals_admit_and_delta(spark):
    import random
    rnd = random.Random(7)
    cur = _hist(spark, [])
    for _ in range(6):
        names = rnd.sample([f"n{i}" for i in range(12)], rnd.randint(0, 8))
        upd = _hist(spark, [(n, rnd.randint(0, 6)) for n in names])
        board = lb.step(cur, upd, n=4).collect()
        nxt = lb.admit(cur, upd, n=4).collect()
        assert {(r["name"], r["count"]) for r in board if r["member"]} == \
            {(r["name"], r["count"]) for r in nxt}
        nxt = _hist(spark, [tuple(r) for r in nxt])
        assert {(r["name"], r["count"]) for r in board if r["changed"]} == \
            {tuple(r) for r in lb.delta(cur, nxt).collect()}
        assert all(r["changed"] for r in board if not r["member"])
        cur = nxt
