"""Time functions, segment catalogue, event-time spreading and key parsing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from topicscope.functions.text import decode_key_millis, parse_record_key
from topicscope.functions.time import (format_day, last_closed_segment, next_interval,
                                       segment_file_name)
from topicscope.sources.segments import (after_high_water, last_record_key,
                                         segment_catalogue, spread_event_time)


def _ntz(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s string") \
                .select(F.col("s").cast("timestamp_ntz").alias("ts"))


def test_next_quarter_and_last_closed(spark):
    df = _ntz(spark, ["2024-01-01 10:14:59", "2024-01-01 10:15:00", "2024-01-01 10:59:30",
                      "2024-01-01 10:37:00"])
    got = [(str(r[0]), str(r[1])) for r in
           df.select(next_interval("ts", 15), last_closed_segment("ts", 15)).collect()]
    assert got == [("2024-01-01 10:15:00", "2024-01-01 09:45:00"),
                   ("2024-01-01 10:30:00", "2024-01-01 10:00:00"),
                   ("2024-01-01 11:00:00", "2024-01-01 10:30:00"),
                   ("2024-01-01 10:45:00", "2024-01-01 10:15:00")]


def test_interval_not_dividing_hour_restarts_each_hour(spark):
    df = _ntz(spark, ["2024-01-01 10:55:00"])
    assert str(df.select(next_interval("ts", 25)).first()[0]) == "2024-01-01 11:15:00"


def test_catalogue_window_60(spark):
    cat = segment_catalogue(spark, "2024-01-01 10:37:00", 60)
    names = [r["file_name"] for r in cat.orderBy("segment_start").collect()]
    assert names == ["20240101093000.gkg.csv", "20240101094500.gkg.csv",
                     "20240101100000.gkg.csv", "20240101101500.gkg.csv"]
    assert segment_catalogue(spark, "2024-01-01 10:37:00", 10).count() == 0
    after = after_high_water(cat, "20240101094500.gkg.csv")
    assert after.count() == 2


def test_spread_four_and_seven_lines(spark):
    rows = [("f1", f"20150219001500-{i}\tx", i) for i in range(4)] + \
           [("f2", f"20150219003000-{i}\ty", i) for i in range(7)]
    lines = spark.createDataFrame(rows, "file_name string, value string, seq long")
    got = {(r["file_name"], r["line_index"]): r["event_time"]
           for r in spread_event_time(lines).collect()}
    assert [got[("f1", i)] for i in range(4)] == [
        dt.datetime(2015, 2, 19, 0, 15, 0), dt.datetime(2015, 2, 19, 0, 18, 45),
        dt.datetime(2015, 2, 19, 0, 22, 30), dt.datetime(2015, 2, 19, 0, 26, 15)]
    step = got[("f2", 1)] - got[("f2", 0)]
    assert step == dt.timedelta(milliseconds=128571)


def test_spread_uses_line_order_not_read_order(spark):
    rows = [("f", f"20150219001500-{i}\tx", i) for i in (3, 1, 2, 0)]
    lines = spark.createDataFrame(rows, "file_name string, value string, seq long")
    got = {r["seq"]: r["line_index"] for r in spread_event_time(lines).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3}


def test_index_within_many_blocks(spark):
    from topicscope.operators.sequence import index_within
    df = spark.range(0, 5000).select(F.lit("g").alias("g"), (F.col("id") * 7).alias("o"))
    got = index_within(df, ["g"], ["o"], block_size=100, size_col="n", first_of=["o"])
    rows = got.collect()
    assert sorted(r["idx"] for r in rows) == list(range(5000))
    assert all(r["idx"] == r["o"] // 7 and r["n"] == 5000 and r["first_o"] == 0 for r in rows)


def test_key_parsing(spark):
    df = spark.createDataFrame([(k,) for k in ["12-3", "x-1", "1", "1-2-3", "12-"]], "k string")
    got = {r["k"]: (r["p"]["a"], r["p"]["b"], r["d"]) for r in
           df.select("k", parse_record_key("k").alias("p"), decode_key_millis("k").alias("d"))
             .collect()}
    assert got["12-3"] == (12, 3, 12)
    assert got["x-1"][:2] == (0, 0) and got["x-1"][2] is None
    assert got["1"] == (0, 0, 1)
    assert got["1-2-3"][:2] == (0, 0)
    assert got["12-"][:2] == (0, 0)


def test_format_day_and_file_name(spark):
    df = spark.createDataFrame([("20150219001500",), ("2015",)], "d string")
    assert [r[0] for r in df.select(format_day("d")).collect()] == ["2015-02-19", None]
    ts = _ntz(spark, ["2015-02-19 00:15:00"])
    assert ts.select(segment_file_name("ts")).first()[0] == "20150219001500.gkg.csv"


def test_last_key_default(spark):
    empty = spark.createDataFrame([], "key string, timestamp timestamp, seq long")
    assert last_record_key(empty).first()[0] == "20150218230000-0"


@pytest.mark.parametrize("super_block", [0, 1, 3, 7])
def test_index_within_runs_of_blocks(spark, super_block):
    """Two-level offsets (runs of blocks) against row_number, over a hot group
    with many blocks, gaps between blocks and a small second group."""
    from pyspark.sql import Window

    from topicscope.operators.sequence import index_within
    hot = spark.range(0, 3000).select(F.lit("h").alias("g"),
                                      (F.col("id") * 7 + (F.col("id") % 5) * 1000).alias("o"))
    cold = spark.range(0, 40).select(F.lit("c").alias("g"), (F.col("id") * 3 + 11).alias("o"))
    df = hot.unionByName(cold).dropDuplicates(["g", "o"])
    got = index_within(df, ["g"], ["o"], block_size=50, size_col="n", first_of=["o"],
                       super_block=super_block)
    w = Window.partitionBy("g").orderBy("o")
    want = df.select("g", "o", (F.row_number().over(w) - 1).alias("idx"),
                     F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n"),
                     F.min("o").over(Window.partitionBy("g")).alias("first_o"))
    cols = ["g", "o", "idx", "n", "first_o"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert got.count() == want.count()


def test_micros_do_not_depend_on_the_session_zone(spark):
    from topicscope.functions.time import epoch_micros, from_epoch_micros, segment_of, segment_stamp
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.000001' AS t, "
                      "TIMESTAMP_NTZ'1969-12-31 23:59:59.999999' AS u").select(
            from_epoch_micros(epoch_micros("t")).alias("back"), epoch_micros("u").alias("neg"),
            segment_stamp(segment_of("t")).alias("seg")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["back"] == dt.datetime(2024, 3, 10, 2, 30, 0, 1)
    assert r["neg"] == -1 and r["seg"] == "20240310023000"
