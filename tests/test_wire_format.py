"""Counts on the wire, record keys, and the shared folder."""

import types

import pytest
from pyspark.sql import functions as F

from topicscope.functions.text import decode_long, encode_long, parse_record_key
from topicscope.session import checkpoint_root


def test_counts_survive_the_wire(spark):
    values = [0, 1, 7, 12, 105, 9_999_999_999, 2**63 - 1, -1, -(2**63)]
    rows = spark.createDataFrame([(v,) for v in values], "n long").select(
        "n", encode_long("n").alias("b")).select("n", F.length("b").alias("size"), decode_long("b").alias("back"))
    assert all(r["size"] == 8 and r["n"] == r["back"] for r in rows.collect())
    assert spark.range(1).select(decode_long(F.lit(b"12")).alias("x")).first()["x"] is None


@pytest.mark.parametrize("key, want", [("1-2-", (1, 2)), ("12-3\n", (0, 0)), ("1-2", (1, 2)), ("-", (0, 0)),
                                       ("1-2-3", (0, 0)), ("1--", (0, 0))])
def test_record_keys(spark, key, want):
    got = spark.createDataFrame([(key,)], "k string").select(parse_record_key("k").alias("p")).first()["p"]
    assert tuple(got) == want


def test_cluster_without_shared_folder_is_refused():
    conf = types.SimpleNamespace(get=lambda *a: None)
    context = types.SimpleNamespace(master="yarn", _conf=conf)
    with pytest.raises(RuntimeError):
        checkpoint_root(types.SimpleNamespace(conf=conf, sparkContext=context))


def test_event_time_partition_and_key_survive_the_envelope(spark):
    from topicscope.sinks import kafka_columns
    from topicscope.streaming.source import kafka_record_columns
    rows = [("k1", "line 1", "2024-01-01 10:00:00.123456", 2), ("k2", "line 2", None, None)]
    df = spark.createDataFrame(rows, "key string, value string, at string, part int") \
        .withColumn("at", F.col("at").cast("timestamp"))
    sent = kafka_columns(df, "key", F.col("value"), "part", "at")
    assert sent.columns == ["key", "value", "partition", "headers"]
    stamped = F.lit("2024-02-02 00:00:00").cast("timestamp")  # what a broker would add
    got = kafka_record_columns(sent.withColumn("timestamp", stamped)) \
        .select("key", "value", F.col("timestamp").cast("string")).collect()
    assert [tuple(r) for r in got] == [("k1", "line 1", "2024-01-01 10:00:00.123456"),
                                       ("k2", "line 2", "2024-02-02 00:00:00")]
    assert [r[0] for r in sent.select("partition").collect()] == [2, None]
