"""JSON output.  Every task writes its own part file; nothing is collected
to the driver before a write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import encode_long


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists",
                     compression: str | None = None) -> None:
    """One JSON object per row, written in parallel (the default mode fails
    when the target exists, like a plain ``save``)."""
    writer = df.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


#: Header that carries a record's event time (microseconds, 8 big-endian bytes): the broker
#: stamps records itself, and Spark's writer can't set that time.
EVENT_TIME_HEADER = "event_time"


def kafka_columns(df: DataFrame, key: str = "name", value: Column | None = None, partition: str | None = None,
                  timestamp: str | None = None) -> DataFrame:
    """The columns that Spark's Kafka writer takes: key (a string), value (by default the
    row as JSON), and, if their columns are named, the partition and the event time."""
    value = value if value is not None else F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    columns = [F.col(key).cast("string").alias("key"), value.alias("value")]
    if partition:
        columns.append(F.col(partition).cast("int").alias("partition"))
    if timestamp:
        micros = encode_long(F.unix_micros(F.col(timestamp).cast("timestamp")))
        columns.append(F.array(F.struct(F.lit(EVENT_TIME_HEADER).alias("key"), micros.alias("value"))).alias("headers"))
    return df.select(*columns)


def write_kafka(df: DataFrame, servers: str, topic: str, key: str = "name", value: Column | None = None,
                partition: str | None = None, timestamp: str | None = None) -> None:
    """Publish a batch DataFrame to a Kafka topic (see :func:`kafka_columns`).  Needs the
    Kafka connector."""
    (kafka_columns(df, key, value, partition, timestamp)
       .write.format("kafka").option("kafka.bootstrap.servers", servers)
       .option("topic", topic).save())
