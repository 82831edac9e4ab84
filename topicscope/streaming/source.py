"""Streaming sources and the stateless part of the stream.

Records are (key, value, timestamp): the record id, the whole tab-separated
line and its event time.  They come from a landing folder of parquet files
written by the feeder, from a record log (:mod:`.segment_log`), or from a Kafka topic
when the Kafka connector is on the classpath.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import (decode_long, has_fields, is_blank, nth_field, split_all,
                              strip_names)
from ..schema import ALL_NAMES_INDEX, RECORD_SCHEMA
from ..sinks.json import EVENT_TIME_HEADER

KAFKA_FORMAT = "kafka"


def landing_records(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                    ) -> DataFrame:
    """Record stream from a folder of parquet files (new files are picked up
    once; the checkpoint remembers which were read)."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def _load_kafka(reader) -> DataFrame:
    try:
        return reader.load()
    except AnalysisException as exc:  # no such format: the connector is not on the classpath
        raise RuntimeError("the Kafka connector (spark-sql-kafka-0-10) is not available; "
                           "use landing_records() or add the package") from exc


def kafka_record_columns(raw: DataFrame) -> DataFrame:
    """(key, value, timestamp) of Kafka rows with headers: the event time is that of the
    header the writer adds, else the record's own time."""
    sent = F.filter("headers", lambda h: h["key"] == EVENT_TIME_HEADER)
    micros = decode_long(F.get(sent, 0)["value"])
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                      F.coalesce(F.timestamp_micros(micros), F.col("timestamp")).alias("timestamp"))


def kafka_records(spark: SparkSession, servers: str, topic: str,
                  starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Record stream from a Kafka topic: string key and value, event time."""
    reader = (spark.readStream.format(KAFKA_FORMAT)
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("includeHeaders", "true")
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return kafka_record_columns(_load_kafka(reader))


def kafka_histogram(spark: SparkSession, servers: str, topic: str,
                    starting_offsets: str = "latest") -> DataFrame:
    """Histogram upserts from Kafka: name key, value an 8-byte big-endian long."""
    raw = _load_kafka(spark.readStream.format(KAFKA_FORMAT)
                      .option("kafka.bootstrap.servers", servers)
                      .option("subscribe", topic)
                      .option("startingOffsets", starting_offsets))
    return raw.select(F.col("key").cast("string").alias("name"),
                      decode_long("value").alias("count"),
                      "timestamp")


def stream_names(records: DataFrame, min_fields: int = ALL_NAMES_INDEX + 1) -> DataFrame:
    """(key, name, timestamp): one row per non-blank name of a record.

    Stream rules: the line is split on every tab (empties kept) and dropped
    when it has 23 fields or fewer, the name list is split keeping empty
    pieces, and pieces a JVM ``trim`` would empty are removed.
    """
    v = F.col("value")
    names = split_all(strip_names(nth_field(v, ALL_NAMES_INDEX)), ";")
    # fields are located by counting tabs: no 27-element array per record
    return (records.where(has_fields(v, min_fields))
            .select("key", "timestamp", F.explode(names).alias("name"))
            .where(~is_blank("name")))
