"""Registered queries that run the streaming operators end to end.

The events table is turned into 27-field records (the event type packed in
the name list, with the user id as its "offset").  They are published once per
input folder as a record log of one segment per day, and replayed in the
order of the segments, a few per micro-batch; or, to test rows in any order, as
parquet files that each cover the whole time range, read by the file source.
The call returns once the stream has drained, with a DataFrame over what it
wrote and what it still holds.  Each call keeps its stream checkpoint and
outputs in a fresh folder under the shared checkpoint location.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import from_epoch_micros, to_instant
from ..schema import ALL_NAMES_INDEX, GKG_COLUMNS
from ..session import input_bytes, scratch_path
from ..sources.gkg import derived_path
from ..sources.tables import load_table
from ..streaming.feed import snapshot
from ..streaming.pipeline import start_topic_stream
from ..streaming.segment_log import LOG_SCHEMA, publish, stream_log
from ..streaming.slices import HOUR_US, open_rows, read_log, settled, start_slice_log
from ..streaming.source import landing_records, stream_names
from ..streaming.trailing import open_sliding_hours, sliding_hour_counts

# The ordered replay: SEGMENTS_PER_BATCH days per micro-batch.
SEGMENTS_PER_BATCH = 8
LOG_PARTITIONS = 4
# The unordered one: at least LANDING_FILES files of about LANDING_FILE_BYTES of
# input each, FILES_PER_TRIGGER of them per micro-batch whatever their number.
LANDING_FILES = 8
LANDING_FILE_BYTES = 256 << 20
FILES_PER_TRIGGER = 2


def event_records(spark: SparkSession, sf_dir: str, name: str = "event_type", no_id: str | None = None) -> DataFrame:
    """(key, value, timestamp) records of the events table; ``name`` is the
    column that gives a record's name.  ``no_id`` is the first field of an event
    without an id; its record is a field short if that is None."""
    ev = load_table(spark, sf_dir, "events")
    value = F.col(name).cast("string")
    if name == "user_id":  # names lose their digits: letters stand for them
        value = F.translate(value, "0123456789", "abcdefghij")
    fields = []
    for i, _ in enumerate(GKG_COLUMNS):
        if i == 0:
            fields.append(F.coalesce(F.col("event_id").cast("string"), F.lit(no_id)))
        elif i == ALL_NAMES_INDEX:
            offset = F.coalesce(F.col("user_id").cast("string"), F.lit(""))
            fields.append(F.coalesce(F.concat(value, F.lit(","), offset),
                                     F.lit("")))
        else:
            fields.append(F.lit(""))
    return ev.select(F.col("event_id").cast("string").alias("key"),
                     F.concat_ws("\t", *fields).alias("value"),
                     to_instant("ts").alias("timestamp"))


def event_log(spark: SparkSession, sf_dir: str, name: str = "event_type") -> str:
    """The events' records as a log of one segment per day, once per input folder."""
    def build(path: str) -> None:
        records = event_records(spark, sf_dir, name).where("timestamp IS NOT NULL")
        day = F.date_format("timestamp", "yyyy-MM-dd")
        publish(records.select("key", "value", "timestamp", day.alias("segment"),
                               (F.col("key").cast("long") % LOG_PARTITIONS).cast("int").alias("partition")), path)
    return derived_path(spark, "stream_log", f"log-v1-{name}", sf_dir, ("events",), build)


def landing_files(size: int) -> int:
    """Number of landing files for an events table of ``size`` bytes."""
    return max(LANDING_FILES, -(-size // LANDING_FILE_BYTES))


def mixed_landing(spark: SparkSession, sf_dir: str) -> str:
    """The events' records in files that each cover the whole time range, once per input folder."""
    files = landing_files(input_bytes(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    return derived_path(
        spark, "stream_landing", "mixed-v2", sf_dir, ("events",),
        lambda p: event_records(spark, sf_dir, no_id="").where("timestamp IS NOT NULL")
        .repartition(files, "key").write.parquet(p))


def _replay(spark: SparkSession, sf_dir: str, root: str, name: str = "event_type") -> DataFrame:
    """The log as a stream, a few segments per micro-batch, oldest first."""
    return stream_log(spark, event_log(spark, sf_dir, name), f"{root}/checkpoint", SEGMENTS_PER_BATCH)


#: A replay runs batch after batch until the log is read.
AT_ONCE = {"processingTime": "0 seconds"}


def _run(query: StreamingQuery) -> None:
    """Until the source has nothing more and its last batch is done."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def _root(spark: SparkSession) -> str:
    return scratch_path(spark, "stream_checks", uuid.uuid4().hex)


def _changes(spark: SparkSession, records, root: str) -> DataFrame:
    _run(start_slice_log(stream_names(records), f"{root}/log", f"{root}/checkpoint", slice_us=HOUR_US, trigger=AT_ONCE))
    log = settled(read_log(spark, f"{root}/log"), open_rows(spark, f"{root}/checkpoint"))
    return log.select("name", from_epoch_micros("ts_us").alias("ts"), "delta", "count")


def stream_trailing_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole change log of the trailing hour from the stream: mentions that arrive
    and leave, with the count after each (name, ts, delta, count); those of a name at one
    instant are merged.  The slices still open at the end are drained from the state."""
    root = _root(spark)
    return _changes(spark, _replay(spark, sf_dir, root), root)


def stream_trailing_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing-hour count after every arrival, from the same log."""
    return stream_trailing_changelog(spark, sf_dir).where(F.col("delta") > 0)


def stream_trailing_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same change log from records in no order: the first micro-batch moves the
    watermark near the end, and most of the rows after it are late."""
    records = landing_records(spark, mixed_landing(spark, sf_dir), FILES_PER_TRIGGER)
    return _changes(spark, records, _root(spark))


def _totals_root(spark: SparkSession, sf_dir: str, name: str) -> str:
    root = f"{_root(spark)}/feed"
    _run(start_topic_stream(spark, _replay(spark, sf_dir, root, name), root, trigger=AT_ONCE,
                            window_ms=None, ties="name"))
    return root


def stream_snapshot_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaderboard feed over all-time counts: the snapshot of every name with
    its final count."""
    return snapshot(spark, _totals_root(spark, sf_dir, "event_type"))


def stream_top100_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaderboard feed over all-time counts of users, of which there are more than the set
    holds: its members with their counts, and every name that has left it, at 0."""
    return snapshot(spark, _totals_root(spark, sf_dir, "user_id"))


def stream_sliding_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions per name in sliding hours (1-minute steps) from the built-in windowed
    aggregation on the stream (per-minute counts, then their sum per hour window): the
    windows it has emitted, and those the watermark has not closed, from its state."""
    root = _root(spark)
    names = stream_names(_replay(spark, sf_dir, root))
    _run(sliding_hour_counts(names).writeStream.outputMode("append").format("parquet")
         .option("path", f"{root}/windows").option("checkpointLocation", f"{root}/checkpoint")
         .trigger(**AT_ONCE).start())
    w = spark.read.schema("start timestamp, end timestamp, name string, count long").parquet(f"{root}/windows") \
        .unionByName(open_sliding_hours(spark, f"{root}/checkpoint"))
    return w.select(from_epoch_micros(F.unix_micros("start")).alias("start"),
                    from_epoch_micros(F.unix_micros("end")).alias("end"), "name", "count")


def record_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record log read back as a stream: segment, partition, offset, key, value and event
    time of every record."""
    root = _root(spark)
    _run(_replay(spark, sf_dir, root).writeStream.outputMode("append").format("parquet")
         .option("path", f"{root}/records").option("checkpointLocation", f"{root}/checkpoint")
         .trigger(**AT_ONCE).start())
    rows = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/records")
    return rows.withColumn("timestamp", from_epoch_micros(F.unix_micros("timestamp")))


STREAM_QUERIES = {
    "stream_trailing_arrivals": stream_trailing_arrivals,
    "stream_trailing_changelog": stream_trailing_changelog,
    "stream_trailing_unordered": stream_trailing_unordered,
    "stream_snapshot_totals": stream_snapshot_totals,
    "stream_top100_totals": stream_top100_totals,
    "stream_sliding_hour": stream_sliding_hour,
    "record_log_stream": record_log_stream,
}
