"""Segment files: catalogue, incremental pick-up, event-time spreading and the
record envelope the stream consumes.

Records arrive in 15-minute segment files named ``yyyyMMddHHmm00.gkg.csv``.
The feeder lists the segments of a time window, takes only those after the
last one it handled, gives the rows of each file event times spread evenly
over the segment, and publishes (key, value, timestamp) records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import FIELD_SEPARATOR, first_field
from ..functions.time import (MICROS_PER_MINUTE, epoch_micros, floor_div, from_epoch_micros,
                              key_start, last_closed_segment, segment_file_name,
                              segment_of, segment_stamp)
from ..operators.sequence import index_within
from ..schema import DEFAULT_LAST_KEY, SEGMENT_MINUTES


def _interval(minutes: int) -> Column:
    return F.expr(f"INTERVAL {int(minutes)} MINUTES")


def catalogue_columns(now: Column, window_minutes: Column | int,
                      minutes: int = SEGMENT_MINUTES) -> Column:
    """Array of segment starts for the ``window_minutes`` before ``now``,
    ending with the last closed segment (empty when the window is shorter
    than one segment)."""
    last = last_closed_segment(now, minutes)
    window = window_minutes if isinstance(window_minutes, Column) else F.lit(window_minutes)
    first = F.timestamp_add("MINUTE", (F.lit(minutes) - window).cast("int"), last)
    return F.when(first <= last, F.sequence(first, last, _interval(minutes))) \
            .otherwise(F.array().cast("array<timestamp_ntz>"))


def segment_catalogue(spark: SparkSession, now, window_minutes: int = 60,
                      minutes: int = SEGMENT_MINUTES) -> DataFrame:
    """(segment_start, file_name) for a literal ``now`` (a datetime or an
    ISO string, UTC)."""
    now_col = F.lit(str(now)).cast("timestamp_ntz")
    return (spark.range(1)
            .select(F.explode(catalogue_columns(now_col, window_minutes, minutes))
                    .alias("segment_start"))
            .select("segment_start", segment_file_name("segment_start").alias("file_name")))


def catalogue_of_span(times: DataFrame, ts: str = "ts",
                      minutes: int = SEGMENT_MINUTES) -> DataFrame:
    """Catalogue whose "now" is the latest time in ``times`` and whose window
    reaches back to the segment of the earliest one: the files a replay of
    the whole table would list."""
    span = times.agg(F.max(ts).alias("now"), F.min(ts).alias("lo"))
    last = last_closed_segment(F.col("now"), minutes)
    window = floor_div(epoch_micros(last) - epoch_micros(segment_of(F.col("lo"), minutes)),
                       MICROS_PER_MINUTE) + minutes
    return (span.select(F.explode(catalogue_columns(F.col("now"), window, minutes))
                        .alias("segment_start"))
            .select("segment_start", segment_file_name("segment_start").alias("file_name")))


def after_high_water(catalogue: DataFrame, high_water: Column | str) -> DataFrame:
    """Segments whose file name sorts after the last one handled."""
    hw = high_water if isinstance(high_water, Column) else F.lit(high_water)
    return catalogue.where(F.col("file_name") > hw)


def record_lines(events: DataFrame, minutes: int = SEGMENT_MINUTES) -> DataFrame:
    """Event rows as record lines of their segment file.

    The record key is ``<segment stamp>-<event id>``, the first field of the
    line; the other fields are the event's type, user and properties.
    """
    seg = segment_of("ts", minutes)
    key = F.concat(segment_stamp(seg), F.lit("-"), F.col("event_id").cast("string"))
    line = F.concat_ws(FIELD_SEPARATOR, key, F.col("event_type"),
                       F.col("user_id").cast("string"), F.coalesce(F.col("props"), F.lit("")))
    return events.select(segment_file_name(seg).alias("file_name"), line.alias("value"),
                         F.col("event_id").alias("seq"))


def spread_event_time(lines: DataFrame, minutes: int = SEGMENT_MINUTES,
                      order: Sequence[str] = ("seq",)) -> DataFrame:
    """Give the rows of every file times spread evenly over its segment.

    Row ``i`` (0-based, in line order) of a file with ``n`` lines gets
    ``start + i * floor(segment_ms / n)`` milliseconds, ``start`` being the
    first 12 digits (``yyyyMMddHHmm``, UTC) of the first line's key, or of the
    file's name if that line has no such key.  Input: (file_name, value, seq);
    line order is ``order``.
    """
    keyed = lines.withColumn("key", first_field("value"))
    idx = index_within(keyed, ["file_name"], list(order) + ["key"], block_on=list(order),
                       index_col="line_index", size_col="n_lines", first_of=["key"])
    step_ms = floor_div(F.lit(minutes * 60_000).cast("bigint"), F.col("n_lines"))
    start_us = epoch_micros(F.coalesce(key_start("first_key"), key_start("file_name")))
    event_us = start_us + F.col("line_index") * step_ms * 1000
    return idx.select("file_name", "key", "value", "seq", "line_index", "n_lines",
                      from_epoch_micros(event_us).alias("event_time"))


def record_envelope(spread: DataFrame, partition: int | None = None) -> DataFrame:
    """(key, value, timestamp, partition) records ready to publish; without a
    partition (null) the sink deals them out by their keys."""
    return spread.select(first_field("value").alias("key"), "value",
                         F.col("event_time").alias("timestamp"),
                         F.lit(partition).cast("int").alias("partition"))


def last_record_key(records: DataFrame, default: str = DEFAULT_LAST_KEY) -> DataFrame:
    """Key of the latest record (by timestamp, then sequence), or the default
    starting key when there is none."""
    last = F.max_by("key", F.struct("timestamp", "seq"))
    return records.agg(F.coalesce(last, F.lit(default)).alias("last_key"))
