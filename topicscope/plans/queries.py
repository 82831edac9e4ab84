"""Registered queries over the driver's tables.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables.  ``gkg_like`` (see ``sources.gkg``) stands in for a record
file: it is derived from orders, lineitem and part once per input folder and
written as parquet (``gkg_like_table``), and the topic queries scan it the
way the report scans record files.  ``events`` drives the time-based family
with ``event_type`` as the name of the trailing counts and ``user_id`` as the
leaderboard name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import (decode_key_millis, decode_long, encode_long, is_blank,
                              java_split, nth_field, parse_record_key, split_all, strip_names)
from ..functions.time import (epoch_micros, epoch_millis, floor_div, format_day,
                              from_epoch_micros,
                              gkg_date_string, last_closed_segment, next_interval,
                              segment_file_name, segment_of, to_instant)
from ..operators import leaderboard as lb
from ..operators.sequence import index_within
from ..operators.topics import (as_json_lines, daily_top_topics, nest_by_day,
                                top_k_per_group, topic_day_counts, topic_mentions)
from .daily_job import daily_report
from ..operators.trailing import latest_per_tick, trailing_changelog, trailing_count
from ..schema import DEFAULT_LAST_KEY
from ..sources.gkg import (derived_path, gkg_like_lines, gkg_like_table, gkg_line_records, gkg_records,
                           gkg_tsv_path, read_gkg, read_lines)
from ..sources.segments import (after_high_water, catalogue_of_span, record_envelope,
                                record_lines, spread_event_time)
from ..session import scratch_path
from ..sinks.json import write_json_lines
from ..streaming.segment_log import last_key, publish
from ..sources.tables import load_table

# Fixed values used by the registered queries over the driver tables.
STOP_EQUALS = ("red plate",)
STOP_CONTAINS = ("plate",)
SENTENCE_SEPARATOR = "."
TICK_MICROS = 15 * 60 * 1_000_000

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark, sf_dir) -> DataFrame:
    return load_table(spark, sf_dir, "events")


def _records(spark, sf_dir) -> DataFrame:
    return gkg_like_table(spark, sf_dir).select("day", "all_names")


# --- scans ------------------------------------------------------------------

def gkg_scan(spark, sf_dir):
    return gkg_records(read_gkg(spark, gkg_tsv_path(spark, sf_dir)))


def gkg_line_scan(spark, sf_dir):
    return gkg_line_records(read_lines(spark, gkg_tsv_path(spark, sf_dir)))


# --- text functions ---------------------------------------------------------

def strip_names_q(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    return docs.select("doc_id", strip_names("text").alias("stripped"))


def _pieces(spark, sf_dir, arr_fn):
    docs = load_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(arr_fn(F.col("text"))).alias("pos", "piece")) \
               .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "piece")


def java_split_q(spark, sf_dir):
    return _pieces(spark, sf_dir, lambda c: java_split(c, SENTENCE_SEPARATOR))


def split_all_q(spark, sf_dir):
    return _pieces(spark, sf_dir, lambda c: split_all(c, SENTENCE_SEPARATOR))


def nonblank_topics(spark, sf_dir):
    return split_all_q(spark, sf_dir).where(~is_blank("piece"))


# --- topics -----------------------------------------------------------------

def topic_mentions_q(spark, sf_dir):
    return topic_mentions(_records(spark, sf_dir))


def stop_topic_equals(spark, sf_dir):
    return topic_mentions(_records(spark, sf_dir), stop_topics=STOP_EQUALS, match="equals")


def stop_topic_contains(spark, sf_dir):
    return topic_mentions(_records(spark, sf_dir), stop_topics=STOP_CONTAINS, match="contains")


def topic_day_counts_q(spark, sf_dir):
    return topic_day_counts(topic_mentions(_records(spark, sf_dir)))


def daily_top10(spark, sf_dir):
    return top_k_per_group(topic_day_counts_q(spark, sf_dir), "day", 10, "include")


def daily_top10_exact(spark, sf_dir):
    return top_k_per_group(topic_day_counts_q(spark, sf_dir), "day", 10, "cut")


def daily_top10_json(spark, sf_dir):
    return as_json_lines(nest_by_day(daily_top10(spark, sf_dir)))


def daily_report_files(spark, sf_dir):
    """The batch job end to end: record files -> one JSON object per day."""
    return as_json_lines(daily_report(spark, gkg_tsv_path(spark, sf_dir)))


def daily_top10_lines(spark, sf_dir):
    """The line-rule variant: positional fields, substring stop topic,
    exactly ten per day (ties broken by topic)."""
    records = gkg_line_records(read_lines(spark, gkg_tsv_path(spark, sf_dir)))
    return daily_top_topics(records, k=10, ties="cut", match="contains")


# --- time functions ---------------------------------------------------------

def format_day_q(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", format_day(gkg_date_string("o_orderdate")).alias("day_text"))


def parse_record_key_q(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders")
    key = F.concat(gkg_date_string("o_orderdate"), F.lit("-"), F.col("o_orderkey").cast("string"))
    k = parse_record_key(key)
    p = parse_record_key("o_orderpriority")
    return orders.select(
        "o_orderkey", key.alias("record_key"),
        decode_key_millis(key).alias("key_head"), k["a"].alias("key_a"), k["b"].alias("key_b"),
        decode_key_millis("o_orderpriority").alias("prio_head"),
        p["a"].alias("prio_a"), p["b"].alias("prio_b"))


def next_quarter(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", "ts", next_interval("ts", 15).alias("next_quarter"))


def last_closed_segment_q(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", "ts",
                                         last_closed_segment("ts", 15).alias("last_closed"))


# --- segments and records -----------------------------------------------------

def segment_catalogue_q(spark, sf_dir):
    return catalogue_of_span(_events(spark, sf_dir).select("ts"))


def _high_water(events: DataFrame):
    mid = events.agg(floor_div(F.min(epoch_micros("ts")) + F.max(epoch_micros("ts")), 2)
                     .alias("m"))
    return mid.select(segment_file_name(segment_of(from_epoch_micros("m"))).alias("hw"))


def segments_after_highwater(spark, sf_dir):
    ev = _events(spark, sf_dir)
    cat = catalogue_of_span(ev.select("ts"))
    return after_high_water(cat, _high_water(ev.select("ts")).scalar())


def _event_spread(spark, sf_dir):
    return spread_event_time(record_lines(_events(spark, sf_dir)))


def spread_event_time_q(spark, sf_dir):
    return _event_spread(spark, sf_dir)


def record_envelope_q(spark, sf_dir):
    return record_envelope(_event_spread(spark, sf_dir))


def last_record_key_q(spark, sf_dir):
    """The resume point of the events' record log (published once per input folder)."""
    def build(path: str) -> None:
        spread = _event_spread(spark, sf_dir)
        publish(spread.select("key", "value", "seq", to_instant("event_time").alias("timestamp"),
                              F.date_format("event_time", "yyyy-MM-dd").alias("segment")), path, order=["seq"])
    return last_key(spark, derived_path(spark, "record_log", "spread-v1", sf_dir, ("events",), build),
                    DEFAULT_LAST_KEY)


def segments_union(spark, sf_dir):
    gkg_lines = gkg_like_lines(gkg_like_table(spark, sf_dir)).select(
        F.substring_index("value", "\t", 1).alias("key"), "value")
    ev_lines = record_lines(_events(spark, sf_dir)).select(
        F.substring_index("value", "\t", 1).alias("key"), "value")
    return gkg_lines.unionByName(ev_lines)


def timestamp_sequence(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", epoch_millis("o_orderdate").alias("millis"))
    idx = index_within(orders, ["millis"], ["o_orderkey"])
    seq = (F.col("idx") + 1).cast("bigint")
    return idx.select("o_orderkey", "millis", seq.alias("seq"),
                      F.concat_ws("-", F.col("millis").cast("string"),
                                  seq.cast("string")).alias("log_key"))


# --- trailing hour ------------------------------------------------------------

def trailing_hour_count(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", F.col("event_type").alias("name"), "ts")
    return trailing_count(ev, "name", "ts")


def trailing_hour_changelog(spark, sf_dir):
    return trailing_changelog(_events(spark, sf_dir), "event_type", "ts", "event_id") \
        .withColumnRenamed("seq", "event_id")


def coalesce_latest(spark, sf_dir):
    return latest_per_tick(_events(spark, sf_dir), "event_type", "ts", "event_id",
                           TICK_MICROS)


# --- wire and file formats ----------------------------------------------------

def histogram_wire(spark, sf_dir):
    """Upserts as they go over the wire (8 big-endian bytes) and as they are read."""
    sent = _user_hist(_events(spark, sf_dir)).select("name", encode_long("count").alias("value"))
    return sent.select("name", F.hex("value").alias("payload"), decode_long("value").alias("count"))


def json_round_trip(spark, sf_dir):
    """The daily top-10 written as JSON lines and read back."""
    top = daily_top10(spark, sf_dir)
    path = scratch_path(spark, "json_checks", uuid.uuid4().hex)
    write_json_lines(top, path)
    return spark.read.schema(top.schema).json(path)


def tolerant_lines(spark, sf_dir):
    """Text lines with bytes that are not UTF-8, written and read back."""
    bad = F.unhex(F.lit("FF")).cast("string")
    lines = load_table(spark, sf_dir, "documents").where("source IS NOT NULL").select(
        F.concat(bad, F.col("doc_id").cast("string"), F.lit("\t"), bad, F.col("source"), bad).alias("value"))
    path = scratch_path(spark, "line_checks", uuid.uuid4().hex)
    lines.write.text(path)
    read = read_lines(spark, path, tolerant=True)
    return read.select(nth_field("value", 0).cast("bigint").alias("doc_id"),
                       nth_field("value", 1).alias("source"))


# --- leaderboard ------------------------------------------------------------------

def _user_hist(events: DataFrame) -> DataFrame:
    return lb.histogram(events.select(F.col("user_id").cast("string").alias("name")))


def top100_current(spark, sf_dir):
    return lb.top_n(_user_hist(_events(spark, sf_dir)))


def histogram_minimum(spark, sf_dir):
    return lb.minimum(top100_current(spark, sf_dir))


def _two_snapshots(spark, sf_dir):
    ev = _events(spark, sf_dir).select("user_id", F.col("ts").cast("date").alias("d"))
    span = ev.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    cut = span.select(F.date_add("lo", floor_div(F.datediff("hi", "lo"), 2).cast("int"))).scalar()
    earlier = lb.top_n(_user_hist(ev.where(F.col("d") <= cut)))
    later = lb.top_n(_user_hist(ev))
    return earlier, later


def top100_delta(spark, sf_dir):
    return lb.delta(*_two_snapshots(spark, sf_dir))


def snapshot_json(spark, sf_dir):
    snap = lb.snapshot(*_two_snapshots(spark, sf_dir))
    return snap.select("name", F.to_json(F.struct("name", "count")).alias("json"))


def delta_json(spark, sf_dir):
    return lb.json_message(top100_delta(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "gkg_scan": gkg_scan,
    "gkg_line_scan": gkg_line_scan,
    "strip_names": strip_names_q,
    "java_split": java_split_q,
    "split_all": split_all_q,
    "nonblank_topics": nonblank_topics,
    "topic_mentions": topic_mentions_q,
    "stop_topic_equals": stop_topic_equals,
    "stop_topic_contains": stop_topic_contains,
    "topic_day_counts": topic_day_counts_q,
    "daily_top10": daily_top10,
    "daily_top10_exact": daily_top10_exact,
    "daily_top10_json": daily_top10_json,
    "daily_report_files": daily_report_files,
    "daily_top10_lines": daily_top10_lines,
    "format_day": format_day_q,
    "parse_record_key": parse_record_key_q,
    "next_quarter": next_quarter,
    "last_closed_segment": last_closed_segment_q,
    "segment_catalogue": segment_catalogue_q,
    "segments_after_highwater": segments_after_highwater,
    "segments_union": segments_union,
    "record_envelope": record_envelope_q,
    "last_record_key": last_record_key_q,
    "spread_event_time": spread_event_time_q,
    "timestamp_sequence": timestamp_sequence,
    "trailing_hour_count": trailing_hour_count,
    "trailing_hour_changelog": trailing_hour_changelog,
    "coalesce_latest": coalesce_latest,
    "top100_current": top100_current,
    "histogram_minimum": histogram_minimum,
    "top100_delta": top100_delta,
    "snapshot_json": snapshot_json,
    "delta_json": delta_json,
    "histogram_wire": histogram_wire,
    "json_round_trip": json_round_trip,
    "tolerant_lines": tolerant_lines,
}


def _with_streams() -> None:
    from .streams import STREAM_QUERIES
    QUERIES.update(STREAM_QUERIES)


_with_streams()
