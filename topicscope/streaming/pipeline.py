"""The whole stream: records -> names -> trailing-hour counts -> leaderboard.

    q = start_topic_stream(spark, landing_records(spark, landing), root)
    ...
    current_set(spark, root); snapshot(spark, root); messages(spark, root)

``root`` is a folder under the shared checkpoint location; the query keeps its
offsets and RocksDB state under ``root/checkpoint`` and can be stopped and
restarted from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.leaderboard import CAPACITY
from ..session import scratch_path
from .feed import LeaderboardFeed
from .source import stream_names
from .trailing import HOUR_MS, running_total_updates, trailing_hour_updates


def start_topic_stream(spark: SparkSession, records: DataFrame, root: str | None = None,
                       trigger: dict | None = None, watermark: str = "15 minutes",
                       window_ms: int | None = HOUR_MS, capacity: int = CAPACITY,
                       query_name: str | None = None, resolution_us: int = 1,
                       combine: bool | None = None, ties: str = "members") -> StreamingQuery:
    """Start the streaming query.  ``trigger`` is passed to
    ``DataStreamWriter.trigger`` (default: one micro-batch per second).
    Without a window (None) the counts are those since the start.  ``ties``
    decides who of equal counts is in the set."""
    root = (root or scratch_path(spark, "topic_stream")).rstrip("/")
    names = stream_names(records)
    if window_ms is None:
        changes = running_total_updates(names)
    else:
        changes = trailing_hour_updates(names, window_ms, watermark,
                                        resolution_us=resolution_us, combine=combine)
    writer = (changes.writeStream
              .outputMode("update" if window_ms is None else "append")
              .option("checkpointLocation", f"{root}/checkpoint")
              .foreachBatch(LeaderboardFeed(root, capacity, ties=ties)))
    writer = writer.trigger(**(trigger or {"processingTime": "1 second"}))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def start_changelog_sink(spark: SparkSession, records: DataFrame, path: str, checkpoint: str,
                         trigger: dict | None = None, watermark: str = "15 minutes",
                         window_ms: int = HOUR_MS, resolution_us: int = 1,
                         combine: bool | None = None) -> StreamingQuery:
    """Write the raw changelog (every change with its count) as parquet."""
    changes = trailing_hour_updates(stream_names(records), window_ms, watermark,
                                    resolution_us=resolution_us, combine=combine)
    writer = (changes.writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def main(argv=None) -> None:
    """``python -m topicscope.streaming.pipeline <landing> <root>``: run the
    stream until stopped (or once over what is there with ``--once``)."""
    import argparse

    from ..session import build_session
    from .source import landing_records
    ap = argparse.ArgumentParser()
    ap.add_argument("landing")
    ap.add_argument("root")
    ap.add_argument("--files-per-trigger", type=int, default=1)
    ap.add_argument("--watermark", default="15 minutes")
    ap.add_argument("--capacity", type=int, default=CAPACITY)
    ap.add_argument("--once", action="store_true")
    ap.add_argument("--state-partitions", type=int,
                    help="state store partitions (the shuffle partitions of the "
                         "stateful step); fixed by the first run of a checkpoint, "
                         "default: the session's spark.sql.shuffle.partitions")
    args = ap.parse_args(argv)
    spark = build_session(shuffle_partitions=args.state_partitions)
    trigger = {"availableNow": True} if args.once else None
    q = start_topic_stream(spark, landing_records(spark, args.landing, args.files_per_trigger),
                           args.root, trigger=trigger, watermark=args.watermark,
                           capacity=args.capacity)
    q.awaitTermination()
    spark.stop()


if __name__ == "__main__":
    main()
