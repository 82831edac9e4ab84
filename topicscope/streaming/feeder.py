"""Feeder: segment files -> timed records in a landing folder.

The rows of every segment file get event times spread over the segment
(:func:`sources.segments.spread_event_time`) and are written as (key, value,
timestamp) parquet files that the record stream picks up.  Pacing is left to
the stream trigger (``maxFilesPerTrigger`` with a processing-time trigger):
the event time already carries the spacing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import drop_malformed
from ..functions.time import to_instant
from ..sources.segments import spread_event_time


def segment_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file_name, value, block, seq): every line of the segment files, blank ones
    too.  Line order in a file is (block, seq): the start of the split a line was
    read from, and its place in that split, whatever the record keys say."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.text(paths)
            .select(F.col("_metadata.file_name").alias("file_name"),
                    drop_malformed("value").alias("value"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("seq")))


def timed_records(lines: DataFrame) -> DataFrame:
    """(key, value, timestamp) with spread event times (an instant, UTC)."""
    spread = spread_event_time(lines, order=("block", "seq"))
    return spread.select("key", "value", to_instant("event_time").alias("timestamp"))


def publish_segment_once(spark: SparkSession, path: str, landing: str) -> bool:
    """Publish one segment file as ``<landing>/<file name>.parquet`` exactly
    once.  The records are written to a hidden staging folder and the single
    result file is renamed into place only if that name is still free, so a
    re-run after a failure neither duplicates nor loses records.  Returns
    False when the segment was already published.  (A 15-minute segment is
    small, so one output file per segment is one task.)"""
    import uuid

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    name = path.rstrip("/").rsplit("/", 1)[-1]
    target = jvm.org.apache.hadoop.fs.Path(f"{landing.rstrip('/')}/{name}.parquet")
    fs = target.getFileSystem(conf)
    if fs.exists(target):
        return False
    staging = f"{landing.rstrip('/')}/_staging/{name}-{uuid.uuid4().hex}"
    timed_records(segment_lines(spark, path)).coalesce(1).write.parquet(staging)
    parts = [st.getPath() for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(staging))
             if st.getPath().getName().startswith("part-")]
    moved = bool(parts) and fs.rename(parts[0], target)
    fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
    return moved


# --- scheduled pick-up of new segments ---------------------------------------

def _read_high_water(spark: SparkSession, state: str, default: str) -> str:
    from ..session import path_exists
    if not path_exists(spark, f"{state}/_SUCCESS"):
        return default
    row = spark.read.parquet(state).agg(F.max("file_name")).first()
    return row[0] if row and row[0] else default


def feed_new_segments(spark: SparkSession, segments_root: str, landing: str, state: str,
                      window_minutes: int = 60, now=None,
                      start_after: str = "20150218230000") -> list[str]:
    """List the segments of the last ``window_minutes`` before ``now`` (UTC,
    default: the current time), keep those after the high-water mark stored in
    ``state`` that exist under ``segments_root``, publish each one exactly
    once to ``landing`` (oldest first).  The mark follows them up to the first
    segment of the window that is not there yet, so one that arrives late is
    still taken while the window covers it.  Returns the file names taken.

    The catalogue holds ``window_minutes / 15`` names, the only values brought
    to the driver (a reader needs its path list)."""
    import datetime as dt

    from ..session import path_exists
    from ..sources.segments import after_high_water, segment_catalogue
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    high = _read_high_water(spark, state, start_after)
    cat = after_high_water(segment_catalogue(spark, now, window_minutes), high)
    names = [r["file_name"] for r in cat.orderBy("file_name").collect()]
    root = segments_root.rstrip("/")
    taken, gap = [], False
    for n in names:                        # oldest first
        if not path_exists(spark, f"{root}/{n}"):
            gap = True
            continue
        if publish_segment_once(spark, f"{root}/{n}", landing):
            taken.append(n)
        if not gap:
            spark.createDataFrame([(n,)], "file_name string").write.mode("overwrite").parquet(state)
    return taken


def main(argv=None) -> None:
    """``python -m topicscope.streaming.feeder <segments_root> <landing> <state>``"""
    import argparse

    from ..session import build_session
    ap = argparse.ArgumentParser(description=feed_new_segments.__doc__)
    ap.add_argument("segments_root")
    ap.add_argument("landing")
    ap.add_argument("state")
    ap.add_argument("--window", type=int, default=60)
    ap.add_argument("--now")
    args = ap.parse_args(argv)
    spark = build_session()
    taken = feed_new_segments(spark, args.segments_root, args.landing, args.state,
                              args.window, args.now)
    print("published:", ", ".join(taken) or "nothing new")
    spark.stop()


if __name__ == "__main__":
    main()
