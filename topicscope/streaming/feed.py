"""Leaderboard feed: the ``foreachBatch`` end of the stream.

For every micro-batch of trailing-count changes:

1. the last count per name in the batch is written to ``histogram/`` (the
   upsert feed, one folder per batch);
2. the bounded set of the previous batch and these updates give the next
   set and its changes in one bounded table (:func:`operators.leaderboard.step`),
   written to ``board/``: the members of the next set, the names that left it
   (count 0), and a ``changed`` flag for new or changed names and leavers;
3. the changed rows, as one JSON array per batch, go to ``messages/``.

A batch without upserts writes only its (empty) ``histogram/`` folder.

All outputs of batch ``b`` go to folders named by ``b`` and are overwritten
when a batch is re-run after a failure, so the feed is idempotent.  Nothing
is collected on the driver: the driver only lists folder names.  The full
snapshot (SNK8) is the last count per name over the changed rows of
``board/``, zeros of evicted names included; it is read on demand by
:func:`snapshot`.  Every ``compact_every`` batches the snapshot is written to
``base/`` and the boards it covers are deleted (the last ``keep_sets`` stay,
so a re-run batch finds its previous set), so reads touch one base and a
bounded number of boards.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import leaderboard as lb

BATCH_DIGITS = 20
# Known layouts: reading with a schema skips the footer-reading job.
HISTOGRAM_SCHEMA = "name string, count bigint"
BOARD_SCHEMA = "name string, count bigint, member boolean, changed boolean"


def _batch_dir(root: str, kind: str, batch_id: int) -> str:
    return f"{root}/{kind}/batch_id={batch_id:0{BATCH_DIGITS}d}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _committed_batches(spark: SparkSession, root: str, kind: str) -> list[int]:
    p, fs = _fs(spark, f"{root}/{kind}")
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("batch_id=") and fs.exists(
                st.getPath().suffix("/_SUCCESS")):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def _latest_committed(spark: SparkSession, root: str, kind: str,
                      below: int | None = None) -> int | None:
    """The newest committed batch folder of ``kind`` (before ``below``): one
    listing, then ``_SUCCESS`` checks newest first -- usually one -- instead of
    one per folder."""
    p, fs = _fs(spark, f"{root}/{kind}")
    if not fs.exists(p):
        return None
    ids = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("batch_id="):
            b = int(name.split("=", 1)[1])
            if below is None or b < below:
                ids.append((b, st.getPath()))
    for b, path in sorted(ids, key=lambda x: x[0], reverse=True):
        if fs.exists(path.suffix("/_SUCCESS")):
            return b
    return None


def _empty_set(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "name string, count bigint")


def _members(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    return (spark.read.schema(BOARD_SCHEMA).parquet(_batch_dir(root, "board", batch_id))
            .where(F.col("member")).select("name", "count"))


def previous_set(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The bounded set after the latest committed batch before ``batch_id``."""
    last = _latest_committed(spark, root, "board", below=batch_id)
    return _empty_set(spark) if last is None else _members(spark, root, last)


class LeaderboardFeed:
    """``foreachBatch`` callable maintaining the bounded set under ``root``
    (a folder in the shared checkpoint location)."""

    def __init__(self, root: str, capacity: int = lb.CAPACITY, keep_sets: int = 16,
                 kafka: dict | None = None, compact_every: int = 600, ties: str = "members"):
        """``ties``: who is in the set of those with equal counts (see
        :func:`operators.leaderboard.step`).  ``kafka`` = {"servers": .., "histogram_topic": .., "message_topic": ..}
        also publishes the upserts and the delta messages to Kafka."""
        self.root = root.rstrip("/")
        self.capacity = capacity
        self.keep_sets = keep_sets
        self.kafka = kafka
        self.compact_every = compact_every
        self.ties = ties

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # one call of the state function per name and batch; its last change
        # is the name's upsert -- a filter, no aggregation
        updates = batch.where(F.col("last")).select("name", "count")
        hist_dir = _batch_dir(self.root, "histogram", batch_id)
        # the number of upserts is observed during the write (no extra job)
        seen = Observation(f"feed_upserts_{batch_id}_{uuid.uuid4().hex}")
        (updates.observe(seen, F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").parquet(hist_dir))
        updates = spark.read.schema(HISTOGRAM_SCHEMA).parquet(hist_dir)
        # without upserts (a batch that only moved the watermark) the set and
        # the snapshot stay as they are; the next batch reads the last board
        if seen.get["n"] > 0:
            self._publish(spark, updates, batch_id)
        if self.compact_every and batch_id > 0 and batch_id % self.compact_every == 0:
            compact(spark, self.root, batch_id, self.keep_sets)

    def _publish(self, spark: SparkSession, updates: DataFrame, batch_id: int) -> None:
        prev = previous_set(spark, self.root, batch_id)
        board_dir = _batch_dir(self.root, "board", batch_id)
        lb.step(prev, updates, self.capacity, self.ties).write.mode("overwrite").parquet(board_dir)
        changes = (spark.read.schema(BOARD_SCHEMA).parquet(board_dir).where(F.col("changed"))
                   .select("name", "count"))
        msg_dir = _batch_dir(self.root, "messages", batch_id)
        (lb.json_message(changes).where(F.col("json") != "[]")
         .coalesce(1).write.mode("overwrite").json(msg_dir))
        if self.kafka:
            from ..functions.text import encode_long
            from ..sinks.json import write_kafka
            servers = self.kafka["servers"]
            write_kafka(updates, servers, self.kafka["histogram_topic"], "name",
                        encode_long("count"))
            msgs = spark.read.json(msg_dir)
            if "json" in msgs.columns:
                write_kafka(msgs.withColumn("k", F.lit(str(batch_id))), servers,
                            self.kafka["message_topic"], "k", F.col("json"))


def current_set(spark: SparkSession, root: str) -> DataFrame:
    last = _latest_committed(spark, root, "board")
    return _empty_set(spark) if last is None else _members(spark, root, last)


def _snapshot_from(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    root = root.rstrip("/")
    bases = _committed_batches(spark, root, "base")
    if upto is not None:
        bases = [b for b in bases if b <= upto]
    parts = []
    since = -1
    if bases:
        since = bases[-1]
        parts.append(spark.read.parquet(_batch_dir(root, "base", since))
                     .withColumn("batch_id", F.lit(since).cast("bigint")))
    boards = [b for b in _committed_batches(spark, root, "board")
              if b > since and (upto is None or b <= upto)]
    if boards:
        parts.append(spark.read.option("basePath", f"{root}/board")
                     .parquet(*[_batch_dir(root, "board", b) for b in boards])
                     .where(F.col("changed"))
                     .select("name", "count", F.col("batch_id").cast("bigint")))
    if not parts:
        return _empty_set(spark)
    log = parts[0]
    for p in parts[1:]:
        log = log.unionByName(p)
    return log.groupBy("name").agg(F.max_by("count", "batch_id").alias("count"))


def snapshot(spark: SparkSession, root: str, include_evicted: bool = True) -> DataFrame:
    """Every name the set has held, with its last count (0 once evicted)."""
    snap = _snapshot_from(spark, root)
    return snap if include_evicted else snap.where(F.col("count") > 0)


def compact(spark: SparkSession, root: str, batch_id: int, keep: int = 16) -> None:
    """Write the snapshot as of ``batch_id`` to ``base/`` (once: a re-run of
    the batch finds it committed) and drop the older bases and the boards it
    covers, except the last ``keep`` (at least one) before ``batch_id``
    (previous sets for re-runs and empty batches; the snapshot reader skips
    them)."""
    root = root.rstrip("/")
    if batch_id not in _committed_batches(spark, root, "base"):
        target = _batch_dir(root, "base", batch_id)
        _snapshot_from(spark, root, upto=batch_id).write.mode("overwrite").parquet(target)
    old_boards = [b for b in _committed_batches(spark, root, "board") if b < batch_id]
    # the latest board always stays: a batch without upserts writes none
    doomed = [("base", b) for b in _committed_batches(spark, root, "base") if b < batch_id]
    doomed += [("board", b) for b in old_boards[:max(len(old_boards) - max(keep, 1), 0)]]
    for kind, b in doomed:
        p, fs = _fs(spark, _batch_dir(root, kind, b))
        fs.delete(p, True)


def messages(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, json) delta messages in batch order."""
    return spark.read.json(f"{root.rstrip('/')}/messages").orderBy("batch_id")
