"""Trailing counts with state per (name, time slice), complete whatever the order of arrival.

Time is cut into slices (a quarter of the window by default).  A mention at
``s`` is one arrival in its own slice, one expiry at ``s + window`` in a later
slice, and one more live mention when each slice between them opens.  So the
changes of a (name, slice) and their counts need nothing but that slice's own
rows: its changes in time order on top of its opening count.

* :class:`SliceState` (``transformWithState``) keeps them per (name, slice): a
  list state that each batch only appends to, and one timer at the slice's end.  A name that carries a third of all rows is as many keys
  as it has slices, and what a batch writes is the batch's own rows.  When the
  watermark passes the slice's end the timer hands out all its changes, each
  once, and the state is gone.
* A row for a slice that has been handed out already is late.  Nothing is
  dropped: it goes, as it is, to the ``late`` part of the log.
* :func:`settled` is the exact change log: (name, slice) ranges that late rows
  touch, and those still open when the stream stops (read from the checkpoint by
  :func:`open_rows`), are derived again from their rows; every other range stays
  as it was handed out.  It knows no watermark: rows in any order give one log.

The log trades delay for that: a change appears once the watermark passes its
slice's end.  :func:`.trailing.trailing_hour_updates` emits at once and keeps
one state per name.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..session import state_store

# The processor runs in Python workers; ship it with the plan instead of
# requiring this package to be installed on every executor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOUR_US = 3_600_000_000

#: Kinds of rows: live mentions when the slice opens, arrivals, expiries.
OPENING, ARRIVAL, EXPIRY = -1, 0, 1

ROW_SCHEMA = "name string, slice long, kind int, ts_us long, n long"
LOG_SCHEMA = ROW_SCHEMA + ", count long, part string"

#: Mentions that a task groups at once before the shuffle.
COMBINE_ROWS = 1 << 18


def slices_per_window(window_us: int, slice_us: int | None) -> tuple[int, int]:
    """(slice length, slices per window)."""
    own = slice_us or window_us // 4
    if own <= 0 or window_us % own or own % 1000:
        raise ValueError("a slice must divide the window and be whole milliseconds")
    return own, window_us // own


def slice_rows(names: DataFrame, window_us: int = HOUR_US, slice_us: int | None = None) -> DataFrame:
    """(name, slice, kind, ts_us, n) rows of (name, timestamp) mentions, those of one
    instant, and the openings of one slice, added up within each task."""
    own, m = slices_per_window(window_us, slice_us)

    def combine(batches):
        import pyarrow as pa

        def rows(name, at, kind, ts, n):
            size = len(ts)
            return pa.RecordBatch.from_arrays(
                [name, pa.array(at), pa.array(np.full(size, kind, np.int32)), pa.array(ts), pa.array(n)],
                names=["name", "slice", "kind", "ts_us", "n"])

        def group(parts):
            g = pa.concat_tables(parts).group_by(["name", "ts_us"]).aggregate([([], "count_all")]).combine_chunks()
            ts, n = g["ts_us"].to_numpy(), g["count_all"].to_numpy()
            at = np.floor_divide(ts, own)
            name = pa.concat_arrays(g["name"].chunks) if g["name"].num_chunks else pa.array([], pa.string())
            yield rows(name, at, ARRIVAL, ts, n)
            later = ts + window_us
            yield rows(name, np.floor_divide(later, own), EXPIRY, later, -n)
            live = pa.table({"name": name, "at": at, "n": n}).group_by(["name", "at"]).aggregate([("n", "sum")])
            live = live.combine_chunks()
            who = pa.concat_arrays(live["name"].chunks) if live["name"].num_chunks else pa.array([], pa.string())
            first, total = live["at"].to_numpy(), live["n_sum"].to_numpy()
            for j in range(1, m + 1):
                yield rows(who, first + j, OPENING, (first + j) * own, total)

        parts, held = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(pa.Table.from_batches([batch]))
                held += batch.num_rows
            if held >= COMBINE_ROWS:
                yield from group(parts)
                parts, held = [], 0
        if parts:
            yield from group(parts)

    return names.select("name", F.unix_micros("timestamp").alias("ts_us")).mapInArrow(combine, ROW_SCHEMA)


class SliceState(StatefulProcessor):
    """State of one (name, slice); hands out its changes when the watermark passes its end.

    A call costs two requests to the state store, whatever its rows: what they add up to
    is appended to a list, and the timer is set."""

    def __init__(self, slice_us: int, closed_before_ms: int = 0):
        self.slice_us = slice_us
        # what an earlier query handed out (see :func:`handed_over`)
        self.closed_before_ms = closed_before_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "kind int, ts_us long, n long")

    def _end_ms(self, key) -> int:
        return (int(key[1]) + 1) * self.slice_us // 1000

    def _row(self, key, kind: int, ts_us: int, n: int, count: int | None, part: str) -> Row:
        return Row(name=key[0], slice=int(key[1]), kind=kind, ts_us=ts_us, n=n, count=count, part=part)

    @staticmethod
    def _summed(rows) -> list[tuple[int, int, int]]:
        """(ts_us, kind, n): openings first, then one change per instant and kind in order."""
        total: dict[tuple[int, int], int] = {}
        for kind, ts_us, n in rows:
            at = (ts_us, kind)
            total[at] = total.get(at, 0) + n
        return [(t, k, n) for (t, k), n in sorted(total.items(), key=lambda x: (x[0][1] != OPENING, x[0]))]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self._end_ms(key) <= max(timerValues.getCurrentWatermarkInMs(), self.closed_before_ms):
            for r in rows:
                yield self._row(key, r["kind"], r["ts_us"], r["n"], None, "late")
            return
        summed = self._summed((r["kind"], r["ts_us"], r["n"]) for r in rows)
        self.rows.appendList([(k, t, n) for t, k, n in summed])
        self.handle.registerTimer(self._end_ms(key))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.rows.appendValue((initialState["kind"], initialState["ts_us"], initialState["n"]))
        self.handle.registerTimer(self._end_ms(key))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        count = 0
        for ts_us, kind, n in self._summed(self.rows.get()):
            count += n
            # the opening count is part of the log: what is derived again stands on it
            yield self._row(key, kind, ts_us, n, count, "closed")
        self.rows.clear()

    def close(self) -> None:
        pass


def slice_log(names: DataFrame, window_us: int = HOUR_US, slice_us: int | None = None,
              watermark: str = "15 minutes", initial: DataFrame | None = None,
              closed_before_ms: int = 0) -> DataFrame:
    """The log stream of (name, timestamp) mentions: changes and openings of closed
    slices (``part`` closed, with their count) and late rows (``part`` late).

    The rows that reach the state carry no watermarked column, so that Spark hands on
    late ones instead of dropping them; the timers still follow the watermark.
    ``initial`` and ``closed_before_ms`` take on another query's state.  The query that
    writes it must be started within :func:`..session.state_store`, as
    :func:`start_slice_log` does."""
    own, _ = slices_per_window(window_us, slice_us)
    rows = slice_rows(names.withWatermark("timestamp", watermark), window_us, slice_us)
    return rows.groupBy("name", "slice").transformWithState(
        SliceState(own, closed_before_ms), LOG_SCHEMA, "append", "EventTime",
        initial.groupBy("name", "slice") if initial is not None else None)


def start_slice_log(names: DataFrame, path: str, checkpoint: str, window_us: int = HOUR_US,
                    slice_us: int | None = None, watermark: str = "15 minutes", trigger: dict | None = None,
                    initial: DataFrame | None = None, closed_before_ms: int = 0) -> StreamingQuery:
    """Write the log as parquet, one folder per part."""
    log = slice_log(names, window_us, slice_us, watermark, initial, closed_before_ms)
    writer = (log.writeStream.outputMode("append").format("parquet").partitionBy("part")
              .option("path", path).option("checkpointLocation", checkpoint))
    with state_store(names.sparkSession):
        return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def late_rows(log: DataFrame) -> DataFrame:
    """The late mentions: (name, ts_us, n)."""
    return log.where((F.col("part") == "late") & (F.col("kind") == ARRIVAL)).select("name", "ts_us", "n")


def open_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows of the slices that the stopped query with this checkpoint holds open, from its
    state through Spark's state data source."""
    state = spark.read.format("statestore").option("stateVarName", "rows").load(checkpoint)
    return state.select("key.name", "key.slice", "list_element.kind", "list_element.ts_us", "list_element.n")


def settled(log: DataFrame, still_open: DataFrame | None = None) -> DataFrame:
    """The whole change log (name, ts_us, kind, delta, count), exact for all rows the stream has
    read.  Only (name, slice) ranges with late or open rows are derived again, each on its
    own: the work follows those ranges."""
    rows = ["name", "slice", "kind", "ts_us", "n"]
    closed, late = log.where("part = 'closed'"), log.where("part = 'late'").select(rows)
    again = late if still_open is None else late.unionByName(still_open.select(rows))
    touched = again.select("name", "slice").distinct()
    kept = closed.where(F.col("kind") != OPENING).join(touched, ["name", "slice"], "left_anti")
    old = closed.join(touched, ["name", "slice"], "left_semi").select(rows)
    # openings lead their slice, whatever their time
    whole = old.unionByName(again).groupBy("name", "slice", "kind", F.when(
        F.col("kind") != OPENING, F.col("ts_us")).alias("ts_us")).agg(F.sum("n").alias("n"))
    order = Window.partitionBy("name", "slice").orderBy(F.col("ts_us").asc_nulls_first(), "kind") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    derived = whole.withColumn("count", F.sum("n").over(order)).where(F.col("kind") != OPENING)
    out = ["name", "ts_us", "kind", F.col("n").alias("delta"), "count"]
    return kept.select(*out).unionByName(derived.select(*out))


def handed_over(spark: SparkSession, checkpoint: str) -> tuple[DataFrame, int]:
    """(initial state, end of what it has handed out in ms) of a stopped query, for a new
    query that goes on from it -- with another number of state partitions, say, which a
    checkpoint itself can't change.  The new query's source must start where the old one's
    stopped, and its log goes on in the same folder."""
    import json
    files = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/*", wholetext=True) \
        .select(F.element_at(F.split(F.input_file_name(), "/"), -1).cast("long").alias("batch"), "value")
    last = files.orderBy(F.col("batch").desc()).first()  # one row: the last batch's offsets
    watermark = json.loads(last["value"].split("\n")[1])["batchWatermarkMs"] if last else 0
    return open_rows(spark, checkpoint), int(watermark)
