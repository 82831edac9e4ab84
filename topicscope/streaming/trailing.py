"""Trailing-hour count per name on a stream.

Exact form (:func:`trailing_hour_updates`): a grouped state function keyed by
name.  The state of a name is the distinct arrival times still inside the
window (microseconds) with how many mentions arrived at each, packed as
int64 bytes, and the current total.  For every batch the arrivals of the name are handled in time order:
entries more than one window older than the arrival leave first (-), then the
arrival is added (+).  At the end of the call, and whenever the event-time
timeout fires, entries more than a window older than the watermark leave.
The timeout is re-armed at ``oldest + window``.  A call is one vectorised
merge of arrivals and leaving entries (:func:`advance`), not a loop over
arrivals.  Every change is emitted as
(name, ts_us, delta, count, ord, last); ``ord`` numbers the changes of one
call and ``last`` marks its final one.  A name is handled by one call per
micro-batch, so the rows with ``last`` are the batch's upserts.

Mentions of the same name and instant are merged into one change with
their number as delta, which keeps the state per name bounded by distinct
instants, not by mentions.

Scalable approximate form (:func:`sliding_hour_counts`): built-in windowed
aggregation, minute buckets summed over a sliding hour.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.time import floor_div

# The state function runs in Python workers; ship it with the plan instead of
# requiring this package to be installed on every executor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOUR_MS = 3_600_000

CHANGE_SCHEMA = "name string, ts_us long, delta long, count long, ord long, last boolean"
# The live instants and their counts are stored packed (little-endian int64
# bytes): one byte copy each way between Python and the state store, where
# arrays of boxed longs cost time in proportion to a hot name's state.
STATE_SCHEMA = "times binary, counts binary, total long"
STATE_DTYPE = np.dtype("<i8")


NO_BOUND = -(1 << 62)


def advance(times, counts, total: int, arr_t, arr_n, watermark_us: int, window_us: int):
    """One call of the state function, vectorised.

    ``times``/``counts`` are the live entries (sorted distinct instants, in
    microseconds), ``arr_t``/``arr_n`` this call's arrivals (sorted distinct
    instants).  Arrivals at an instant that is already live are merged into
    its entry.  An entry leaves, with ``-count`` at ``time + window``, before
    the first arrival strictly later than that, or at the end of the call
    when ``time + window`` is below the watermark -- so the changes are the
    arrivals and the leaving entries merged in time order (an arrival first
    at equal times), and each change's count is a running total.

    Returns the entries left, the new total and the changes (time, delta,
    count) in order.  Cost: sorting the live entries and arrivals once per
    call, whatever the number of arrivals.
    """
    t = np.concatenate([times, arr_t])
    c = np.concatenate([counts, arr_n])
    if len(arr_t) and len(times):
        t, inv = np.unique(t, return_inverse=True)
        c = np.bincount(inv, weights=c, minlength=len(t)).astype(np.int64)
    bound = max(int(arr_t[-1]) if len(arr_t) else NO_BOUND, watermark_us)
    k = int(np.searchsorted(t, bound - window_us, side="left"))   # t + window < bound
    ev_t = np.concatenate([arr_t, t[:k] + window_us])
    ev_d = np.concatenate([arr_n, -c[:k]])
    kind = np.concatenate([np.zeros(len(arr_t), np.int8), np.ones(k, np.int8)])
    order = np.lexsort((kind, ev_t))
    ev_t, ev_d = ev_t[order], ev_d[order]
    run = total + np.cumsum(ev_d)
    new_total = int(run[-1]) if len(run) else total
    return t[k:], c[k:], new_total, ev_t, ev_d, run


def _arrivals(pdfs: Iterator[pd.DataFrame]):
    """Sorted distinct instants of the call's rows and the mentions at each
    (numpy: a call often holds a handful of rows, where a pandas group-by
    costs over ten times more)."""
    ts_parts, n_parts = [], []
    for pdf in pdfs:
        ts_parts.append(pdf["ts_us"].to_numpy(np.int64))
        n_parts.append(pdf["n"].to_numpy(np.int64) if "n" in pdf.columns   # combined rows
                       else np.ones(len(pdf), np.int64))
    if not ts_parts or not sum(len(t) for t in ts_parts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ts, inv = np.unique(np.concatenate(ts_parts), return_inverse=True)
    n = np.bincount(inv, weights=np.concatenate(n_parts), minlength=len(ts))
    return ts, n.astype(np.int64)


def make_trailing_fn(window_ms: int = HOUR_MS):
    window_us = window_ms * 1000

    def trailing(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        name = key[0]
        if state.exists:
            times, counts, total = state.get
            times = np.frombuffer(times, STATE_DTYPE).astype(np.int64)
            counts = np.frombuffer(counts, STATE_DTYPE).astype(np.int64)
            total = int(total)
        else:
            times, counts, total = np.empty(0, np.int64), np.empty(0, np.int64), 0
        if state.hasTimedOut:
            arr_t, arr_n = np.empty(0, np.int64), np.empty(0, np.int64)
        else:
            arr_t, arr_n = _arrivals(pdfs)
        wm = state.getCurrentWatermarkMs()
        wm_us = wm * 1000 if wm and wm > 0 else NO_BOUND
        times, counts, total, ev_t, ev_d, run = advance(times, counts, total, arr_t, arr_n,
                                                        wm_us, window_us)
        if len(times):
            state.update((times.astype(STATE_DTYPE).tobytes(),
                          counts.astype(STATE_DTYPE).tobytes(), total))
            # fires once the watermark passes the oldest entry's expiry
            state.setTimeoutTimestamp(max(int(times[0]) + window_us, 1000) // 1000)
        else:
            state.remove()
        n = len(ev_t)
        if n:
            last = np.zeros(n, bool)
            last[-1] = True
            yield pd.DataFrame({"name": [name] * n, "ts_us": ev_t, "delta": ev_d,
                                "count": run, "ord": np.arange(n, dtype=np.int64),
                                "last": last})
    return trailing


COMBINED_SCHEMA = "name string, ts_us long, n long"


#: Mentions that the combine holds before it hands on what it has counted.
COMBINE_ROWS = 1 << 18


def _combine_partition(batches):
    """Partial counts (name, instant, n): every run of ``COMBINE_ROWS`` mentions is
    grouped once and handed on.  The counts of an instant are summed again
    behind the shuffle, so the work is linear and the memory bounded."""
    import pyarrow as pa

    def group(parts):
        g = pa.concat_tables(parts).group_by(["name", "ts_us"]).aggregate([([], "count_all")])
        return pa.table({"name": g["name"], "ts_us": g["ts_us"], "n": g["count_all"]}).to_batches()

    parts, rows = [], 0
    for rb in batches:
        if rb.num_rows == 0:
            continue
        parts.append(pa.Table.from_batches([rb]).select(["name", "ts_us"]))
        rows += rb.num_rows
        if rows >= COMBINE_ROWS:
            yield from group(parts)
            parts, rows = [], 0
    if parts:
        yield from group(parts)


def trailing_hour_updates(names: DataFrame, window_ms: int = HOUR_MS,
                          watermark: str = "15 minutes", mode: str = "append",
                          resolution_us: int = 1, combine: bool | None = None) -> DataFrame:
    """Changelog stream (name, ts, delta, count, ord) of trailing counts.

    ``names`` has (name, timestamp).  Rows later than the watermark delay are
    dropped by Spark; a larger delay accepts later rows and expires later.
    Every change is emitted once, so the stream is append-only.

    ``resolution_us`` floors arrival times before they reach the state (1 =
    exact).  The state of a name holds at most ``window / resolution``
    instants, which bounds it for very frequent names (e.g. 1 second: at most
    3,600 entries per name); mentions then leave in whole resolution steps.

    ``combine`` (default on) collapses each input partition to one row per
    (name, instant) before the shuffle to the state function -- the map-side
    combine of this stream -- so a name that carries a large share of a
    micro-batch sends at most one row per instant and ``COMBINE_ROWS`` mentions (a record that
    repeats a name is one row; at a coarser resolution, one row per step).
    """
    combine = True if combine is None else combine
    ts_us = floor_div(F.unix_micros("timestamp"), resolution_us) * resolution_us
    if combine:
        ev = (names.select("name", ts_us.alias("ts_us"))
              .mapInArrow(_combine_partition, COMBINED_SCHEMA)
              .withColumn("timestamp", F.timestamp_micros("ts_us"))
              .withWatermark("timestamp", watermark))
    else:
        ev = (names.select("name", "timestamp")
              .withWatermark("timestamp", watermark)
              .withColumn("ts_us", ts_us))
    changes = ev.groupBy("name").applyInPandasWithState(
        make_trailing_fn(window_ms), CHANGE_SCHEMA, STATE_SCHEMA, mode,
        GroupStateTimeout.EventTimeTimeout)
    return changes.select("name", F.timestamp_micros("ts_us").alias("ts"), "ts_us",
                          "delta", "count", "ord", "last")


def running_total_updates(names: DataFrame) -> DataFrame:
    """(name, count, last) of every name that a micro-batch mentions: its count
    since the start.  Built-in aggregation in update mode: the state of a name
    is one count, whatever the number of its mentions; rows are never late."""
    return (names.groupBy("name").agg(F.count(F.lit(1)).alias("count"))
            .withColumn("last", F.lit(True)))


def sliding_hour_counts(names: DataFrame, watermark: str = "15 minutes",
                        step: str = "1 minute", window: str = "1 hour") -> DataFrame:
    """Mentions per name over a sliding hour in ``step`` increments, with
    built-in state: per-step counts (partial aggregation on the map side),
    then a sliding sum over their window times.  Append mode emits a window
    once the watermark has passed its end."""
    per_step = (names.withWatermark("timestamp", watermark)
                .groupBy(F.window("timestamp", step).alias("w"), "name")
                .agg(F.count(F.lit(1)).alias("n")))
    return (per_step
            .groupBy(F.window(F.window_time("w"), window, step).alias("hour"), "name")
            .agg(F.sum("n").alias("count"))
            .select(F.col("hour.start").alias("start"), F.col("hour.end").alias("end"),
                    "name", "count"))


def open_sliding_hours(spark: SparkSession, checkpoint: str, step: str = "1 minute",
                       window: str = "1 hour") -> DataFrame:
    """(start, end, name, count) of the windows that a stopped :func:`sliding_hour_counts`
    query has not emitted yet: the sums its second aggregate holds and the steps its first
    one does, both read from the checkpoint's state store."""
    micros = lambda text: F.expr(f"CAST(INTERVAL '0' SECOND + INTERVAL {text} AS INTERVAL SECOND)")
    parts = []
    for operator in (0, 1):
        state = spark.read.format("statestore").option("operatorId", str(operator)).load(checkpoint)
        span, name = state.schema["key"].dataType.names
        count = state.schema["value"].dataType.names[0]
        parts.append(state.select(F.col(f"key.`{span}`").alias("w"), F.col(f"key.`{name}`").alias("name"),
                                  F.col(f"value.`{count}`").alias("n")))
    rows = parts[0].unionByName(parts[1]).withColumn("own", F.col("w.end") - F.col("w.start"))
    hours = rows.where(F.col("own") != micros(step)).select(F.col("w.start").alias("start"), "name", "n")
    steps = rows.where(F.col("own") == micros(step)).select(
        F.explode(F.sequence(F.col("w.end") - F.expr(f"INTERVAL {window}"), F.col("w.start"),
                             F.expr(f"INTERVAL {step}"))).alias("start"), "name", "n")
    return hours.unionByName(steps).groupBy("start", "name").agg(F.sum("n").alias("count")).select(
        "start", (F.col("start") + F.expr(f"INTERVAL {window}")).alias("end"), "name", "count")
