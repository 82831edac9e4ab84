"""Trailing-window counts per name, batch form.

A mention at time ``s`` counts for name ``n`` at every time ``t`` with
``s <= t <= s + window`` (an age of exactly one window still counts, one
microsecond more does not).

Every mention becomes two changes: +1 at its time and -1 one window later.
The changes are partitioned by (name, bucket of the change's time), with
buckets of ``bucket`` microseconds (by default a quarter of the window), never
by the name alone, so a name that carries a third of the data -- even inside
one hour -- is spread over as many tasks as it has buckets.  Inside a
partition the count is a running total (a running frame keeps no rows in
memory) on top of the bucket's opening count: the mentions of the ``m =
window / bucket`` buckets before it, all still live when it opens.  Those
come from a small table of arrivals per (name, bucket) -- a partial
aggregate, each row added to the next ``m`` buckets -- joined back on (name,
bucket), where the changes are already partitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import MICROS_PER_HOUR, epoch_micros, floor_div, from_epoch_micros

HOUR = MICROS_PER_HOUR


def _buckets_per_window(window_micros: int, bucket_micros: int | None) -> tuple[int, int]:
    # default: a quarter of the window (the whole window if it does not split)
    bucket = bucket_micros or (window_micros // 4 if window_micros % 4 == 0 else window_micros)
    if bucket <= 0 or window_micros % bucket:
        raise ValueError("the bucket must divide the window")
    return bucket, window_micros // bucket


def _key(name: str):
    """The name wrapped in a struct: equal for two nulls, so rows without a
    name join their own opening counts (an equi-join never matches null)."""
    return F.struct(F.col(name).alias("n")).alias("__key")


def _opening_counts(us_rows: DataFrame, bucket: int, m: int) -> DataFrame:
    """(__key, __b, __open): mentions live when bucket ``__b`` opens, i.e. the
    arrivals of buckets ``__b - m`` .. ``__b - 1``.  One row per (name,
    bucket) with arrivals, spread to the next ``m`` buckets, then summed."""
    per_bucket = (us_rows.groupBy("__key", floor_div("__us", bucket).alias("__a"))
                  .agg(F.count(F.lit(1)).alias("__n")))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(m))).alias("__j")
    return (per_bucket.select("__key", "__a", "__n", ahead)
            .groupBy("__key", (F.col("__a") + F.col("__j")).alias("__b"))
            .agg(F.sum("__n").cast("bigint").alias("__open")))


def _with_opening(changes: DataFrame, opening: DataFrame, running) -> DataFrame:
    return (changes.join(opening, ["__key", "__b"], "left")
            .withColumn("count", (F.coalesce(F.col("__open"), F.lit(0)) + running)
                        .cast("bigint"))
            .drop("__open"))


def trailing_count(df: DataFrame, name: str, ts: str, window_micros: int = HOUR,
                   out: str = "count", bucketed: bool = True,
                   bucket_micros: int | None = None) -> DataFrame:
    """Add ``out`` = mentions of the row's name in ``[ts - window, ts]``,
    equal-time rows included (``RANGE BETWEEN window PRECEDING AND CURRENT ROW``).

    The bucketed form does not use a sliding frame (Spark keeps the rows of a
    sliding frame in memory, which for a busy name is every mention of an
    hour): the running ``sum`` of the changes over ``RANGE UNBOUNDED
    PRECEDING`` ordered by (time, kind) -- all arrivals of the same instant
    are peers and are counted, the expiries of that instant sort after them --
    plus the bucket's opening count.  Rows without a time only count their
    peers.
    """
    us = epoch_micros(ts)
    if not bucketed:
        w = Window.partitionBy(name).orderBy("__us").rangeBetween(-window_micros, 0)
        return (df.withColumn("__us", us)
                .withColumn(out, F.count(F.lit(1)).over(w)).drop("__us"))
    bucket, m = _buckets_per_window(window_micros, bucket_micros)
    payload = [c for c in df.columns if c != name]
    base = df.select(_key(name), us.alias("__us"), *payload)
    arrival = F.struct(F.lit(0).alias("k"), F.lit(1).alias("delta"))
    expiry = F.struct(F.lit(1).alias("k"), F.lit(-1).alias("delta"))
    variants = F.when(F.col("__us").isNull(), F.array(arrival)) \
                .otherwise(F.array(arrival, expiry))
    ev = base.select("__key", "__us", F.explode(variants).alias("v"), *payload)
    own = F.col("v.k") == 0
    t = F.col("__us") + F.col("v.k") * F.lit(window_micros)
    ev = ev.select("__key", t.alias("__t"), floor_div(t, bucket).alias("__b"),
                   F.col("v.k").alias("__k"), F.col("v.delta").alias("__d"),
                   own.alias("__self"),
                   *[F.when(own, F.col(c)).alias(c) for c in payload])
    w = (Window.partitionBy("__key", "__b").orderBy("__t", "__k")
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    opening = _opening_counts(base.where(F.col("__us").isNotNull()), bucket, m)
    counted = _with_opening(ev.withColumn("__run", F.sum("__d").over(w)).where("__self"),
                            opening, F.col("__run"))
    return counted.select(*[F.col("__key.n").alias(name) if c == name else F.col(c)
                            for c in df.columns], F.col("count").alias(out))


def _changes(df: DataFrame, name: str, ts: str, seq: str, window_micros: int,
             bucket_micros: int | None):
    """Changes (arrival +1, expiry -1) with their count, still carrying the
    bucket columns, and the window that orders them inside a bucket."""
    bucket, m = _buckets_per_window(window_micros, bucket_micros)
    us = epoch_micros(ts)
    base = (df.select(_key(name), us.alias("__us"), F.col(seq).alias("seq"))
            .where(F.col("__us").isNotNull()))
    variants = F.array(F.struct(F.lit(0).alias("k"), F.lit(1).alias("delta")),
                       F.struct(F.lit(1).alias("k"), F.lit(-1).alias("delta")))
    ev = base.select("__key", "__us", "seq", F.explode(variants).alias("v"))
    t = F.col("__us") + F.col("v.k") * F.lit(window_micros)
    ev = ev.select("__key", "seq", t.alias("__t"), floor_div(t, bucket).alias("__b"),
                   F.col("v.k").alias("__k"), F.col("v.delta").alias("delta"))
    order = Window.partitionBy("__key", "__b").orderBy("__t", "__k", "seq")
    run = F.sum("delta").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ev.withColumn("__run", run), order, _opening_counts(base, bucket, m)


def trailing_changelog(df: DataFrame, name: str, ts: str, seq: str,
                       window_micros: int = HOUR,
                       bucket_micros: int | None = None) -> DataFrame:
    """Every change of the trailing count: (name, ts, seq, delta, count).

    An arrival adds +1 at its time; it leaves with -1 at ``time + window``,
    after the arrivals of that same instant.  Changes are ordered by (time,
    arrival before expiry, seq) and ``count`` is the running total.  Rows
    without a time are left out.

    Running totals normally need the whole history of a name in one task.
    Here each (name, bucket) partition adds its own changes to the bucket's
    opening count (see the module notes).
    """
    ch, _, opening = _changes(df, name, ts, seq, window_micros, bucket_micros)
    return (_with_opening(ch, opening, F.col("__run"))
            .select(F.col("__key.n").alias("name"), from_epoch_micros("__t").alias("ts"),
                    "seq", "delta", "count"))


def latest_per_tick(df: DataFrame, name: str, ts: str, seq: str, tick_micros: int,
                    window_micros: int = HOUR, bucket_micros: int | None = None) -> DataFrame:
    """(tick, name, count): the count after the last change of every name in
    every tick (an epoch-aligned interval that divides the window; the
    buckets are chosen as multiples of it unless given).

    A tick never straddles two buckets, so the last change of a tick is the
    row whose next row in the same (name, bucket) partition lies in a later
    tick -- a ``lead`` in the window that computes the running count, with no
    further shuffle or aggregation.
    """
    if bucket_micros is None:
        # the smallest multiple of the tick that divides the window and is at
        # least a quarter of it (15 minutes for ticks of 1, 5 or 15 minutes)
        if window_micros % tick_micros:
            raise ValueError("the tick must divide the window")
        n = window_micros // tick_micros
        j = next(j for j in range(1, n + 1)
                 if n % j == 0 and tick_micros * j >= window_micros // 4)
        bucket_micros = tick_micros * j
    bucket, _ = _buckets_per_window(window_micros, bucket_micros)
    if bucket % tick_micros:
        raise ValueError("the tick must divide the bucket")
    ch, order, opening = _changes(df, name, ts, seq, window_micros, bucket_micros)
    tick = floor_div("__t", tick_micros)
    last = (ch.withColumn("__tick", tick).withColumn("__next", F.lead(tick).over(order))
            .where(F.col("__next").isNull() | (F.col("__next") != F.col("__tick"))))
    return (_with_opening(last, opening, F.col("__run"))
            .select(from_epoch_micros(F.col("__tick") * tick_micros).alias("tick"),
                    F.col("__key.n").alias("name"), "count"))


def trailing_changelog_unbucketed(df: DataFrame, name: str, ts: str, seq: str,
                                  window_micros: int = HOUR) -> DataFrame:
    """Reference form of :func:`trailing_changelog` (one partition per name);
    kept for tests and for comparing plans."""
    us = epoch_micros(ts)
    base = (df.select(F.col(name).alias("name"), us.alias("__us"), F.col(seq).alias("seq"))
            .where(F.col("__us").isNotNull()))
    arr = base.select("name", "seq", F.col("__us").alias("__t"), F.lit(0).alias("__k"),
                      F.lit(1).alias("delta"))
    exp = base.select("name", "seq", (F.col("__us") + window_micros).alias("__t"),
                      F.lit(1).alias("__k"), F.lit(-1).alias("delta"))
    w = (Window.partitionBy("name").orderBy("__t", "__k", "seq")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (arr.unionByName(exp).withColumn("count", F.sum("delta").over(w).cast("bigint"))
            .select("name", from_epoch_micros("__t").alias("ts"), "seq", "delta", "count"))
