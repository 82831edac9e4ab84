"""Bounded leaderboard over a name -> count histogram.

Batch operators work on histogram tables ``(name, count)``; the streaming
feed applies the same functions to each micro-batch.  Every result here is
bounded by the capacity (100 by default): top-k is planned as a per-partition
partial top-k followed by a merge of at most ``k x partitions`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CAPACITY = 100


def histogram(mentions: DataFrame, name: str = "name") -> DataFrame:
    """(name, count) of a mention table (partial + final aggregate)."""
    return mentions.groupBy(F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("count"))


def top_n(hist: DataFrame, n: int = CAPACITY) -> DataFrame:
    """The ``n`` largest counts, ties broken by name ascending."""
    return hist.orderBy(F.col("count").desc(), F.col("name").asc()).limit(n)


def admit(current: DataFrame, updates: DataFrame, n: int = CAPACITY) -> DataFrame:
    """One step of the bounded set: members take their new counts, then the
    set becomes the ``n`` best of members and updated names, where a member
    keeps its place against a newcomer with the same count (a newcomer has to
    be strictly greater than the minimum to get in).

    ``current`` is the set (at most ``n`` rows by construction, so it is
    broadcast); ``updates`` holds one last count per name of a micro-batch and
    is never shuffled whole: members' updates come from a broadcast semi
    join, newcomers from a broadcast anti join cut to their own best ``n``
    (no other newcomer can enter), and the final top-``n`` sees at most
    ``3n`` rows.
    """
    members = current.select("name", F.col("count").cast("bigint").alias("count"))
    names = F.broadcast(members.select("name"))
    updated = (updates.join(names, "name", "left_semi")
               .select("name", F.col("count").cast("bigint").alias("count")))
    untouched = members.join(F.broadcast(updated.select("name")), "name", "left_anti")
    newcomers = top_n(updates.join(names, "name", "left_anti")
                      .select("name", F.col("count").cast("bigint").alias("count")), n)
    cand = (updated.withColumn("member", F.lit(True))
            .unionByName(untouched.withColumn("member", F.lit(True)))
            .unionByName(newcomers.withColumn("member", F.lit(False))))
    return (cand.orderBy(F.col("count").desc(), F.col("member").desc(), F.col("name").asc())
            .limit(n).select("name", "count"))


def step(current: DataFrame, updates: DataFrame, n: int = CAPACITY, ties: str = "members") -> DataFrame:
    """:func:`admit` and :func:`delta` in one bounded table
    ``(name, count, member, changed)``: the next set (``member``) and the names
    that left it (count 0); ``changed`` marks the rows of the delta message.

    ``ties``: of equal counts ``members`` stay in the set, or the lesser ``name`` is in it.
    With names, and counts that only grow, the set is the exact top ``n`` of all names ever
    updated: a name outside keeps a rank beyond ``n`` until it is updated itself.

    The lowest count of a full set is known before the batch is read: a newcomer below it
    can't enter and is filtered where the updates are read.

    ``updates`` (one row per name) is read once.  A broadcast lookup of the
    members (at most ``n`` rows) flags each update, and ``row_number() <= n``
    per flag keeps the members' updates (at most ``n``) and the best ``n``
    newcomers; Spark plans that filter as a partial WindowGroupLimit before
    its exchange, so a map task sends at most ``2n`` rows.  Everything after
    works on at most ``3n`` rows in one partition: no further exchange.
    """
    members = current.select("name", F.col("count").cast("bigint").alias("old"))
    flag = F.broadcast(members.select("name", F.lit(True).alias("member")))
    bound = members.agg(F.when(F.count(F.lit(1)) >= n, F.min("old")).alias("bound")).scalar()
    flagged = (updates.select("name", F.col("count").cast("bigint").alias("new"))
               .join(flag, "name", "left")
               .select("name", "new", F.coalesce("member", F.lit(False)).alias("member"))
               .where(F.col("member") | (F.col("new") >= F.coalesce(bound, F.col("new")))))
    best = Window.partitionBy("member").orderBy(F.col("new").desc(), F.col("name").asc())
    fresh = (flagged.withColumn("__r", F.row_number().over(best))
             .where(F.col("__r") <= n).drop("__r"))
    rows = (fresh.withColumn("old", F.lit(None).cast("bigint"))
            .unionByName(members.select("name", F.lit(None).cast("bigint").alias("new"),
                                        F.lit(True).alias("member"), "old"))
            .repartition(1, "name"))
    per_name = rows.groupBy("name").agg(F.max("member").alias("member"),
                                        F.max("old").alias("old"), F.max("new").alias("new"))
    count = F.coalesce("new", "old")
    # members keep their place against newcomers with the same count, unless names decide
    by_member = [F.col("member").desc()] if ties == "members" else []
    order = Window.orderBy(count.desc(), *by_member, F.col("name").asc())
    ranked = per_name.select("name", "old", count.alias("count"),
                             (F.row_number().over(order) <= n).alias("inset"))
    inset = F.col("inset")
    return (ranked.where(inset | F.col("old").isNotNull())
            .select("name",
                    F.when(inset, F.col("count")).otherwise(F.lit(0)).cast("bigint")
                    .alias("count"),
                    inset.alias("member"),
                    (~inset | F.col("old").isNull() | (F.col("old") != F.col("count")))
                    .alias("changed")))


def delta(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Changes from one bounded set to the next: new or changed names with
    their count, names that left with count 0 (both sides are <= capacity)."""
    p = previous.select("name", F.col("count").alias("p"))
    c = current.select("name", F.col("count").alias("c"))
    j = p.join(c, "name", "full_outer")
    return (j.where(F.col("c").isNull() | F.col("p").isNull() | (F.col("c") != F.col("p")))
            .select("name", F.coalesce(F.col("c"), F.lit(0)).cast("bigint").alias("count")))


def snapshot(previous: DataFrame, current: DataFrame) -> DataFrame:
    """What a new subscriber is sent: the current set plus names that were in
    the previous one and left, at 0."""
    c = current.select("name", F.col("count").cast("bigint").alias("count"))
    gone = (previous.select("name").join(c.select("name"), "name", "left_anti")
            .select("name", F.lit(0).cast("bigint").alias("count")))
    return c.unionByName(gone)


def minimum(hist: DataFrame) -> DataFrame:
    """The entry with the smallest count (smallest name among equals)."""
    return hist.agg(F.min_by("name", F.struct("count", "name")).alias("name"),
                    F.min("count").alias("count"))


def json_message(entries: DataFrame) -> DataFrame:
    """One JSON array ``[{"name":..,"count":..},..]`` ordered by name; for
    bounded inputs (a delta or a snapshot of the set)."""
    arr = F.array_sort(F.collect_list(F.struct("name", "count")))
    return entries.agg(F.to_json(arr).alias("json"))
