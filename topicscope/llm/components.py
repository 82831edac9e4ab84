"""Connected components of an edge table by large-star / small-star rounds.

Every round is group-by minima and joins on Spark; no component, node list or
edge list reaches the driver or a single task.  Minima are partial aggregates,
so a hub costs no more than its edges; joins on a hub are split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, staged


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's greater neighbours go to its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _minima(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them."""
    low = _minima(edges)
    own = low.select("u", F.col("m").alias("v"))
    rest = edges.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(rest).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(
        F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge: the smallest node
    reachable.  Nulls and loops are ignored."""
    x, y = F.col(a), F.col(b)
    cur = staged(edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
                 .distinct(), "edges")
    state = _state(cur)
    while state[0]:
        new = staged(_small_star(_large_star(cur)), "edges")
        drop_staged(cur)
        cur, before, state = new, state, _state(new)
        if state == before:
            break
    # a star per component by now: every node points at its smallest one
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
