"""Position of a row inside its group, without one task per group.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group
to one task, so a group that holds a third of the data makes one task do a
third of the work.  Here the group is cut into blocks of consecutive order
values; each (group, block) is numbered on its own, block sizes are summed
into offsets on a table with one row per block, and the offset is joined
back.  The only large exchange is the one on (group, block): the block table
is a partial aggregate (one row per block and map task before its shuffle),
small, and AQE broadcasts it when its measured size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import floor_div

DEFAULT_BLOCK = 1 << 16
# One level by default: the block table has one row per DEFAULT_BLOCK order
# values, a few million rows for a group that holds a third of 100 TB, which
# one task sums in seconds.  Runs of blocks (e.g. 1024) bound that too, at the
# cost of one more small aggregate and join.
DEFAULT_SUPER_BLOCK = 0


def index_within(df: DataFrame, group: Sequence[str], order: Sequence[str],
                 block_on: str | Sequence[str] | None = None, block_size: int = DEFAULT_BLOCK,
                 index_col: str = "idx", size_col: str | None = None,
                 first_of: Sequence[str] = (),
                 super_block: int = DEFAULT_SUPER_BLOCK) -> DataFrame:
    """Add ``index_col`` = 0-based position of the row in its group under
    ``order`` (which must be a total order inside the group).

    ``block_on`` is an integral column whose value never decreases along
    ``order`` (normally the first order column); blocks are ranges of
    ``block_size`` of its values.  With several columns, which must lead
    ``order``, a block is a range of the last one's values among equal values
    of the others (``super_block`` needs one column).  ``size_col`` adds the group size;
    ``first_of`` adds, for each listed column ``c``, ``first_c`` = the value of
    ``c`` on the first row of the group.

    The block offsets are a prefix sum over the group's blocks; with
    ``super_block`` > 0 it has two levels, within runs of ``super_block``
    blocks and over one row per run, so no task sums more than
    ``super_block`` blocks or runs of a group.
    """
    group = list(group)
    order = list(order)
    on = [block_on or order[0]] if block_on is None or isinstance(block_on, str) else list(block_on)
    if super_block and len(on) > 1:
        raise ValueError("super_block needs one block column")
    blk = "__blk"
    keys = group + [blk]
    block = floor_div(on[-1], block_size)
    if len(on) > 1:
        block = F.struct(*on[:-1], block.alias("range"))

    d = df.withColumn(blk, block)
    local = Window.partitionBy(*keys).orderBy(*order)
    d = d.withColumn("__local", (F.row_number().over(local) - 1).cast("bigint"))

    # Block table: partial + final aggregate on (group, block).  A count alone
    # is a hash aggregate; first values need an ordering (min_by), which Spark
    # runs as a sort aggregate -- a local sort before a tiny shuffle.
    aggs = [F.count(F.lit(1)).alias("__n")]
    if first_of:
        order_key = F.struct(*[F.col(c) for c in order])
        aggs += [F.min_by(F.col(c), order_key).alias(f"__first_{c}") for c in first_of]
    blocks = df.withColumn(blk, block).groupBy(*keys).agg(*aggs)
    offsets = (_two_level_offsets(blocks, group, blk, size_col, first_of, super_block)
               if super_block else _offsets(blocks, group, blk, size_col, first_of))

    return (d.join(offsets, keys)
            .withColumn(index_col, F.col("__off") + F.col("__local"))
            .drop(blk, "__local", "__off"))


def _offsets(blocks: DataFrame, group: list, blk: str, size_col, first_of) -> DataFrame:
    """Rows before each block of its group, one window over the group's blocks."""
    before = Window.partitionBy(*group).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group).orderBy(blk).rowsBetween(Window.unboundedPreceding,
                                                                Window.unboundedFollowing)
    cols = group + [blk, F.coalesce(F.sum("__n").over(before), F.lit(0)).cast("bigint")
                    .alias("__off")]
    if size_col:
        cols.append(F.sum("__n").over(whole).cast("bigint").alias(size_col))
    for c in first_of:
        cols.append(F.first(f"__first_{c}").over(whole).alias(f"first_{c}"))
    return blocks.select(*cols)


def _two_level_offsets(blocks: DataFrame, group: list, blk: str, size_col, first_of,
                       super_block: int) -> DataFrame:
    """Rows before each block: the rows of the earlier blocks of its run plus
    the rows of the earlier runs of its group."""
    sb = "__sb"
    runs = group + [sb]
    blocks = blocks.withColumn(sb, floor_div(blk, super_block))
    in_run = Window.partitionBy(*runs).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn(
        "__boff", F.coalesce(F.sum("__n").over(in_run), F.lit(0)).cast("bigint"))
    run_aggs = [F.sum("__n").alias("__rn")]
    run_aggs += [F.min_by(f"__first_{c}", blk).alias(f"__rfirst_{c}") for c in first_of]
    per_run = blocks.groupBy(*runs).agg(*run_aggs)
    before = Window.partitionBy(*group).orderBy(sb).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group).orderBy(sb).rowsBetween(Window.unboundedPreceding,
                                                               Window.unboundedFollowing)
    cols = runs + [F.coalesce(F.sum("__rn").over(before), F.lit(0)).cast("bigint")
                   .alias("__roff")]
    if size_col:
        cols.append(F.sum("__rn").over(whole).cast("bigint").alias(size_col))
    for c in first_of:
        cols.append(F.first(f"__rfirst_{c}").over(whole).alias(f"first_{c}"))
    per_run = per_run.select(*cols)
    extra = ([size_col] if size_col else []) + [f"first_{c}" for c in first_of]
    return (blocks.join(per_run, runs)
            .select(*group, blk, (F.col("__roff") + F.col("__boff")).alias("__off"), *extra))
