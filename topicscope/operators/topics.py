"""Mentions, per-day counts and the daily top-k.

Plan shape (one scan stage, two exchanges):

    scan (2 columns, IsNotNull pushed) -> translate -> split -> explode
      -> partial count(day, topic) -> exchange(day, topic) -> final count
      -> partial top-k per day (WindowGroupLimit) -> exchange(day)
      -> final top-k -> collect per day (same partitioning, no exchange)

The partial aggregate leaves one row per (day, topic) and map task, and the
partial top-k leaves at most k rows (plus ties) per day and task, so neither a
hot topic nor a busy day sends more than that through the second exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank, java_split, split_all, strip_names
from ..schema import RESULT_TYPE

# Fixed value: the topic the daily report leaves out.
DEFAULT_STOP_TOPICS = ("Type ParentCategory",)


def exclude_topics(mentions: DataFrame, stop_topics: Sequence[str] = DEFAULT_STOP_TOPICS,
                   match: str = "equals", col: str = "topic") -> DataFrame:
    """Drop stop topics: ``equals`` (whole topic), ``contains`` (substring)
    or ``none``.  The list is a literal in the plan, not a join."""
    stop_topics = list(stop_topics or [])
    if match == "none" or not stop_topics:
        return mentions
    if match == "equals":
        return mentions.where(~F.col(col).isin(stop_topics))
    if match == "contains":
        cond = F.lit(False)
        for s in stop_topics:
            cond = cond | F.col(col).contains(s)
        return mentions.where(~cond)
    raise ValueError(f"unknown match {match!r}")


def names_array(all_names, split: str = "java"):
    """Strip commas/digits from the packed list and split it on ``;``."""
    stripped = strip_names(all_names)
    if split == "java":
        return java_split(stripped)
    if split == "all":
        return split_all(stripped)
    raise ValueError(f"unknown split {split!r}")


def topic_mentions(records: DataFrame, day_col: str = "day", names_col: str = "all_names",
                   split: str = "java", drop_blank: bool = False,
                   stop_topics: Sequence[str] = DEFAULT_STOP_TOPICS,
                   match: str = "equals") -> DataFrame:
    """One row per mention: (day, topic).

    Defaults follow the batch report: rows with a null day or list are
    dropped, the list is split like ``String.split`` (trailing empties
    dropped), blank topics are kept and counted, topics are not trimmed, and
    exact stop topics are removed.
    """
    day = F.col(day_col)
    names = F.col(names_col)
    mentions = (records.where(day.isNotNull() & names.isNotNull())
                .select(day.alias("day"),
                        F.explode(names_array(names, split)).alias("topic")))
    if drop_blank:
        mentions = mentions.where(~is_blank("topic"))
    return exclude_topics(mentions, stop_topics, match)


def topic_day_counts(mentions: DataFrame) -> DataFrame:
    """(day, topic, count): mentions per day and topic (partial + final agg)."""
    return mentions.groupBy("day", "topic").agg(F.count(F.lit(1)).alias("count"))


def top_k_per_group(counts: DataFrame, group: str = "day", k: int = 10,
                    ties: str = "include", value: str = "count",
                    tie_break: str = "topic") -> DataFrame:
    """Rows whose count ranks within the first ``k`` of their group.

    ``ties="include"`` keeps every row ranked <= k (``rank``, so a group can
    return more than k); ``ties="cut"`` returns exactly k, breaking ties by
    ``tie_break`` ascending.  Either form is planned as a WindowGroupLimit
    before the exchange.
    """
    if ties == "include":
        w = Window.partitionBy(group).orderBy(F.col(value).desc())
        r = F.rank().over(w)
    elif ties == "cut":
        w = Window.partitionBy(group).orderBy(F.col(value).desc(), F.col(tie_break).asc())
        r = F.row_number().over(w)
    else:
        raise ValueError(f"unknown ties {ties!r}")
    return counts.withColumn("rank", r).where(F.col("rank") <= k).drop("rank")


def nest_by_day(top: DataFrame, day_out: str = "data") -> DataFrame:
    """(day, topic, count) rows -> one row per day with
    ``result: array<struct<topic, count>>`` ordered by count desc, topic asc.

    A single list of structs is collected, so topics and counts cannot drift
    apart; the rows are already cut to the top-k, so each list is short.
    """
    entries = F.collect_list(F.struct((-F.col("count")).alias("neg"), F.col("topic")))
    ordered = F.transform(F.array_sort(entries),
                          lambda e: F.struct(e["topic"].alias("topic"),
                                             (-e["neg"]).alias("count")))
    return (top.groupBy(F.col("day").alias(day_out))
            .agg(ordered.cast(RESULT_TYPE).alias("result")))


def top_k_array(result, k: int = 10):
    """First ``k`` entries of an already ordered ``result`` array (the
    in-list form of the exact top-k)."""
    return F.slice(result, 1, k)


def daily_top_topics(records: DataFrame, k: int = 10, ties: str = "include",
                     **mention_opts) -> DataFrame:
    """Flat daily top-k: (day, topic, count)."""
    counts = topic_day_counts(topic_mentions(records, **mention_opts))
    return top_k_per_group(counts, "day", k, ties)


def daily_top_topics_nested(records: DataFrame, k: int = 10, ties: str = "include",
                            **mention_opts) -> DataFrame:
    """(data, result[]) per day -- the shape of the JSON report."""
    return nest_by_day(daily_top_topics(records, k, ties, **mention_opts))


def as_json_lines(df: DataFrame) -> DataFrame:
    """Every row rendered as one JSON object (column ``json``)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
