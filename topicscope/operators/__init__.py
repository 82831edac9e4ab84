"""Relational operators of the engine (DataFrame in, DataFrame out)."""

from .leaderboard import (CAPACITY, admit, delta, histogram, json_message,
                          minimum, snapshot, step, top_n)
from .sequence import index_within
from .topics import (DEFAULT_STOP_TOPICS, as_json_lines, daily_top_topics,
                     daily_top_topics_nested, exclude_topics, names_array,
                     nest_by_day, top_k_per_group, topic_day_counts, topic_mentions)
from .trailing import latest_per_tick, trailing_changelog, trailing_count

__all__ = [
    "CAPACITY", "admit", "delta", "histogram", "json_message", "minimum", "snapshot", "step", "top_n", "index_within", "DEFAULT_STOP_TOPICS",
    "as_json_lines", "daily_top_topics", "daily_top_topics_nested", "exclude_topics",
    "names_array", "nest_by_day", "top_k_per_group", "topic_day_counts",
    "topic_mentions", "latest_per_tick", "trailing_changelog", "trailing_count",
]
