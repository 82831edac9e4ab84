"""Structured Streaming: sources, trailing-hour state, leaderboard feed."""

from .feed import LeaderboardFeed, current_set, messages, snapshot
from .feeder import (feed_new_segments, publish_segment_once, segment_lines, timed_records)
from .pipeline import start_changelog_sink, start_topic_stream
from .segment_log import last_key, publish, stream_log
from .slices import handed_over, late_rows, open_rows, settled, slice_log, start_slice_log
from .source import kafka_histogram, kafka_records, landing_records, stream_names
from .trailing import open_sliding_hours, sliding_hour_counts, trailing_hour_updates

__all__ = ["LeaderboardFeed", "current_set", "messages", "snapshot", "publish_segment_once", "feed_new_segments",
           "segment_lines", "timed_records", "start_changelog_sink", "start_topic_stream",
           "kafka_histogram", "kafka_records", "landing_records", "stream_names",
           "sliding_hour_counts", "open_sliding_hours", "trailing_hour_updates",
           "last_key", "publish", "stream_log",
           "handed_over", "late_rows", "open_rows", "settled", "slice_log", "start_slice_log"]
