"""Sinks: distributed JSON-lines writes and JSON rendering."""

from .json import kafka_columns, write_json_lines, write_kafka

__all__ = ["kafka_columns", "write_json_lines", "write_kafka"]
