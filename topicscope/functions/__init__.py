"""Column -> Column helpers (built-in expressions only)."""

from .text import (count_fields, decode_key_millis, drop_malformed, first_field, has_fields, is_blank, java_split, nth_field, parse_record_key, split_all, strip_names)
from .time import (epoch_micros, epoch_millis, format_day, from_epoch_micros,
                   from_epoch_millis, gkg_date_string, key_start,
                   last_closed_segment, next_interval, segment_file_name, segment_of, segment_stamp, to_instant)

__all__ = [
    "count_fields", "decode_key_millis", "drop_malformed", "first_field",
    "has_fields", "is_blank", "nth_field",
    "java_split", "parse_record_key", "split_all", "strip_names",
    "epoch_micros", "epoch_millis", "format_day", "from_epoch_micros",
    "from_epoch_millis", "gkg_date_string", "key_start", "last_closed_segment",
    "next_interval", "segment_file_name", "segment_of",
    "segment_stamp", "to_instant",
]
