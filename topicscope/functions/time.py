"""Time functions on Columns.

Inputs are wall-clock TIMESTAMP_NTZ values read as UTC.  The arithmetic goes
through epoch microseconds so the results do not depend on the session time
zone (``date_trunc`` on TIMESTAMP_NTZ does, and is avoided).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import GKG_DATE_FORMAT, SEGMENT_EXTENSION, SEGMENT_MINUTES

MICROS_PER_MILLI = 1_000
MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 3_600_000_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(c, n) -> Column:
    """Exact floor division of an integral column by a positive integer
    (column or int), in 64-bit integers -- no rounding through doubles."""
    c = _col(c)
    n = n if isinstance(n, Column) else F.lit(int(n))
    return F.call_function("div", c - F.pmod(c, n), n)


def epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def epoch_micros(ts) -> Column:
    """TIMESTAMP_NTZ -> microseconds since 1970-01-01 (UTC wall clock).

    The difference of two NTZ values is an interval, whatever the session zone
    (``timestamp_diff`` reads both in the session zone and shifts those inside
    a spring gap)."""
    return F.call_function("div", _col(ts) - epoch(), F.expr("INTERVAL '0.000001' SECOND"))


def epoch_millis(ts) -> Column:
    return floor_div(epoch_micros(ts), MICROS_PER_MILLI)


def from_epoch_micros(us) -> Column:
    """Microseconds since 1970 -> TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", _col(us), epoch())


def from_epoch_millis(ms) -> Column:
    return F.timestamp_add("MILLISECOND", _col(ms), epoch())


def to_instant(ts) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> TIMESTAMP (an instant), zone free."""
    return F.timestamp_micros(epoch_micros(ts))


def floor_micros(ts, step_micros: int) -> Column:
    us = epoch_micros(ts)
    return from_epoch_micros(floor_div(us, step_micros) * step_micros)


def hour_start(ts) -> Column:
    return floor_micros(ts, MICROS_PER_HOUR)


def gkg_date_string(ts) -> Column:
    """TIMESTAMP_NTZ -> ``yyyyMMddHHmmss``, through the cast to a string: that one
    does not go through the session zone, ``date_format`` does."""
    text = _col(ts).cast("timestamp_ntz").cast("string")
    return F.translate(F.substring(text, 1, 19), "-: ", "")


def format_day(c) -> Column:
    """``yyyyMMdd...`` -> ``yyyy-MM-dd`` by position; null if shorter than 8."""
    c = _col(c)
    return F.when(F.length(c) >= 8,
                  F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2),
                              F.substring(c, 7, 2)))


def next_interval(ts, minutes: int = SEGMENT_MINUTES) -> Column:
    """The next interval boundary strictly after ``ts``, counted within the
    hour: minute m goes to ceil((m + 1) / minutes) * minutes past the hour
    (carrying into the next hour), seconds cleared."""
    nxt = F.ceil((F.minute(_col(ts)) + 1) / F.lit(float(minutes))) * minutes
    return F.timestamp_add("MINUTE", nxt.cast("int"), hour_start(ts))


def last_closed_segment(ts, minutes: int = SEGMENT_MINUTES) -> Column:
    """Start of the segment before the one containing ``ts``: the time with
    seconds cleared, minus ``minutes + minute % minutes`` minutes."""
    m = F.minute(_col(ts))
    minute_floor = floor_micros(ts, MICROS_PER_MINUTE)
    back = (F.lit(minutes) + m % minutes) * -1
    return F.timestamp_add("MINUTE", back.cast("int"), minute_floor)


def segment_file_name(start, extension: str = SEGMENT_EXTENSION) -> Column:
    """Segment start -> ``yyyyMMddHHmm00<extension>`` (UTC)."""
    return F.concat(segment_stamp(start), F.lit(extension))


def segment_stamp(start) -> Column:
    return F.concat(F.substring(gkg_date_string(start), 1, 12), F.lit("00"))


def segment_of(ts, minutes: int = SEGMENT_MINUTES) -> Column:
    """Start of the segment holding ``ts`` (epoch aligned)."""
    return floor_micros(ts, minutes * MICROS_PER_MINUTE)


def key_start(key) -> Column:
    """First 12 digits of a record key (``yyyyMMddHHmm``) as TIMESTAMP_NTZ; null
    if the key does not begin with 12 digits."""
    return F.when(_col(key).rlike("^[0-9]{12}"),
                  F.to_timestamp_ntz(F.substring(_col(key), 1, 12), F.lit("yyyyMMddHHmm")))
