"""String functions on Columns (Column in, Column out, all JVM side)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters removed from a packed name list before it is
# split (commas and the ASCII digits 0-9), and the list / field separators.
STRIP_CHARS = ",0123456789"
NAME_SEPARATOR = ";"
FIELD_SEPARATOR = "\t"

def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_names(c) -> Column:
    """Remove commas and digits anywhere in the value (no regex engine)."""
    return F.translate(_col(c), STRIP_CHARS, "")


def java_split(c, sep: str = NAME_SEPARATOR) -> Column:
    """Split like ``String.split(sep)`` on the JVM: trailing empty pieces
    are dropped, leading and inner ones kept, and a string made only of
    separators gives an empty array.  The empty string gives ``[""]``.
    """
    c = _col(c)
    pattern = re.escape(sep)
    if len(sep) == 1:
        trimmed = F.rtrim(c, F.lit(sep))
    else:
        trimmed = F.regexp_replace(c, f"(?:{pattern})+\\z", "")
    return (F.when(c == "", F.array(F.lit("")))
             .when(trimmed == "", _empty_strings())
             .otherwise(F.split(trimmed, pattern)))


def split_all(c, sep: str = NAME_SEPARATOR) -> Column:
    """Split keeping every piece, trailing empties included (``split(sep, -1)``)."""
    return F.split(_col(c), re.escape(sep), -1)


def is_blank(c) -> Column:
    """True when a JVM ``trim`` would leave nothing: every character is a
    control character or space (code point <= U+0020)."""
    return _col(c).rlike(r"^[\x00-\x20]*\z")


def first_field(c, sep: str = FIELD_SEPARATOR) -> Column:
    """Text before the first separator (the record key of a line)."""
    return F.substring_index(_col(c), sep, 1)


def count_fields(c, sep: str = FIELD_SEPARATOR) -> Column:
    """Number of pieces ``String.split(sep)`` would return for a one-character
    separator, without building the array: separators before the trailing run
    plus one (0 when only separators are left, 1 for the empty string)."""
    c = _col(c)
    body = F.rtrim(c, F.lit(sep))
    seps = F.length(body) - F.length(F.translate(body, sep, ""))
    return F.when(c == "", F.lit(1)).when(body == "", F.lit(0)).otherwise(seps + 1)


def nth_field(c, index: int, sep: str = FIELD_SEPARATOR) -> Column:
    """Field ``index`` (0-based) of a separated line; only meaningful when
    the line has more than ``index`` fields."""
    return F.substring_index(F.substring_index(_col(c), sep, index + 1), sep, -1)


def has_fields(c, n: int, sep: str = FIELD_SEPARATOR) -> Column:
    """True when splitting on ``sep`` keeping every piece gives at least ``n``
    fields, i.e. the line has ``n - 1`` separators; no array is built."""
    c = _col(c)
    return F.substring_index(c, sep, n - 1) != c if n > 1 else c.isNotNull()


def decode_key_millis(c) -> Column:
    """``<millis>-<seq>`` -> millis as bigint (null when not a number)."""
    return F.get(F.split(_col(c), "-"), 0).try_cast("bigint")


def parse_record_key(c) -> Column:
    """``a-b`` -> struct(a long, b long); (0, 0) unless there are exactly two
    parts and both are whole numbers in the long range.  Empty parts at the end
    don't count, as in a JVM ``split`` (``1-2-`` has two parts)."""
    parts = F.split(F.regexp_replace(_col(c), r"-+\z", ""), "-")
    number = r"^[+-]?[0-9]+\z"
    a = F.get(parts, 0)
    b = F.get(parts, 1)
    a_num = a.try_cast("bigint")
    b_num = b.try_cast("bigint")
    ok = ((F.size(parts) == 2) & a.rlike(number) & b.rlike(number)
          & a_num.isNotNull() & b_num.isNotNull())
    ok = F.coalesce(ok, F.lit(False))
    return F.struct(F.when(ok, a_num).otherwise(F.lit(0)).cast("bigint").alias("a"),
                    F.when(ok, b_num).otherwise(F.lit(0)).cast("bigint").alias("b"))


def encode_long(c) -> Column:
    """A long as its 8 big-endian bytes (the wire format of a count)."""
    return F.unhex(F.lpad(F.hex(_col(c).cast("bigint")), 16, "0"))


def decode_long(c) -> Column:
    """8 big-endian bytes -> long, negative values included; null otherwise."""
    digits = F.hex(_col(c))
    high = F.conv(F.substring(digits, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(digits, 9, 8), 16, 10).cast("bigint")
    return F.when(F.length(digits) == 16, F.shiftleft(high, 32).bitwiseOR(low))


def drop_malformed(c) -> Column:
    """Skip bytes that are not valid UTF-8 ("ignore malformed input").

    A text read keeps such bytes raw; they turn into U+FFFD only when the
    value is decoded, which ``regexp_replace`` does (a byte-level ``replace``
    would not see them), so the regex form is needed here."""
    return F.regexp_replace(_col(c), "\ufffd", "")
