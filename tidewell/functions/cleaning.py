"""Coercions that keep absence as NULL: text, numbers, whole numbers, moments.

Each builder looks at the type the column already has, so typed input is cast
directly and only string input pays for a pattern match.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, functions as F, types as T

# every character that counts as white space, by rule
WHITE_SPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())

# a character class of them
_SPACE_CLASS = "[" + "".join(f"\\u{ord(c):04x}" for c in WHITE_SPACE) + "]"
PLAIN_PATTERN = r"^[ -~]*\z"

# ordinary numbers; and everything else a number may look like
NUMBER_PATTERN = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*\z"
_DIGITS = r"\d(?:_?\d)*"
RARE_NUMBER_PATTERN = (
    rf"(?i)^{_SPACE_CLASS}*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    rf"|nan|inf|infinity){_SPACE_CLASS}*\z"
)
MOMENT_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})?)?)?\z"
)
# the other forms of ISO 8601 for a day with a time: hour only, minutes with a zone, zone without colon, no separators
OTHER_MOMENT_PATTERN = (
    r"^(\d{4})-?(\d{2})-?(\d{2})[T ](\d{2}):?(\d{2})?:?(\d{2})?(\.\d+)?(Z|[+-]\d{2}(?::?\d{2})?)?\z"
)
COMPACT_DATE_PATTERN = r"^\d{8}\z"

# seconds of 0001-01-01 and 10000-01-01, the span a moment may have
FIRST_SECOND, END_SECOND = -62135596800, 253402300800


def stripped(value: Column) -> Column:
    """Without white space at both ends. Printable ASCII can only end in blanks and takes
    the plain trim; other text takes the slower trim by a character set."""
    return F.when(value.rlike(PLAIN_PATTERN), F.trim(value)).otherwise(
        F.btrim(value, F.lit(WHITE_SPACE))
    )


def clean_text(value: Column, source: T.DataType) -> Column:
    """Text without surrounding white space; blank text is absence."""
    as_text = value if isinstance(source, T.StringType) else value.cast("string")
    return F.nullif(stripped(as_text), F.lit(""))


def to_number(value: Column, source: T.DataType) -> Column:
    """Double, or NULL where the input is absent or is no number."""
    if isinstance(source, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if not isinstance(source, T.StringType):
        return F.lit(None).cast("double")
    bare = F.replace(F.btrim(value, F.lit(WHITE_SPACE)), F.lit("_"), F.lit(""))
    return F.when(value.rlike(NUMBER_PATTERN), value.try_cast("double")).when(
        value.rlike(RARE_NUMBER_PATTERN), bare.try_cast("double")
    )


def to_whole(value: Column, source: T.DataType) -> Column:
    """Whole number by truncation toward zero, also of text such as '12.9'."""
    if isinstance(source, T.IntegralType):
        return value.cast("bigint")
    return to_number(value, source).try_cast("bigint")


def does_not_fit(number: Column) -> Column:
    """True where a present number has no whole-number form."""
    return number.isNotNull() & ~F.isnan(number) & number.try_cast("bigint").isNull()


def from_epoch(seconds: Column) -> Column:
    in_span = (seconds >= F.lit(FIRST_SECOND)) & (seconds < F.lit(END_SECOND))
    return F.when(in_span, F.timestamp_seconds(seconds))


def _usual_moment(value: Column) -> Column:
    """The usual form of a moment that matches OTHER_MOMENT_PATTERN."""
    spaced = F.regexp_replace(value, OTHER_MOMENT_PATTERN, "$1-$2-$3T$4:$5:$6$7$8")
    clock = F.regexp_replace(spaced, r":(?=[:.Z+-]|\z)", ":00")  # parts of the clock that are left out
    zone = F.regexp_replace(clock, r"([+-]\d{2})\z", "$1:00")
    return F.regexp_replace(zone, r"([+-]\d{2})(\d{2})\z", "$1:$2")


def to_moment(value: Column, source: T.DataType) -> Column:
    """Timestamp from a timestamp, ISO text (zone-free text is UTC) or epoch seconds."""
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return value.cast("timestamp")
    if isinstance(source, T.NumericType):
        return from_epoch(value.cast("double"))
    if not isinstance(source, T.StringType):
        return F.lit(None).cast("timestamp")
    iso = F.when(value.rlike(MOMENT_PATTERN), value.try_cast("timestamp")).when(
        value.rlike(OTHER_MOMENT_PATTERN), _usual_moment(value).try_cast("timestamp")
    )
    compact = F.when(
        value.rlike(COMPACT_DATE_PATTERN), F.try_to_timestamp(value, F.lit("yyyyMMdd"))
    )
    # The number is bound to a name, so that it is parsed once. That also keeps these patterns out of the fused stage,
    # whose one method would grow beyond what the JVM compiles; a projection of its own is cut into small ones.
    epoch = F.get(F.transform(F.array(to_number(value, source)), from_epoch), F.lit(0))
    return F.coalesce(iso, compact, epoch)
