"""Conversions between epoch milliseconds, timestamps and the text forms of times."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms used in tables and reports.
DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"
SECOND_DASHED = "yyyy-MM-dd HH-mm-ss"


def epoch_ms_to_text(ms: Column, pattern: str = SECOND_DASHED) -> Column:
    return F.date_format(F.timestamp_millis(ms), pattern)


def time_to_text(ts: Column, pattern: str = SECOND) -> Column:
    return F.date_format(ts, pattern)


def text_to_time(text: Column, pattern: str = SECOND) -> Column:
    """Parse a text time; text that is none fails the query under ANSI mode.

    For the usual form a cast does it, several times faster than a pattern; it also takes one-digit
    months and the like.
    """
    return text.cast("timestamp") if pattern == SECOND else F.to_timestamp(text, pattern)


def text_to_epoch_ms(text: Column, pattern: str = SECOND) -> Column:
    """Epoch milliseconds of a text time; a fraction of a second is beyond the usual form and ignored."""
    time = text_to_time(text, pattern)
    return F.unix_seconds(time) * 1000 if pattern == SECOND else F.unix_millis(time)


def day_text(ts: Column) -> Column:
    """``yyyy-MM-dd`` of a timestamp in the session zone."""
    return ts.cast("date").cast("string")


def bucket_start(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned bucket that holds ``ts``."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / F.lit(seconds)) * F.lit(seconds))
