"""Date and time functions.

Results are `timestamp_ntz`: the sources give wall-clock times without a zone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import SPACE, col, let, strip_ws

# The date layouts met in the sources, as Spark patterns, each with the
# outer shape of its texts. The shape spares parsers the texts they would fail on.
DATE_PATTERNS = {
    "MMM d, yyyy h:m:s a": r"^[A-Z][a-z]{2} \d+, \d{4} .*M$",
    "yyyy, MMM d 'at' H:m:s'+0000'": r"^\d{4}, .*\+0000$",
    "MMM d, yyyy": r"^[A-Z][a-z]{2} \d+, \d{4}$",
    "yyyy-M-d H:m:s": r"^\d{4}-\d+-\d+ \d+:",
    "yyyy-M-d": r"^\d{4}-\d+-\d+$",
}
START_DATE = "2016-01-01 00:00:00"  # fixed value: first lower bound of an incremental run


def parse_any_date(text: Column | str, patterns: Iterable[str] = tuple(DATE_PATTERNS)) -> Column:
    """First layout that fits; null when none does."""

    def parse(text: Column, pattern: str) -> Column:
        value = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
        return F.when(text.rlike(DATE_PATTERNS[pattern]), value) if pattern in DATE_PATTERNS else value

    return let(strip_ws(text), lambda t: F.coalesce(*[parse(t, p) for p in patterns]))


def epoch_zero() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def from_epoch(seconds: Column | str) -> Column:
    """Epoch seconds to a timestamp."""
    return F.timestamp_add("SECOND", col(seconds).cast("long"), epoch_zero())


def to_epoch(ts: Column | str) -> Column:
    """Timestamp to whole epoch seconds."""
    return F.timestamp_diff("SECOND", epoch_zero(), F.date_trunc("second", col(ts)).cast("timestamp_ntz"))


def format_ts(ts: Column | str) -> Column:
    """The text form used for export."""
    return F.date_format(col(ts), "yyyy-MM-dd HH:mm:ss")


def run_stamp(ts: Column | str) -> Column:
    """Compact stamp of a run, e.g. 20170605030405."""
    return F.date_format(col(ts), "yyyyMMddHHmmss")


def run_number(ts: Column | str, offset: int = 0) -> Column:
    """Run stamp as a number, moved by `offset`."""
    return run_stamp(ts).cast("long") + F.lit(offset)


def assemble_ts(date: Column | str, time: Column | str | None = None) -> Column:
    """A date from one page and `HH:mm` from another; midnight without a time."""
    clock = F.lit("00:00:00") if time is None else F.concat(strip_ws(time), F.lit(":00"))
    return F.try_to_timestamp(F.concat_ws(" ", strip_ws(date), clock), F.lit("yyyy-M-d H:m:s")).cast("timestamp_ntz")


def head_line(text: Column | str) -> Column:
    """Split a head line such as ``2017-06-05  Daily News`` into date and source."""
    words = F.split(strip_ws(text), rf"[{SPACE}]+")
    return F.struct(
        F.try_to_timestamp(F.get(words, 0), F.lit("yyyy-M-d")).cast("timestamp_ntz").alias("pubdate"),
        F.get(words, 1).alias("location"),
    )
