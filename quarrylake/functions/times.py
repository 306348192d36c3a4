"""Instants, durations and dates from mixed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The written forms of an instant that carry no offset. The fourth
# form ends in `Z` or an offset such as `+02:00`. No text has two of the forms.
EPOCH_MILLIS = r"^\d+$"
LOCAL_ISO = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
LOCAL_DAY_FIRST = r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}$"


# The greatest number of milliseconds whose microseconds fit a timestamp.
MOST_MILLIS = (2**63 - 1) // 1000


def epoch_millis(text: Column) -> Column:
    """Milliseconds written as digits; null where they lie beyond what a timestamp holds."""
    number = text.try_cast("bigint")
    return F.when(number <= MOST_MILLIS, number)


def beyond_timestamps(text: Column) -> Column:
    """Whether a text is digits only, but of a moment that no timestamp holds; never null."""
    return F.coalesce(text.rlike(EPOCH_MILLIS) & epoch_millis(text).isNull(), F.lit(False))


def wall_clock(text: Column, zone: Column) -> Column:
    """Instant of a zone-less wall-clock text, whatever the session's zone is.

    The text is read as if it were UTC and then shifted out of `zone`; a null
    zone gives null. The cast never throws, so bad dates cost no exception.
    """
    return F.to_utc_timestamp(F.concat(text, F.lit("Z")).try_cast("timestamp"), zone)


def day_first_to_iso(text: Column) -> Column:
    """`dd/MM/yyyy HH:mm` rewritten as `yyyy-MM-dd HH:mm:00`."""
    return F.regexp_replace(text, r"^(\d{2})/(\d{2})/(\d{4}) (\d{2}:\d{2})$", "$3-$2-$1 $4:00")


def has_offset(text: Column) -> Column:
    """Whether the text ends like one with an offset; two character tests, no pattern search."""
    numeric = F.substr(text, F.lit(-6), F.lit(1)).isin("+", "-") & (F.substr(text, F.lit(-3), F.lit(1)) == ":")
    return text.endswith("Z") | numeric


def instant(text: Column, zone: Column) -> Column:
    """Instant written as epoch milliseconds, local time, offset time or day-first local time."""
    return (
        F.when(has_offset(text), text.try_cast("timestamp"))
        .when(text.rlike(EPOCH_MILLIS), F.timestamp_millis(epoch_millis(text)))
        .when(text.rlike(LOCAL_ISO), wall_clock(text, zone))
        .when(text.rlike(LOCAL_DAY_FIRST), wall_clock(day_first_to_iso(text), zone))
    )


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def duration(measured: Column, start: Column, end: Column) -> Column:
    """The measured seconds, or the span of a closed interval when none was measured."""
    return F.coalesce(measured.cast("double"), seconds_between(start, end))


def is_open(end: Column) -> Column:
    return end.isNull()


def day_of(moment: Column) -> Column:
    return moment.cast("date")
