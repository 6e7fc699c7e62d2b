"""Timestamps as text and as instants. Sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$"
#: Dates that tools write for "never".
SENTINELS = r"^(1601-01-01|1970-01-01|0001-01-01|1600-12-)"


def parse_ts(text: Column) -> Column:
    """Instant of an ISO text; fractions are cut after six digits, no zone means UTC, anything else is null."""
    t = F.trim(text)
    cut = F.regexp_replace(t, r"(\.\d{6})\d+", "$1")
    zoned = F.regexp_replace(F.regexp_replace(cut, r"([+-]\d{2})(\d{2})$", "$1:$2"), " ", "T")
    return F.when(t.rlike(ISO), F.try_to_timestamp(zoned))


def clean_ts(text: Column) -> Column:
    return F.when(~text.rlike(SENTINELS), text)


def iso(instant: Column) -> Column:
    """ISO text in UTC with +00:00; microseconds are left out when they are zero."""
    micros = F.unix_micros(instant) % 1000000
    return F.when(micros == 0, F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def epoch_ts(seconds: Column, text: Column | None = None) -> Column:
    """ISO text of epoch seconds; where these are no number, ``text`` if it looks like ISO already."""
    number = seconds.try_cast("double")
    made = iso(F.timestamp_micros(F.rint(number * 1000000).cast("bigint")))
    return F.coalesce(made, F.when(text.rlike(ISO), text)) if text is not None else made


def dotnet_date(text: Column) -> Column:
    """ISO text of a /Date(milliseconds)/ text, with an offset or without."""
    ms = F.regexp_extract(text, r"^/Date\((-?\d+)(?:[+-]\d{4})?\)/$", 1).try_cast("bigint")
    return iso(F.timestamp_micros(ms * 1000))


def ts_before(a: Column, b: Column) -> Column:
    """Whether instant a is before b; null if either is no timestamp."""
    return parse_ts(a) < parse_ts(b)


def iso_z(instant: Column) -> Column:
    """ISO text with milliseconds and Z, as bundles and documents have it."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def duration_end(start: Column, seconds: Column) -> Column:
    """Instant ``seconds`` after ``start``, to the even microsecond."""
    return F.timestamp_micros(F.unix_micros(start) + F.rint(seconds * 1000000).cast("bigint"))
