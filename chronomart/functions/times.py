"""Timestamp text. Results never depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Names under which a session zone is plain UTC.
_UTC = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "Zulu", "+00:00"}


def _session_is_utc() -> bool:
    return SparkSession.active().conf.get("spark.sql.session.timeZone") in _UTC


def parse_ts(text: Column) -> Column:
    """ISO-8601 text to a UTC timestamp without zone; bad text gives NULL.

    Text with an offset is moved to UTC, text without one is taken as UTC.
    """
    instant = text.try_cast("timestamp")
    if _session_is_utc():
        return instant.cast("timestamp_ntz")
    clock = F.substring(F.trim(text), 12, 40)
    zoned = F.upper(clock).endswith("Z") | clock.contains("+") | clock.contains("-")
    return F.when(zoned, _utc(instant)).otherwise(text.try_cast("timestamp_ntz"))


def _utc(instant: Column) -> Column:
    """UTC wall clock of an instant, counted from the epoch: a session's clock change has no part in it."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def utc_now() -> Column:
    return _utc(F.current_timestamp())


def capture_date(captured_at: Column, unreadable: Column | None = None) -> Column:
    """Calendar date in the event's own offset; ``unreadable``, else today (UTC), when the text is no timestamp."""
    own_date = F.substring(F.trim(captured_at), 1, 10).try_cast("date")
    other = utc_now().cast("date") if unreadable is None else unreadable
    return F.coalesce(F.when(parse_ts(captured_at).isNotNull(), own_date), other)


def ts_text(ts: Column) -> Column:
    return ts.cast("string")


def fmt_ts(ts: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(ts, pattern)
