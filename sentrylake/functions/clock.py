"""Time: one clock, instants in UTC whatever the driver's zone."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_now() -> datetime:
    return datetime.now(UTC)


def as_utc(moment: datetime) -> datetime:
    """An aware instant; a naive one is taken as UTC."""
    return moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)


def instant(moment: datetime) -> Column:
    """The instant as a literal, independent of session and driver zones."""
    return F.timestamp_micros(F.lit(round(as_utc(moment).timestamp() * 1_000_000)))


def parse_utc(text: str) -> datetime:
    """A date or date and time in ISO form; without an offset it is UTC."""
    return as_utc(datetime.fromisoformat(text.strip()))


def feed_instant(text: Column) -> Column:
    """The feed's time stamps, with or without fractions of a second; null where neither form fits."""
    # A form that fails costs an exception, so each text is tried in the one form that it can have.
    split, whole = (F.try_to_timestamp(text, F.lit(form)) for form in ("yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss"))
    return F.when(F.contains(text, F.lit(".")), split).otherwise(whole)
