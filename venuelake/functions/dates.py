"""Dates and times. "Now" is always a parameter, so a run can be repeated."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from venuelake import schemas

Moment = date | datetime | Column | None
SECONDS_PER_DAY = 86_400


def moment(as_of: Moment = None) -> Column:
    """``as_of`` as a timestamp column; the current time when not given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp_ntz")


def resolved(as_of: Moment = None) -> Moment:
    """``as_of``, or the time of this call in UTC: the same in all later actions."""
    return datetime.now(timezone.utc).replace(tzinfo=None) if as_of is None else as_of


def day_epoch(day: Column) -> Column:
    """Epoch seconds at the start of a UTC day."""
    return F.unix_date(day).cast("bigint") * SECONDS_PER_DAY


def load_day(as_of: Moment = None) -> Column:
    return day_epoch(F.to_date(moment(as_of)))


def review_time(text: Column) -> Column:
    """``January 5, 2020`` to epoch seconds; null for other text."""
    return day_epoch(F.try_to_date(text, schemas.REVIEW_DATE_FORMAT))


def month(day: Column) -> Column:
    return F.date_format(day, schemas.MONTH_FORMAT)


def age(birthdate: Column, as_of: Moment = None) -> Column:
    """Full years between a birth date in text and ``as_of``; null for unreadable text."""
    born = F.try_to_date(birthdate, schemas.BIRTHDATE_FORMAT)
    return F.floor(F.datediff(F.to_date(moment(as_of)), born) / 365.25)


def age_bucket(years: Column) -> Column:
    """Five-year bucket, the last one open. NaN has a bucket of its own; null and negative none."""
    last = schemas.LAST_AGE_BUCKET
    whole = F.least(F.lit(last), F.floor(years / schemas.AGE_BUCKET_YEARS)).cast("int")
    return F.when(F.isnan(years.cast("double")), last + 1).when(years >= 0, whole)


def hour_minute(as_of: Moment = None) -> Column:
    """Time of day as an ``HHmm`` number."""
    return F.date_format(moment(as_of), "HHmm").cast("int")


def weekday_name(as_of: Moment = None) -> Column:
    return F.date_format(moment(as_of), "EEEE")


def open_now(open_time: Column, close_time: Column, clock: Column, overnight: bool = False) -> Column:
    """Whether ``clock`` (``HHmm``) lies in the opening period, both ends included.

    A period that runs past midnight never matches unless ``overnight`` is set.
    """
    within = (open_time <= clock) & (clock <= close_time)
    if not overnight:
        return within
    past_midnight = (close_time < open_time) & ((clock >= open_time) | (clock <= close_time))
    return within | past_midnight
