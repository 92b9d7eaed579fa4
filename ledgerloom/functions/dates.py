"""Column expressions on time.  Block indices count from January of ``base_year``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import ORIGIN, US_HOLIDAYS

BASE_YEAR = 2017
DAY = 86400


def from_seconds(c: Column, origin: str = ORIGIN) -> Column:
    """Time of a number of seconds since ``origin``, both without a zone: no clock change shifts it."""
    return F.timestamp_add("SECOND", c.cast("bigint"), F.lit(origin).cast("timestamp_ntz"))


def epoch(ts: Column, unit: str = "SECOND") -> Column:
    """Whole units since 1970 of a time without a zone."""
    return F.timestamp_diff(unit, F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def month_idx(ts: Column, base_year: int = BASE_YEAR) -> Column:
    return (F.year(ts) - base_year) * 12 + F.month(ts)


def week_idx(ts: Column, base_year: int = BASE_YEAR) -> Column:
    """Calendar year with ISO week: around New Year blocks can repeat or jump, as defined."""
    return (F.year(ts) - base_year) * 52 + F.weekofyear(ts)


def day_idx(ts: Column, base_year: int = BASE_YEAR) -> Column:
    return (F.year(ts) - base_year) * 365 + F.dayofyear(ts)


def hour(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def day_of_month(ts: Column) -> Column:
    return F.day(ts)


def is_december(ts: Column) -> Column:
    return (F.month(ts) == 12).cast("int")


def is_holiday(ts: Column) -> Column:
    """1 on a federal holiday of the covered range (a constant set, no join)."""
    days = [F.lit(d).cast("date") for d in US_HOLIDAYS]
    return F.coalesce(F.to_date(ts).isin(*days), F.lit(False)).cast("int")


def raw_day_of_week(seconds: Column) -> Column:
    """Weekday counted on raw seconds, shifted by one day, with a floored remainder."""
    return F.floor(F.pmod(seconds / DAY - 1, F.lit(7.0))).cast("int")


def raw_hour(seconds: Column) -> Column:
    return F.pmod(F.floor(seconds / 3600), F.lit(24)).cast("int")


def calendar(ts: Column, base_year: int = BASE_YEAR) -> dict[str, Column]:
    """All calendar features of one timestamp, for a single ``withColumns``."""
    return {
        "DT_M": month_idx(ts, base_year),
        "DT_W": week_idx(ts, base_year),
        "DT_D": day_idx(ts, base_year),
        "DT_hour": hour(ts),
        "DT_day_week": day_of_week(ts),
        "DT_day_month": day_of_month(ts),
        "is_december": is_december(ts),
        "is_holiday": is_holiday(ts),
    }
