"""Date columns. Nothing here reads the clock: callers pass ``as_of``."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default effective dates and the open end of a version.
EFFECTIVE_DEFAULT = "2000-01-01"
NEUTRAL_DEFAULT = "1900-01-01"
OPEN_END = "2099-12-31"
CALENDAR_START = "2000-01-01"
CALENDAR_END = "2099-12-31"


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def parse_instant(c: Column) -> Column:
    """Unreadable text becomes NULL (no ANSI error)."""
    return c.cast("string").try_cast("timestamp_ntz")


def date_key(c: Column) -> Column:
    """yyyymmdd as an integer, by arithmetic."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def season(month: Column, autumn: str = "Fall", unknown: str | None = "Unknown") -> Column:
    named = (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .when(month.isin(9, 10, 11), autumn)
    )
    return named if unknown is None else named.otherwise(unknown)


def season_of(c: Column, **kw) -> Column:
    return season(F.month(c), **kw)


def weekday0(c: Column) -> Column:
    """Monday = 0."""
    return F.weekday(c)


def weekday1(c: Column) -> Column:
    """Monday = 1."""
    return F.weekday(c) + 1


def weekend_flag(c: Column) -> Column:
    return F.when(F.weekday(c) >= 5, 1).otherwise(0)


def month_end_flag(c: Column) -> Column:
    return F.when(F.dayofmonth(c) > 25, 1).otherwise(0)


def quarter_end_flag(c: Column) -> Column:
    return F.when(F.month(c).isin(3, 6, 9, 12), 1).otherwise(0)


def fiscal_period(c: Column) -> Column:
    return F.format_string("%d-P%02d", F.year(c), F.month(c))


def cyclic(c: Column, period: int) -> tuple[Column, Column]:
    angle = c * (2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def _second_of_day(c: Column) -> Column:
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.date_part(F.lit("SECOND"), c)


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two instants, rounded down (-6 h gives -1).

    Counted midnights, less one when the later clock time is the smaller one, so
    the result does not depend on the session time zone.
    """
    behind = F.when(_second_of_day(later) < _second_of_day(earlier), 1).otherwise(0)
    return F.datediff(later, earlier) - behind


def midnights(later: Column, earlier: Column) -> Column:
    """Midnights crossed between two instants."""
    return F.datediff(later, earlier)


def plus_days(c: Column, days: Column) -> Column:
    """Instant plus a possibly fractional number of days."""
    return c + F.make_dt_interval(secs=F.round(days * 86400, 6))


def effective_date(*candidates: Column, default: str = EFFECTIVE_DEFAULT) -> Column:
    """First readable candidate, else the default."""
    return F.coalesce(*[parse_instant(c) for c in candidates], instant(default))


def without_epoch_year(c: Column) -> Column:
    """Dates in 1970 stand for 'unknown'."""
    return F.when(F.year(c) != 1970, c)


def overdue_flag(due: Column, as_of: Column) -> Column:
    return F.when(as_of > due, 1).otherwise(0)
