"""Reporting periods and calendar arithmetic.

``Period`` holds the parameters of a run.  The functions below it work on date columns,
so a calendar can be derived for as many rows as there are, without a driver loop and
without reading the clock.
"""

from __future__ import annotations

import calendar as _calendar
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """One reporting month of one year."""

    year: int
    month: int

    @classmethod
    def parse(cls, yyyymm: str) -> Period:
        return cls(int(yyyymm[:4]), int(yyyymm[4:6]))

    @property
    def key(self) -> str:
        return f"{self.year:04d}{self.month:02d}"

    @property
    def start(self) -> dt.date:
        return dt.date(self.year, 1, 1)

    @property
    def month_start(self) -> dt.date:
        return dt.date(self.year, self.month, 1)

    @property
    def end(self) -> dt.date:
        return dt.date(self.year, self.month, _calendar.monthrange(self.year, self.month)[1])

    @property
    def previous_year_end(self) -> dt.date:
        return dt.date(self.year - 1, 12, 31)

    @property
    def previous(self) -> Period:
        return Period(self.year - 1, 12) if self.month == 1 else Period(self.year, self.month - 1)


def day(value: dt.date | str | Column) -> Column:
    """A date literal, or a column taken as a date."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(value).cast("date")


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyyMM")


def year_end_before(date: Column) -> Column:
    """31 December of the year before the date's year."""
    return F.date_sub(F.trunc(date, "year").cast("date"), 1)


def last_weekday_before_year(date: Column) -> Column:
    """Last Monday-to-Friday day of the previous year."""
    last = year_end_before(date)
    return F.date_sub(last, F.greatest(F.weekday(last) - 4, F.lit(0)))


def monday_after_month_start(date: Column) -> Column:
    """First Monday strictly after the first of the date's month."""
    return F.next_day(F.trunc(date, "month"), "MON")


def working_day_before(date: Column, steps: int, working_days: int = 6) -> Column:
    """The n-th working day strictly before the date.

    ``working_days`` is how many days of the week count, from Monday; 6 includes
    Saturday (the inherited convention), 5 is Monday to Friday.
    """
    reach = steps + 7 * (1 + steps // working_days)
    candidates = F.transform(F.sequence(F.lit(1), F.lit(reach)), lambda n: F.date_sub(date, n.cast("int")))
    return F.element_at(F.filter(candidates, lambda d: F.weekday(d) < working_days), steps)


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by Gauss's rule, valid for the years 1900 to 2099."""
    d = (year % 19 * 19 + 24) % 30
    e = (year % 4 * 2 + year % 7 * 4 + d * 6 + 5) % 7
    shift = d + e
    late = ((d == 29) & (e == 6)) | ((d == 28) & (e == 6) & (year % 19 > 10))
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), F.when(late, shift - 7).otherwise(shift).cast("int"))


# Public holidays with a fixed date (month, day), then those counted from
# Easter Sunday (days after it).  31 December counts as a holiday for the cut-off.
FIXED_HOLIDAYS = ((1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25), (12, 31))
EASTER_HOLIDAYS = (1, 39, 50)


def holidays(year: Column) -> Column:
    """Array of the holidays of a year."""
    fixed = [F.make_date(year, F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
    moving = [F.date_add(easter_sunday(year), n) for n in EASTER_HOLIDAYS]
    return F.array(*fixed, *moving)


def late_weekday_holidays(date: Column, after_day: int = 25) -> Column:
    """How many holidays of the date's month fall on a weekday after the given day."""
    def counts(holiday: Column) -> Column:
        return (
            (F.month(holiday) == F.month(date))
            & (F.dayofmonth(holiday) > after_day)
            & (F.weekday(holiday) < 5)
        )

    return F.size(F.filter(holidays(F.year(date)), counts))


def cutoff_date(date: Column) -> Column:
    """Month end minus 3 days (Thursday, Friday), 4 (Saturday) or 5 (other days), minus late holidays."""
    end = F.last_day(date)
    weekday = F.weekday(end)
    back = F.when(weekday.isin(3, 4), 3).when(weekday == 5, 4).otherwise(5)
    return F.date_sub(end, back + late_weekday_holidays(date))


def month_starts(first_year: int, last_year: int) -> Column:
    """Array of ``yyyyMM01`` keys of every month from the first to the last year."""
    months = F.sequence(F.lit(dt.date(first_year, 1, 1)), F.lit(dt.date(last_year, 12, 1)), F.expr("interval 1 month"))
    return F.transform(months, lambda m: F.date_format(m, "yyyyMMdd"))


def previous_month(date: Column) -> Column:
    """First day of the month before."""
    return F.add_months(F.trunc(date, "month"), -1)


def week_of_quarter_iso(date: Column) -> Column:
    """Difference of ISO week numbers, as inherited: it goes negative around New Year."""
    quarter_week = F.weekofyear(F.date_add(F.trunc(date, "quarter"), 1))
    return F.weekofyear(date) - quarter_week + 1


def week_of_quarter(date: Column) -> Column:
    """Calendar weeks (from Monday) since the one that holds the first day of the quarter, from 1."""
    def monday(d: Column) -> Column:
        return F.date_sub(d, F.weekday(d))

    days = F.datediff(monday(date), monday(F.trunc(date, "quarter")))
    return (days / 7).cast("int") + 1


def contract_age(effect: Column, year: Column) -> Column:
    """Years from the effect date to 1 January of the given year (negative for later contracts)."""
    return F.datediff(F.make_date(year, F.lit(1), F.lit(1)), effect) / 365.25


def age_in_year(birth: Column, year: int | Column) -> Column:
    year = F.lit(year) if isinstance(year, int) else year
    return year - F.year(birth)
