import calendar
import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowbook.functions import calendar as cal
from flowbook.functions.calendar import Period


def easter(year):
    """Gregorian computus, independent of the rule under test."""
    a, b, c = year % 19, year // 100, year % 100
    d, e = divmod(b, 4)
    g = (8 * b + 13) // 25
    h = (19 * a + b - d - g + 15) % 30
    i, k = divmod(c, 4)
    l = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 19 * l) // 433
    month = (h + l - 7 * m + 90) // 25
    return dt.date(year, month, (h + l - 7 * m + 33 * month + 19) % 32)


def holidays(year):
    fixed = [dt.date(year, m, d) for m, d in ((1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25), (12, 31))]
    return fixed + [easter(year) + dt.timedelta(days=n) for n in (1, 39, 50)]


@pytest.fixture(scope="module")
def months(spark):
    firsts = [(dt.date(y, m, 1),) for y in range(2000, 2031) for m in range(1, 13)]
    return spark.createDataFrame(firsts, "d date")


def test_calendar_against_brute_force(months):
    d = F.col("d")
    rows = months.select(
        "d", cal.easter_sunday(F.year(d)), cal.late_weekday_holidays(d), cal.cutoff_date(d), cal.monday_after_month_start(d),
        cal.last_weekday_before_year(d), cal.working_day_before(cal.year_end_before(d), 4), cal.working_day_before(cal.year_end_before(d), 4, 5),
    ).collect()
    for first, sunday, late, cutoff, monday, weekday, six, five in rows:
        end = dt.date(first.year, first.month, calendar.monthrange(first.year, first.month)[1])
        off = sum(h.month == first.month and h.day > 25 and h.weekday() < 5 for h in holidays(first.year))
        assert sunday == easter(first.year)
        assert late == off
        assert cutoff == end - dt.timedelta(days={3: 3, 4: 3, 5: 4}.get(end.weekday(), 5) + off)
        assert monday == first + dt.timedelta(days=7 - first.weekday())
        last = dt.date(first.year - 1, 12, 31)
        assert weekday == max(last - dt.timedelta(days=n) for n in range(3) if (last - dt.timedelta(days=n)).weekday() < 5)
        for found, working in ((six, 6), (five, 5)):
            days = [last - dt.timedelta(days=n) for n in range(1, 15)]
            assert found == [x for x in days if x.weekday() < working][3]


def test_weeks_of_quarter(rows):
    df = rows("d date", (dt.date(2022, 1, 10),), (dt.date(2024, 12, 30),), (dt.date(2024, 1, 1),), (dt.date(2024, 3, 31),))
    out = [tuple(r) for r in df.select(cal.week_of_quarter_iso(F.col("d")), cal.week_of_quarter(F.col("d"))).collect()]
    assert [o[0] for o in out[:2]] == [-49, -38]
    assert [o[1] for o in out] == [3, 14, 1, 13]


def test_period_parameters():
    p = Period.parse("202401")
    assert (p.key, p.start, p.end, p.previous_year_end, p.previous) == (
        "202401", dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2023, 12, 31), Period(2023, 12))
    assert Period(2024, 2).end == dt.date(2024, 2, 29)


def test_month_keys_and_ages(spark, rows):
    keys = spark.range(1).select(cal.month_starts(2022, 2023)).first()[0]
    assert len(keys) == 24 and keys[0] == "20220101" and keys[-1] == "20231201"
    df = rows("d date", (dt.date(2023, 6, 1),), (dt.date(2025, 6, 1),))
    ages = [r[0] for r in df.select(cal.contract_age(F.col("d"), F.lit(2024))).collect()]
    assert ages[0] > 0 > ages[1]
    assert rows("d date", (dt.date(2024, 1, 5),)).select(cal.previous_month(F.col("d"))).first()[0] == dt.date(2023, 12, 1)
