"""Calendar operators over the dates found in the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from .registry import query, shown, table

DAYS = "d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)"
EASTER = """
ev AS (SELECT d, year(d) AS y FROM d),
e1 AS (SELECT DISTINCT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM ev),
e2 AS (SELECT *, b // 4 AS dd, b % 4 AS e, (b - ((b + 8) // 25) + 1) // 3 AS g, c // 4 AS i, c % 4 AS k FROM e1),
e3 AS (SELECT *, (19 * a + b - dd - g + 15) % 30 AS h FROM e2),
e4 AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM e3),
e5 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM e4),
easter AS (SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, ((h + l - 7 * m + 114) % 31) + 1) AS sunday FROM e5),
hol AS (SELECT y, make_date(y, mm, dd) AS h FROM easter,
          (VALUES (1,1),(5,1),(5,8),(7,14),(8,15),(11,1),(11,11),(12,25),(12,31)) v(mm, dd)
        UNION ALL SELECT y, CAST(sunday + CAST(n AS INTEGER) AS DATE) FROM easter, (VALUES (1),(39),(50)) v(n)),
late AS (SELECT y, month(h) AS m, COUNT(*) AS n FROM hol WHERE day(h) > 25 AND isodow(h) < 6 GROUP BY ALL)
"""


def days(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("d")).distinct()


@query("period_bounds", f"""
WITH {DAYS}
SELECT d, CAST(date_trunc('year', d) AS DATE) AS year_start, last_day(d) AS month_end,
       CAST(date_trunc('year', d) AS DATE) - 1 AS previous_year_end, strftime(d, '%Y%m') AS month_key,
       CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE) AS previous_month, CAST(quarter(d) AS BIGINT) AS quarter_no
FROM d
""")
def period_bounds(spark, sf_dir):
    d = F.col("d")
    return shown(days(spark, sf_dir).select(
        "d",
        F.trunc(d, "year").alias("year_start"),
        F.last_day(d).alias("month_end"),
        cal.year_end_before(d).alias("previous_year_end"),
        cal.month_key(d).alias("month_key"),
        cal.previous_month(d).alias("previous_month"),
        F.quarter(d).alias("quarter_no"),
    ))


@query("last_weekday_prev_year", f"""
WITH {DAYS}, e AS (SELECT d, CAST(date_trunc('year', d) AS DATE) - 1 AS ye FROM d)
SELECT d, (SELECT MAX(CAST(ye - CAST(n AS INTEGER) AS DATE)) FROM (VALUES (0),(1),(2)) v(n) WHERE isodow(ye - CAST(n AS INTEGER)) <= 5) AS last_weekday
FROM e
""")
def last_weekday_prev_year(spark, sf_dir):
    return days(spark, sf_dir).select("d", cal.last_weekday_before_year(F.col("d")).alias("last_weekday"))


@query("next_monday", f"""
WITH {DAYS}, m AS (SELECT d, CAST(date_trunc('month', d) AS DATE) AS f FROM d)
SELECT d, CAST(f + CAST(8 - isodow(f) AS INTEGER) AS DATE) AS monday FROM m
""")
def next_monday(spark, sf_dir):
    return days(spark, sf_dir).select("d", cal.monday_after_month_start(F.col("d")).alias("monday"))


@query("business_days_back", f"""
WITH {DAYS}, e AS (SELECT d, CAST(date_trunc('year', d) AS DATE) - 1 AS ye FROM d),
c AS (SELECT d, CAST(ye - CAST(n AS INTEGER) AS DATE) AS back FROM e, range(1, 15) r(n)),
r AS (SELECT d, back, isodow(back) AS w, ROW_NUMBER() OVER (PARTITION BY d, isodow(back) <= 6 ORDER BY back DESC) AS n6,
        ROW_NUMBER() OVER (PARTITION BY d, isodow(back) <= 5 ORDER BY back DESC) AS n5 FROM c)
SELECT d, MAX(CASE WHEN w <= 6 AND n6 = 4 THEN back END) AS with_saturday, MAX(CASE WHEN w <= 5 AND n5 = 4 THEN back END) AS weekdays_only
FROM r GROUP BY d
""")
def business_days_back(spark, sf_dir):
    """Fourth working day before 31 December, with and without Saturdays."""
    end = cal.year_end_before(F.col("d"))
    return days(spark, sf_dir).select(
        "d", cal.working_day_before(end, 4).alias("with_saturday"), cal.working_day_before(end, 4, 5).alias("weekdays_only"))


@query("holidays_in_month", f"""
WITH {DAYS}, {EASTER}
SELECT ev.d, easter.sunday AS easter_sunday, CAST(COALESCE(late.n, 0) AS BIGINT) AS late_holidays
FROM ev JOIN easter USING (y) LEFT JOIN late ON late.y = ev.y AND late.m = month(ev.d)
""")
def holidays_in_month(spark, sf_dir):
    d = F.col("d")
    return shown(days(spark, sf_dir).select(
        "d", cal.easter_sunday(F.year(d)).alias("easter_sunday"), cal.late_weekday_holidays(d).alias("late_holidays")))


@query("cutoff_date", f"""
WITH {DAYS}, {EASTER}
SELECT ev.d, CAST(last_day(ev.d) - CAST(CASE WHEN isodow(last_day(ev.d)) IN (4, 5) THEN 3 WHEN isodow(last_day(ev.d)) = 6 THEN 4 ELSE 5 END
         + COALESCE(late.n, 0) AS INTEGER) AS DATE) AS cutoff
FROM ev LEFT JOIN late ON late.y = ev.y AND late.m = month(ev.d)
""")
def cutoff(spark, sf_dir):
    return days(spark, sf_dir).select("d", cal.cutoff_date(F.col("d")).alias("cutoff"))


@query("month_keys", """
WITH b AS (SELECT MIN(year(l_shipdate)) AS y1, MAX(year(l_shipdate)) AS y2 FROM lineitem),
m AS (SELECT strftime(u, '%Y%m%d') AS month_key FROM (SELECT UNNEST(generate_series(make_date(y1, 1, 1), make_date(y2, 12, 1), INTERVAL 1 MONTH)) AS u FROM b)),
l AS (SELECT strftime(l_shipdate, '%Y%m01') AS month_key, COUNT(*) AS n, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY 1)
SELECT month_key, COALESCE(n, 0) AS n, CAST(COALESCE(v, 0) AS DOUBLE) AS amount FROM m LEFT JOIN l USING (month_key)
""")
def month_keys(spark, sf_dir):
    """Every month from the first to the last year of the facts, with what was booked in it."""
    lines = table(spark, sf_dir, "lineitem")
    years = lines.agg(F.year(F.min("l_shipdate")).alias("y1"), F.year(F.max("l_shipdate")).alias("y2"))
    start, stop = F.make_date("y1", F.lit(1), F.lit(1)), F.make_date("y2", F.lit(12), F.lit(1))
    months = years.select(F.explode(F.sequence(start, stop, F.expr("interval 1 month"))).alias("m")).select(
        F.date_format("m", "yyyyMMdd").alias("month_key"))
    booked = lines.groupBy(F.date_format(F.trunc("l_shipdate", "month"), "yyyyMMdd").alias("month_key")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"))
    return shown(months.join(booked, ["month_key"], "left").na.fill(0))


@query("week_of_quarter_legacy", f"""
WITH {DAYS}
SELECT d, CAST(week(d) AS BIGINT) AS iso_week,
       CAST(week(d) - week(CAST(date_trunc('quarter', d) AS DATE) + 1) + 1 AS BIGINT) AS week_no FROM d
""")
def week_of_quarter_legacy(spark, sf_dir):
    d = F.col("d")
    return shown(days(spark, sf_dir).select("d", F.weekofyear(d).alias("iso_week"), cal.week_of_quarter_iso(d).alias("week_no")))


@query("week_of_quarter", f"""
WITH {DAYS}
SELECT d, CAST(date_diff('day', CAST(date_trunc('week', date_trunc('quarter', d)) AS DATE), CAST(date_trunc('week', d) AS DATE)) // 7 + 1 AS BIGINT) AS week_no FROM d
""")
def week_of_quarter(spark, sf_dir):
    return shown(days(spark, sf_dir).select("d", cal.week_of_quarter(F.col("d")).alias("week_no")))


@query("contract_age", """
WITH o AS (SELECT o_orderstatus, o_orderdate, make_date(1999, 1, 1) AS y FROM orders)
SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS effect, CAST(date_diff('day', CAST(o_orderdate AS DATE), y) AS DOUBLE) / 365.25 AS age_years,
       CAST(1999 - year(o_orderdate) AS BIGINT) AS age_in_year, COUNT(*) AS orders
FROM o GROUP BY ALL
""")
def contract_age(spark, sf_dir):
    effect = F.col("o_orderdate").cast("date")
    return shown(table(spark, sf_dir, "orders").groupBy(
        "o_orderstatus", effect.alias("effect"),
        cal.contract_age(effect, F.lit(1999)).alias("age_years"), cal.age_in_year(effect, 1999).alias("age_in_year"),
    ).agg(F.count(F.lit(1)).alias("orders")))
