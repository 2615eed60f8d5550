"""Many reporting months in one job.

The reference builds its pipeline once per month and unions the results.  Here the month
is a key.  Facts are first reduced to one row per key and month; after that every step
touches months, not movements, and its growth per input row is bounded by the number of
reporting months.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import Period
from ..session import computed_once
from ..sources.tables import drop_month, exists, overwrite_report, write_partitions


def _month(date: Column) -> Column:
    return F.trunc(date, "month").cast("date")


def _first(period: Period) -> Column:
    return F.lit(dt.date(period.year, period.month, 1))


def _expand(start: Column, stop: Column) -> Column:
    """One row per month from start to stop; none when stop lies before start."""
    months = F.sequence(start, stop, F.expr("interval 1 month"))
    return F.explode(F.when(start <= stop, months).otherwise(F.array().cast("array<date>")))


def year_to_date(flows: DataFrame, keys: Sequence[str], date_col: str, measures: Sequence[str], first: Period, last: Period) -> DataFrame:
    """Flows from 1 January to the end of each reporting month.

    A month's subtotal counts in every later reporting month of its own year.
    """
    monthly = (
        flows.filter(F.col(date_col).between(F.lit(first.start), F.lit(last.end)))
        .groupBy(*keys, _month(F.col(date_col)).alias("__m"))
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    year_end = F.add_months(F.trunc("__m", "year"), 11)
    reported = monthly.withColumn(
        "period", _expand(F.greatest(F.col("__m"), _first(first)), F.least(year_end, _first(last)))
    )
    return reported.groupBy("period", *keys).agg(*[F.sum(m).alias(m) for m in measures])


def carried_forward(positions: DataFrame, keys: Sequence[str], date_col: str, value: str, first: Period, last: Period) -> DataFrame:
    """The newest valuation of each key at the end of every reporting month.

    A valuation holds until the month before the next one.  The window runs over one row
    per key and month, so a group is never longer than the valued months.
    """
    daily = positions.filter(F.col(date_col) <= F.lit(last.end)).groupBy(*keys, date_col).agg(F.sum(value).alias("__v"))
    monthly = daily.groupBy(*keys, _month(F.col(date_col)).alias("__m")).agg(F.max_by("__v", date_col).alias(value))
    following = F.lead("__m").over(W.partitionBy(*keys).orderBy("__m"))
    held_to = F.coalesce(F.add_months(following, -1), _first(last))
    return (
        monthly.withColumn("__to", F.least(held_to, _first(last)))
        .withColumn("period", _expand(F.greatest(F.col("__m"), _first(first)), F.col("__to")))
        .select("period", *keys, value)
    )


FLOWS, VALUES = "__flows", "__values"


def histories(
    flows: DataFrame,
    flow_date: str,
    measures: Sequence[str],
    positions: DataFrame,
    position_date: str,
    value: str,
    keys: Sequence[str],
    first: Period,
    last: Period,
) -> DataFrame:
    """One row per key with its monthly flows and its newest valuation of each valued month, both as arrays.

    It is what ``reported_months`` needs of a key: as long as the months in which something happened, whatever the
    number of reporting months.
    """
    moved = (
        flows.filter(F.col(flow_date).between(F.lit(first.start), F.lit(last.end)))
        .groupBy(*keys, _month(F.col(flow_date)).alias("__m"))
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    daily = positions.filter(F.col(position_date) <= F.lit(last.end)).groupBy(*keys, position_date).agg(F.sum(value).alias("__v"))
    valued = daily.groupBy(*keys, _month(F.col(position_date)).alias("__m")).agg(F.max_by("__v", position_date).alias("__v"))
    stacked = moved.select(*keys, F.struct("__m", *measures).alias("__flow")).unionByName(
        valued.select(*keys, F.struct("__m", "__v").alias("__value")), allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(F.collect_list("__flow").alias(FLOWS), F.collect_list("__value").alias(VALUES))


def reported_months(
    history: DataFrame, measures: Sequence[str], keys: Sequence[str], first: Period, last: Period, names: tuple[str, str] = ("PM_DEBUT", "PM_FIN"),
) -> DataFrame:
    """The reporting months of each row of ``histories``: year-to-date flows, opening and closing value.

    Every month comes from its key's own row, so the repeated rows pass no shuffle and need not be stored.  ``keys`` are
    the columns kept beside them.
    """
    period = F.col("period")
    year = F.trunc("period", "year")
    months = history.withColumn("period", F.explode(F.sequence(_first(first), _first(last), F.expr("interval 1 month"))))
    known = months.withColumns({
        "__mine": F.filter(FLOWS, lambda e: (e["__m"] >= year) & (e["__m"] <= period)),
        "__opening": F.array_max(F.filter(VALUES, lambda e: e["__m"] < year)),
        "__closing": F.array_max(F.filter(VALUES, lambda e: e["__m"] <= period)),
    }).filter((F.size("__mine") > 0) | F.col("__closing").isNotNull())

    def total(measure: str) -> Column:
        kind = _sum_type(history.select(F.explode(FLOWS).alias("e")).select(f"e.{measure}"), measure)
        zero = F.lit(0).cast(kind)
        added = F.aggregate("__mine", zero, lambda sum_, e: (sum_ + F.coalesce(e[measure], F.lit(0))).cast(kind))
        return F.when(F.size("__mine") > 0, added).otherwise(zero)

    kind = _sum_type(history.select(F.explode(VALUES).alias("e")).select("e.__v"), "__v")
    held = [F.coalesce(F.col(c)["__v"].cast(kind), F.lit(0).cast(kind)).alias(n) for c, n in zip(("__opening", "__closing"), names)]
    return known.select("period", *keys, *[total(m).alias(m) for m in measures], *held)


def _sum_type(df: DataFrame, column: str) -> T.DataType:
    return df.agg(F.sum(column).alias(column)).schema[column].dataType


def backfill(
    flows: DataFrame,
    flow_date: str,
    measures: Sequence[str],
    positions: DataFrame,
    position_date: str,
    value: str,
    keys: Sequence[str],
    first: Period,
    last: Period,
    names: tuple[str, str] = ("PM_DEBUT", "PM_FIN"),
) -> DataFrame:
    """The ledger of every reporting month: year-to-date flows, opening and closing value.

    The opening value of a month is the closing value of the December before its year.
    """
    history = histories(flows, flow_date, measures, positions, position_date, value, keys, first, last)
    return reported_months(history, measures, keys, first, last, names)


def source_fingerprints(spark: SparkSession, root: str, column: str = "func_month") -> DataFrame:
    """``month, files, mark`` of every month of a store, from the listing of its files alone: names, sizes and times."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    month = F.regexp_extract("path", f"/{column}=([^/]+)/", 1)
    file = F.xxhash64(F.element_at(F.split("path", "/"), -1), "length", "modificationTime").cast("decimal(38,0)")
    return listing.select(month.alias("month"), file.alias("file")).filter("month <> ''").groupBy("month").agg(
        F.count("*").alias("files"), F.sum("file").alias("mark"))


def changed_months(now: DataFrame, before: DataFrame) -> DataFrame:
    """Months that are new, gone, or hold other files than before."""
    old = before.select("month", F.col("files").alias("__files"), F.col("mark").alias("__mark"))
    joined = now.join(old, "month", "full")
    return joined.filter(~(F.col("files").eqNullSafe(F.col("__files")) & F.col("mark").eqNullSafe(F.col("__mark")))).select("month")


def later_in_year(changed: Sequence[Period], first: Period, last: Period) -> list[Period]:
    """The reporting months whose year-to-date figures a changed month touches: itself and the later ones of its year."""
    start: dict[int, int] = {}
    for p in changed:
        start[p.year] = min(p.month, start.get(p.year, 12))
    found = [Period(year, month) for year, low in start.items() for month in range(low, 13)]
    return sorted((p for p in found if first.key <= p.key <= last.key), key=lambda p: p.key)


def refresh(
    spark: SparkSession,
    source: str,
    target: str,
    state: str,
    build: Callable[[DataFrame, Period, Period], DataFrame],
    first: Period,
    last: Period,
    column: str = "func_month",
) -> list[Period]:
    """Bring a stored backfill up to date with its monthly source; the reporting months that were computed again.

    ``target`` is stored by ``period``.  ``state`` keeps the source's fingerprints of the last refresh.  Only years with a
    changed month are read, from January to the last touched reporting month, and only touched reporting months are
    replaced: ``build(rows, from, to)`` gives their rows with ``period``.  A touched month that has no rows any more is
    removed.  The state is written last, so a refresh that fails is repeated as a whole.  The list of months is as long
    as the backfill, so it may come to the driver.
    """
    now = computed_once(source_fingerprints(spark, source, column), "fingerprints")
    known = exists(spark, state)
    changed = changed_months(now, spark.read.parquet(state)) if known else now.select("month")
    touched = later_in_year([Period.parse(r["month"]) for r in changed.collect()], first, last)
    for year in sorted({p.year for p in touched}):
        own = [p for p in touched if p.year == year]
        table = spark.read.parquet(source)
        months = [F.lit(Period(year, m).key).cast(table.schema[column].dataType) for m in range(1, own[-1].month + 1)]
        rows = build(table.filter(F.col(column).isin(*months)).drop(column), own[0], own[-1])
        stored = computed_once(rows.withColumn("period", F.date_format("period", "yyyyMM")), "refreshed")
        write_partitions(stored, target, ["period"])
        filled = {r["period"] for r in stored.select("period").distinct().collect()}
        for p in own:
            if p.key not in filled:
                drop_month(spark, target, p, "period")
    overwrite_report(now, state)
    return touched
