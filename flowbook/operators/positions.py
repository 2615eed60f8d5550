"""Snapshots, opening and closing positions, and the ledger that joins them with flows.

Full outer joins lose rows with null keys and need a second aggregate.  Here both sides
are tagged, stacked and summed: one shuffle, with map-side combine, and null keys kept.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import day
from ..session import computed_once
from .dedupe import all_newest, null_safe_join, one_per_key


def as_of(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    limit: dt.date | str | Column,
    *,
    tiebreak: Sequence[Column | str] = (),
    keep_ties: bool = False,
) -> DataFrame:
    """Newest row of each key dated on or before the limit; with ``keep_ties``, all of that date."""
    known = df.filter(F.col(date_col) <= day(limit))
    newest = F.col(date_col).desc_nulls_last()
    if keep_ties:
        return all_newest(known, keys, [newest])
    return one_per_key(known, keys, [newest, *tiebreak])


def as_of_snapshot(df: DataFrame, snapshot_col: str, limit: dt.date | str | Column) -> DataFrame:
    """All rows of the newest whole-table snapshot on or before the limit.

    The newest snapshot is a scalar subquery: one number, and a partition column is pruned by it.
    """
    newest = df.filter(F.col(snapshot_col) <= day(limit)).agg(F.max(snapshot_col))
    return df.filter(F.col(snapshot_col) == newest.scalar())


def summed(df: DataFrame, keys: Sequence[str], measures: Sequence[str], attributes: Mapping[str, str] | None = None) -> DataFrame:
    """Sums of the measures per key, null sums as 0; attributes kept by ``max`` or ``min``."""
    sums = [F.expr(f"coalesce(sum(`{m}`), 0) AS `{m}`") for m in measures]
    extra = [F.expr(f"{how}(`{name}`) AS `{name}`") for name, how in (attributes or {}).items()]
    return df.groupBy(*keys).agg(*sums, *extra)


def summed_repeats(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``summed`` for rows that are seldom equal in their keys: only those that may be are dealt by key and added up.

    A 64-bit hash of the keys that occurs once belongs to one row, whose sums are its own values.  Rows whose hashes
    repeat go through the aggregate, which compares the keys themselves; two keys that share a hash are only looked at in vain.
    The repeated hashes are stored, so that Spark knows how many they are: where they are few, no other row is shuffled.
    """
    hashed = df.withColumn("__hash", F.xxhash64(*keys))
    counted = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1")
    again = computed_once(counted.select(F.col("__hash")), "repeated-keys")
    own = [F.expr(f"coalesce(sum(`{m}`), 0) AS `{m}`") for m in measures]
    types = {f.name: f.dataType for f in df.limit(0).groupBy().agg(*own).schema.fields}
    alone = hashed.join(again, ["__hash"], "left_anti").select(
        *keys, *[F.coalesce(F.col(m).cast(types[m]), F.lit(0).cast(types[m])).alias(m) for m in measures])
    return alone.unionByName(summed(hashed.join(again, ["__hash"], "left_semi"), keys, measures))


def stacked_sum(
    frames: Sequence[DataFrame],
    keys: Sequence[str],
    measures: Sequence[str],
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stack frames that each carry some of the measures, and sum per key."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return summed(union, keys, measures, attributes)


def open_close(
    opening: DataFrame,
    closing: DataFrame,
    keys: Sequence[str],
    value: str,
    names: tuple[str, str] = ("PM_DEBUT", "PM_FIN"),
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Opening and closing value per key; a key found on one side only gets 0 on the other.

    ``attributes`` (name -> max/min) are taken from the closing side.
    """
    kept = list(attributes or {})
    return stacked_sum(
        [
            opening.select(*keys, F.col(value).alias(names[0])),
            closing.select(*keys, *kept, F.col(value).alias(names[1])),
        ],
        keys,
        names,
        attributes,
    )


def snapshot_pair(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    opening: dt.date,
    closing: dt.date,
    opening_cols: Mapping[str, str],
    closing_cols: Mapping[str, str],
    added: Sequence[str],
) -> DataFrame:
    """The values of each key's newest date on or before two limits, from one scan and one shuffle of dated sums.

    The column maps are result name -> source name.  Rows of one key and date are one position: the columns
    ``added`` are summed over them, the others (rates, dates) take the greatest.  Both steps combine on the map side.
    """
    sources = list(dict.fromkeys([*opening_cols.values(), *closing_cols.values()]))
    dated = df.filter(F.col(date_col) <= day(closing)).groupBy(*keys, date_col).agg(
        *[(F.sum(c) if c in added else F.max(c)).alias(c) for c in sources if c != date_col]
    )

    def newest(limit: dt.date, cols: Mapping[str, str]) -> list[Column]:
        when = F.when(F.col(date_col) <= day(limit), F.col(date_col))
        return [F.max_by(source, when).alias(name) for name, source in cols.items()]

    return dated.groupBy(*keys).agg(*newest(opening, opening_cols), *newest(closing, closing_cols))


def newest_pair(
    df: DataFrame, keys: Sequence[str], date_col: str, opening: dt.date, closing: dt.date, flags: tuple[str, str] = ("is_opening", "is_closing"),
) -> DataFrame:
    """Every row of a key's newest date on or before each of two limits, ties kept; two flags say for which limit.

    One aggregate finds both dates and is joined back once.  It holds two dates per key and combines on the map side, so
    no window gathers a key's history.  The rows are stored first, cut to the later limit: their source is read once.
    """
    known = computed_once(df.filter(F.col(date_col) <= day(closing)), "valued-rows")
    opened = F.when(F.col(date_col) <= day(opening), F.col(date_col))
    dates = known.groupBy(*keys).agg(F.max(opened).alias("__opening"), F.max(date_col).alias("__closing"))
    met = null_safe_join(known, dates, keys, "inner")
    own = [F.coalesce(F.col(date_col) == F.col(c), F.lit(False)) for c in ("__opening", "__closing")]
    flagged = met.withColumns(dict(zip(flags, own))).filter(F.col(flags[0]) | F.col(flags[1]))
    return flagged.drop("__opening", "__closing")


def open_close_as_of(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    value: str,
    opening: dt.date,
    closing: dt.date,
    names: tuple[str, str] = ("PM_DEBUT", "PM_FIN"),
) -> DataFrame:
    """Opening and closing value per key from one scan of a valuation history.

    Values of the same key and date are added up; then the newest date on or before each
    limit is taken.  Both steps combine on the map side.
    """
    daily = df.filter(F.col(date_col) <= day(closing)).groupBy(*keys, date_col).agg(F.sum(value).alias("__v"))
    opened = F.when(F.col(date_col) <= day(opening), F.col(date_col))
    return daily.groupBy(*keys).agg(
        F.coalesce(F.max_by("__v", opened), F.lit(0)).alias(names[0]),
        F.coalesce(F.max_by("__v", date_col), F.lit(0)).alias(names[1]),
    )


def ledger(
    flows: DataFrame,
    positions: DataFrame,
    keys: Sequence[str],
    flow_measures: Sequence[str],
    position_measures: Sequence[str] = ("PM_DEBUT", "PM_FIN"),
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Flows and positions on their full key."""
    return stacked_sum([flows, positions], keys, [*flow_measures, *position_measures], attributes)


def ledger_of_groups(
    flows: DataFrame,
    positions: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """``ledger`` for sides that are grouped by the full key already: their rows meet in one null-safe full join.

    A key is at most once on each side, so nothing is summed again and a measure that a side does not have is
    not carried through an aggregate.  ``measures`` are those of both sides.
    """
    sides = {}
    for side, frame in (("f", flows), ("p", positions)):
        kept = [c for c in (*measures, *(attributes or {})) if c in frame.columns]
        sides[side] = kept, frame.select(*[F.col(c).alias(f"__{side}_{c}") for c in (*keys, *kept)])
    condition = reduce(lambda a, b: a & b, [F.col(f"__p_{k}").eqNullSafe(F.col(f"__f_{k}")) for k in keys])

    def found(name: str) -> list[Column]:
        return [F.col(f"__{side}_{name}") for side, (kept, _) in sides.items() if name in kept]

    def merged(name: str, how: str | None) -> Column:
        own = found(name)
        if how is None:
            return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in own]).alias(name)
        pick = F.greatest if how == "max" else F.least
        return (pick(*own) if len(own) > 1 else own[0]).alias(name)

    return sides["p"][1].join(sides["f"][1], condition, "full").select(
        *[F.coalesce(f"__p_{k}", f"__f_{k}").alias(k) for k in keys],
        *[merged(m, None) for m in measures], *[merged(n, how) for n, how in (attributes or {}).items()],
    )


def live_only(positions: DataFrame, contracts: DataFrame, keys: Sequence[str], live: Column) -> DataFrame:
    """Positions of contracts that meet a condition; a semi join never multiplies rows."""
    return positions.join(contracts.filter(live).select(*keys), list(keys), "left_semi")


def activity_total(measures: Sequence[str], mode: str = "signed") -> str:
    """A row's share of its group's activity, as SQL; see ``drop_inactive``."""
    if mode not in ("signed", "absolute"):
        raise ValueError(f"unknown mode {mode!r}")
    terms = [f"coalesce(`{m}`, 0)" for m in measures]
    return " + ".join(f"abs({t})" for t in terms) if mode == "absolute" else " + ".join(terms)


def drop_inactive(
    df: DataFrame, group: Sequence[str], measures: Sequence[str], mode: str = "signed"
) -> DataFrame:
    """Drop whole groups without activity.

    ``signed`` keeps the inherited rule: a group whose amounts cancel out to 0 is dropped.
    ``absolute`` drops only groups in which every amount is 0.  Rows with a null key are a group like any other.
    """
    total = activity_total(measures, mode)
    active = df.groupBy(*group).agg(F.expr(f"sum({total}) AS __total")).filter("__total <> 0").drop("__total")
    return null_safe_join(df, active, group, "left_semi")


def drop_empty_rows(df: DataFrame, label: str, measures: Sequence[str]) -> DataFrame:
    """Drop rows without a label whose measures are all 0 or missing; the null case is written out."""
    some = " OR ".join(f"coalesce(`{m}`, 0) <> 0" for m in measures)
    return df.filter(f"`{label}` IS NOT NULL OR {some}")
