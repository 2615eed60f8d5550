"""Queries on a hierarchical cube: a fact table and dimensions with level columns.

``CubeSpec`` is an immutable specification.  Every method returns a changed copy, so two
queries that differ in one criterion share the rest, and ``run`` compiles it to one star
join and one aggregate.  ``run_levels`` does so for several specifications at once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import day
from .joins import unique_dimension
from .rules import RuleSet


@dataclass(frozen=True)
class Dimension:
    """A dimension table, its key and the fact column that refers to it."""

    table: DataFrame
    key: str
    fact_key: str


@dataclass(frozen=True)
class CubeSpec:
    """A cube query.  ``grain`` is the prefix of columns shown from the fact itself."""

    fact: DataFrame
    dims: Mapping[str, Dimension]
    value: str
    month_col: str
    grain: str = "maille_fine"
    shown: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    filters: Mapping[str, tuple[str, tuple]] = field(default_factory=dict)
    month_filter: tuple | None = None
    window: tuple[dt.date, dt.date] | None = None
    indicators: Mapping[str, RuleSet] = field(default_factory=dict)

    def _known(self, name: str) -> str:
        if name != self.grain and name not in self.dims:
            raise KeyError(f"unknown dimension {name!r}")
        return name

    def show(self, name: str, *columns: str) -> CubeSpec:
        """Show columns of a dimension; the result has them as ``<dimension>_<column>``."""
        return replace(self, shown={**self.shown, self._known(name): tuple(columns)})

    def where(self, name: str, level: str, values: Sequence) -> CubeSpec:
        """Keep members of one level.  A dimension has one filter column."""
        previous = self.filters.get(self._known(name))
        if previous is not None and previous[0] != level:
            raise ValueError(f"{name} is already filtered on {previous[0]}; use unfiltered({name!r}) first")
        return replace(self, filters={**self.filters, name: (level, tuple(values))})

    def unfiltered(self, name: str) -> CubeSpec:
        return replace(self, filters={k: v for k, v in self.filters.items() if k != name})

    def months(self, values: Sequence) -> CubeSpec:
        """Keep the listed months."""
        return replace(self, month_filter=tuple(values), window=None)

    def ytd(self, date: dt.date) -> CubeSpec:
        """Keep dates from 1 January to the date."""
        return replace(self, window=(dt.date(date.year, 1, 1), date), month_filter=None)

    def indicator(self, name: str, rules: RuleSet) -> CubeSpec:
        """Show a column derived by rules over the joined row as ``indicateur_<name>``."""
        return replace(self, indicators={**self.indicators, name: rules})

    def reset(self) -> CubeSpec:
        return replace(self, shown={}, filters={}, month_filter=None, window=None, indicators={})

    def members(self, name: str, column: str, like: str | None = None) -> DataFrame:
        """Distinct members of a dimension column, case-insensitively matched to a pattern."""
        found = self.dims[name].table.select(column).distinct()
        return found if like is None else found.filter(F.upper(column).like(like.upper()))

    @property
    def output_keys(self) -> list[str]:
        keys = [f"{self.grain}_{c}" for c in self.shown.get(self.grain, ())]
        keys += [f"{n}_{c}" for n in self.dims for c in self.shown.get(n, ())]
        return keys + [f"indicateur_{n}" for n in self.indicators]

    def run(self, having: Column | None = None) -> DataFrame:
        """Sum of the value per shown column, as ``Value``; ``having`` filters shown columns."""
        result = run_levels({"": self}).drop("level")
        return result if having is None else result.filter(having)

    def _on_fact(self) -> tuple:
        """The criteria that the fact itself answers, comparable between specifications."""
        return self.month_filter, self.window, self.filters.get(self.grain)

    def _fact_condition(self) -> Column:
        kept = F.lit(True)
        if self.month_filter is not None:
            kept = kept & F.col(self.month_col).isin(*self.month_filter)
        if self.window is not None:
            kept = kept & F.col(self.month_col).between(day(self.window[0]), day(self.window[1]))
        if self.grain in self.filters:
            level, values = self.filters[self.grain]
            kept = kept & F.col(level).isin(*values)
        return kept


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def run_levels(levels: Mapping[str, CubeSpec], name: str = "level") -> DataFrame:
    """Several specifications of one cube from one scan, one star join and one aggregate.

    ``levels`` names them; the result has the name in the column ``name``, the shown columns of all of them (null where a
    level does not show one) and ``Value``.  A filter that every level has cuts the fact or the dimension before the join;
    one that only some have becomes a flag beside the dimension's columns.  A joined row is repeated once for each level
    it belongs to, with the other levels' columns null, so the aggregate works like grouping sets with a filter for each set.
    """
    specs = list(levels.values())
    base = specs[0]
    if any(s.fact is not base.fact or s.dims != base.dims or (s.value, s.month_col, s.grain) != (base.value, base.month_col, base.grain) for s in specs):
        raise ValueError("levels of one run share the fact, the dimensions, the value and the month column")
    member: list[list[Column]] = [[] for _ in specs]
    rows = base.fact

    wanted = {s._on_fact(): s._fact_condition() for s in specs}
    rows = rows.filter(_any(list(wanted.values())))
    if len(wanted) > 1:
        flags = {criteria: f"__fact{n}" for n, criteria in enumerate(wanted)}
        rows = rows.withColumns({flags[criteria]: F.coalesce(condition, F.lit(False)) for criteria, condition in wanted.items()})
        for own, spec in zip(member, specs):
            own.append(F.col(flags[spec._on_fact()]))

    grain = dict.fromkeys(c for s in specs for c in s.shown.get(base.grain, ()))
    rows = rows.withColumns({f"{base.grain}_{c}": F.col(c) for c in grain})
    for dim_name, dim in base.dims.items():
        columns = dict.fromkeys(c for s in specs for c in s.shown.get(dim_name, ()))
        tests = dict.fromkeys(s.filters[dim_name] for s in specs if dim_name in s.filters)
        if not columns and not tests:
            continue
        every = all(dim_name in s.filters for s in specs)
        kept = {test: F.col(test[0]).isin(*test[1]) for test in tests}
        table = dim.table.filter(_any(list(kept.values()))) if every else dim.table
        flags = {} if every and len(tests) == 1 else {test: f"__{dim_name}{n}" for n, test in enumerate(tests)}
        side = table.select(
            F.col(dim.key).alias("__key"), *[F.col(c).alias(f"{dim_name}_{c}") for c in columns],
            *[F.coalesce(kept[test], F.lit(False)).alias(flag) for test, flag in flags.items()],
        )
        if columns or flags:
            # A repeated member would multiply the value, so it fails.
            side = unique_dimension(side, ["__key"])
        how = ("inner" if columns or flags else "left_semi") if every else "left"
        rows = rows.join(side, rows[dim.fact_key] == side["__key"], how).drop("__key")
        for own, spec in zip(member, specs):
            if dim_name in spec.filters and flags:
                own.append(F.coalesce(F.col(flags[spec.filters[dim_name]]), F.lit(False)))

    if len(specs) > 1:
        numbers = F.array(*[F.when(_all(own), F.lit(n)) for n, own in enumerate(member)])
        rows = rows.withColumn("__level", F.explode(F.array_compact(numbers)))
    else:
        rows = rows.withColumn("__level", F.lit(0))

    def of_level(showing: Sequence[int], column: Column) -> Column:
        return column if len(showing) == len(specs) else F.when(F.col("__level").isin(*showing), column)

    keys: dict[str, Column] = {}
    for key in dict.fromkeys(k for s in specs for k in s.output_keys):
        showing = [n for n, s in enumerate(specs) if key in s.output_keys]
        if key.startswith("indicateur_") and key.removeprefix("indicateur_") in specs[showing[0]].indicators:
            rules = {n: specs[n].indicators[key.removeprefix("indicateur_")] for n in showing}
            same = all(r is rules[showing[0]] for r in rules.values())
            column = rules[showing[0]].column() if same else F.coalesce(*[F.when(F.col("__level") == n, r.column()) for n, r in rules.items()])
        else:
            column = F.col(key)
        keys[key] = of_level(showing, column)
    shown = rows.select("__level", *[c.alias(k) for k, c in keys.items()], F.col(base.value).alias("__value"))
    by = [k for k in keys] if len(specs) == 1 else ["__level", *keys]
    summed = shown.groupBy(*by).agg(F.sum("__value").alias("Value"))
    number = F.lit(0) if len(specs) == 1 else F.col("__level")
    return summed.select(F.element_at(F.array(*[F.lit(n) for n in levels]), number + 1).alias(name), *keys, "Value")
