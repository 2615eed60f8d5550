"""Checks that are queries: totals before and after, allowed values, unmatched labels."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def control_totals(before: DataFrame, after: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Total and row count per period before and after a step, with their differences."""
    def side(df: DataFrame, name: str) -> DataFrame:
        amounts = {"before": F.lit(None).cast("decimal(18,2)"), "after": F.lit(None).cast("decimal(18,2)")}
        amounts[name] = F.col(measure).cast("decimal(18,2)")
        return df.select(*keys, *[c.alias(n) for n, c in amounts.items()], F.lit(name).alias("side"))

    zero = F.lit(0)
    totals = side(before, "before").unionByName(side(after, "after")).groupBy(*keys).agg(
        F.coalesce(F.sum("before"), zero).alias("total_before"),
        F.coalesce(F.sum("after"), zero).alias("total_after"),
        F.count_if(F.col("side") == "before").alias("rows_before"),
        F.count_if(F.col("side") == "after").alias("rows_after"),
    )
    return totals.withColumns({
        "total_change": F.col("total_after") - F.col("total_before"),
        "rows_change": F.col("rows_after") - F.col("rows_before"),
    })


def domain_check(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Values outside the allowed list, with their row counts; null is outside."""
    bad = F.col(column).isNull() | ~F.col(column).isin(*allowed)
    return df.filter(bad).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def unclassified(df: DataFrame, label: str, sentinels: Sequence[str], measure: str) -> DataFrame:
    """Rows and amount per label that a rule table left on a default."""
    return df.filter(F.col(label).isin(*sentinels)).groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(measure).alias("amount")
    )


@dataclass(frozen=True)
class Controls:
    """What is measured on a frame while another job reads it, in place of a second read of the frame.

    ``totals`` sums ``measure`` and counts rows for each listed member of ``key``, with the rest under null;
    ``domains`` counts rows outside a column's list; ``file_column`` collects the names of the files read (as many as files).
    """

    measure: str | None = None
    key: str | None = None
    members: Sequence = ()
    domains: Mapping[str, Sequence] = field(default_factory=dict)
    file_column: str | None = None
    worst: int = 100

    def watched(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """The frame, and what is known of it once an action on it has ended."""
        metrics = [F.count(F.lit(1)).alias("rows")]
        if self.key is not None:
            key = F.col(self.key)
            rest = key.isNull() | ~key.isin(*self.members)
            for n, inside in enumerate([*[key == m for m in self.members], rest]):
                metrics += [F.count_if(inside).alias(f"rows_{n}")]
                if self.measure is not None:
                    metrics += [F.sum(F.when(inside, F.col(self.measure).cast("decimal(18,2)"))).alias(f"total_{n}")]
        for n, (column, allowed) in enumerate(self.domains.items()):
            bad = F.col(column).isNotNull() & ~F.col(column).isin(*allowed)
            metrics += [
                F.count_if(F.col(column).isNull()).alias(f"null_{n}"), F.count_if(bad).alias(f"bad_{n}"),
                F.call_function("approx_top_k", F.when(bad, F.col(column).cast("string")).otherwise(F.lit("")), F.lit(self.worst + 1)).alias(f"worst_{n}"),
            ]
        if self.file_column is not None:
            metrics += [F.collect_set(self.file_column).alias("files")]
        observation = Observation()
        return df.observe(observation, *metrics), observation

    def totals(self, observation: Observation) -> dict:
        """Member (null for the rest) -> total and rows; members without rows are left out."""
        found = observation.get
        out = {m: (found.get(f"total_{n}"), found[f"rows_{n}"]) for n, m in enumerate([*self.members, None])}
        return {m: (total, n) for m, (total, n) in out.items() if n}

    def violations(self, observation: Observation) -> list[tuple]:
        """Column, value and rows of values outside a list, the ``worst`` most frequent ones; null is outside."""
        found, out = observation.get, []
        for n, column in enumerate(self.domains):
            named = [(column, r["item"], r["count"]) for r in found[f"worst_{n}"] if r["item"] not in (None, "")]
            blank = found[f"bad_{n}"] - sum(r[2] for r in named)
            out += named + ([(column, "", blank)] if blank and len(named) < self.worst else [])
            out += [(column, None, found[f"null_{n}"])] if found[f"null_{n}"] else []
        return out


def written_with_controls(
    before: DataFrame, step: Callable[[DataFrame], DataFrame], folder: str, controls: Controls, after: Controls | None = None,
) -> tuple[DataFrame, tuple[Controls, Observation], tuple[Controls, Observation]]:
    """Run a step, write its result, and measure the frame before and after it in the same job.

    A task that runs again after a lost executor may be measured twice.  The rows seen after the step are therefore
    compared with the rows stored (read from the files' footers); if they differ, or fewer rows came in than the step
    reports, both frames are measured again by reading them.
    """
    then = after or replace(controls, domains={}, file_column=None)
    source, first = controls.watched(before)
    result, second = then.watched(step(source))
    result.write.mode("overwrite").parquet(folder)
    stored = before.sparkSession.read.schema(result.schema).parquet(folder)
    if second.get["rows"] != stored.count():
        again, first = controls.watched(before)
        again.write.format("noop").mode("overwrite").save()
        again, second = then.watched(stored)
        again.write.format("noop").mode("overwrite").save()
    return stored, (controls, first), (then, second)


def observed_totals(spark: SparkSession, name: str, before: tuple[Controls, Observation], after: tuple[Controls, Observation]) -> DataFrame:
    """The report of ``control_totals`` from two observations: a row per member that has rows on either side."""
    sides = [c.totals(o) for c, o in (before, after)]
    zero = (Decimal("0.00"), 0)
    rows = []
    for member in dict.fromkeys([*sides[0], *sides[1]]):
        (a, n), (b, m) = (s.get(member, zero) for s in sides)
        a, b = a or zero[0], b or zero[0]
        rows.append((member, a, b, n, m, b - a, m - n))
    schema = f"{name} string, total_before decimal(28,2), total_after decimal(28,2), rows_before long, rows_after long, total_change decimal(28,2), rows_change long"
    return spark.createDataFrame(rows, schema)
