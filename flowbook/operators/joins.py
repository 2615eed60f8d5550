"""Lookups, header-driven joins and stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedupe import null_safe_join

_DEAL = "__deal"


def unique_dimension(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The dimension with one row per key; a run-time error if a key has two different rows.

    A lookup on a repeated key would multiply facts, so the check is part of the plan.
    Repeats of the same row count as that row; rows with a null key never match and go.

    Rows are dealt by key once.  Grouping them by all columns and counting rows per key are
    hash aggregates on that partitioning, and so is the join behind it; nothing is sorted here.
    The count is a scalar subquery that shares the exchange.
    """
    dealt = dim.dropna(subset=list(keys)).repartition(*keys)
    rows = dealt.distinct()
    message = F.concat(F.lit(f"repeated key {list(keys)}: "), F.to_json(F.struct(*keys)))
    once = F.when(F.col("__rows") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    checked = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(once).agg(F.count(F.lit(1)).alias("__keys"))
    return rows.filter(checked.scalar() >= 0)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str] | None = None,
    fill: Mapping[str, object] | None = None,
    *,
    unique: bool = False,
    spread_nulls: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Left join to a dimension with one row per key.

    ``unique`` says the dimension was already reduced to one row per key; otherwise the
    plan checks it.  No broadcast is forced: Spark broadcasts a side whose measured size
    is below the threshold and shuffles it otherwise.

    Rows with a null key match nothing, yet a shuffled join sends them all to one partition.
    ``spread_nulls`` gives both sides a hash of the key as a further join column, and rows without a
    key a hash of their other columns, so they are dealt like any other rows.

    ``null_safe`` joins as ``null_safe_join`` does, so that a lookup behind such a join on the same keys uses its exchange.
    Rows of the dimension without a key go first: a null key matches nothing here either.
    """
    wanted = list(cols) if cols is not None else [c for c in dim.columns if c not in keys]
    side = dim.select(*keys, *wanted)
    on = list(keys)
    if spread_nulls:
        own = [c for c in df.columns if c not in keys] or on
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        df = df.withColumn(_DEAL, F.when(missing, F.xxhash64(*own)).otherwise(F.xxhash64(*keys)))
        side = side.dropna(subset=on).withColumn(_DEAL, F.xxhash64(*keys))
        on = [*on, _DEAL]
    side = side if unique else unique_dimension(side, on)
    joined = null_safe_join(df, side.dropna(subset=on), on, "left") if null_safe else df.join(side, on, "left").drop(_DEAL)
    if fill:
        joined = joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})
    return joined


@dataclass(frozen=True)
class Lookup:
    """One step of a lookup chain."""

    dim: DataFrame
    keys: Sequence[str]
    cols: Sequence[str] | None = None
    fill: Mapping[str, object] = field(default_factory=dict)
    unique: bool = False
    spread_nulls: bool = False
    null_safe: bool = False


def lookup_chain(df: DataFrame, steps: Sequence[Lookup]) -> DataFrame:
    """Successive lookups on different keys; a later key may come from an earlier step."""
    return reduce(lambda d, s: lookup(d, s.dim, s.keys, s.cols, s.fill, unique=s.unique, spread_nulls=s.spread_nulls, null_safe=s.null_safe), steps, df)


def inline_lookup(spark, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A lookup written in code.  Its size is fixed by the source text, so it is broadcast."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def header_driven(detail: DataFrame, header: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every header with its detail rows; a header without detail stays, with nulls."""
    return header.join(detail, list(keys), "left")


def settled(detail: DataFrame, header: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """Detail rows whose header meets a condition, with the header's columns."""
    return detail.join(header.filter(condition), list(keys), "inner")


def stack(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """UNION ALL by name; every frame must have exactly the given columns with one type each."""
    expected = {c.lower() for c in columns}
    types: dict[str, str] = {}
    for number, frame in enumerate(frames, 1):
        found = {c.lower() for c in frame.columns}
        if found != expected:
            raise ValueError(
                f"frame {number}: missing {sorted(expected - found)}, unexpected {sorted(found - expected)}"
            )
        for name, type_ in frame.dtypes:
            if types.setdefault(name.lower(), type_) != type_:
                raise ValueError(f"frame {number}: {name} is {type_}, expected {types[name.lower()]}")
    return reduce(lambda a, b: a.unionByName(b), [f.select(*columns) for f in frames])


def stack_missing(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column a frame does not have is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
