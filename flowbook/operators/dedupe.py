"""One trusted row per key.

The reference often sorts and then drops duplicates, which does not promise which row
stays.  Here an order is required.  ``row_number() = 1`` lets Spark cut each group
to its best row before the shuffle (``WindowGroupLimit``), so a hot key costs one row
per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RANK = "__rank"


def ordering(order_by: Sequence[Column | str]) -> list[Column]:
    """Names become ascending columns with nulls last."""
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order_by]


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each key in the given order."""
    if not order_by:
        raise ValueError("one_per_key needs an order: without one the kept row is arbitrary")
    window = W.partitionBy(*keys).orderBy(*ordering(order_by))
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def all_newest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Keep every row tied for first place."""
    window = W.partitionBy(*keys).orderBy(*ordering(order_by))
    return df.withColumn(_RANK, F.dense_rank().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def label_per_code(df: DataFrame, code: str, label: str, prefer: Column) -> DataFrame:
    """One label per code: the one with the greatest preference, then the smallest label."""
    return one_per_key(df.select(code, label, prefer.alias("__prefer")), [code], [
        F.col("__prefer").desc_nulls_last(), F.col(label).asc_nulls_last(),
    ]).drop("__prefer")


def flag_one_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], flag: str, active: str | None = None
) -> DataFrame:
    """Add 1 on the first row of each key and 0 on the others.

    The first row is found by a partial aggregate and joined back, so rows of a hot key
    are not gathered in one window.  ``order_by`` must tell the rows of a key apart;
    rows equal in all of it are all flagged.  With ``active``, keys over which that expression
    adds up to 0 are dropped by the same aggregate and join.
    """
    first = first_per_key(df, keys, order_by, active)
    joined = null_safe_join(df, first, keys, "left" if active is None else "inner")
    return joined.withColumn(flag, _nulls_last(order_by).eqNullSafe(F.col("__first")).cast("int")).drop("__first")


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], active: str | None = None) -> DataFrame:
    """The keys, and in ``__first`` the values of ``order_by`` in each key's first row, a flag for null before each of them.

    With ``active``, keys over which that expression adds up to 0 are left out.
    """
    totals = [] if active is None else [F.expr(f"sum({active}) AS __total")]
    first = df.groupBy(*keys).agg(F.min(_nulls_last(order_by)).alias("__first"), *totals)
    return first if active is None else first.filter("__total <> 0").drop("__total")


def _nulls_last(order_by: Sequence[str]) -> Column:
    return F.expr("struct(" + ", ".join(f"`{c}` IS NULL, `{c}`" for c in order_by) + ")")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys match each other; keys come from the left side."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def null_safe_order(keys: Sequence[str]) -> list[Column]:
    """The order of text keys in which Spark merges the sides of ``null_safe_join``: a null stands behind the empty text."""
    return [c for k in keys for c in (F.coalesce(k, F.lit("")), F.isnull(k))]


def group_totals(df: DataFrame, keys: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """Attach aggregates of a group to each of its rows (a whole-partition window).

    It is an aggregate with map-side combine joined back, so that adaptive execution can split
    a hot group; a window would hold it in one task.
    """
    summed = df.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
    return null_safe_join(df, summed, keys, "left")


def current_else_archive(
    current: DataFrame,
    archive: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    status_col: str,
    archived_status: str,
    source_col: str | None = None,
) -> DataFrame:
    """The current row of each key, else its archived row with a marked status.

    Sources are ranked instead of tested by status, so a current row with a null status
    stays.  ``source_col`` keeps the rank: 0 for current, 1 for archived.
    """
    rank = source_col or "__source"
    live = current.withColumn(rank, F.lit(0))
    old = archive.withColumns({status_col: F.lit(archived_status), rank: F.lit(1)})
    picked = one_per_key(live.unionByName(old), keys, [rank, *order_by])
    return picked if source_col else picked.drop(rank)
