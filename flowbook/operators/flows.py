"""Amount operators on classified flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import group_totals


def units_times_price(units: str, price: str) -> Column:
    return F.round(F.col(units) * F.col(price), 2)


def gross_up(df: DataFrame, part: str, whole: str, group: Sequence[str], name: str) -> DataFrame:
    """Spread a whole over the parts of a group: ``part * whole / sum(part)``.

    A group whose parts sum to 0, or a missing input, gives 0.
    """
    totalled = group_totals(df, group, {"__sum": F.sum(part)})
    share = F.try_divide(F.col(part) * F.col(whole), F.col("__sum"))
    return totalled.withColumn(name, F.coalesce(share, F.lit(0))).drop("__sum")


def sign_normalised(amount: str, outflow: Column) -> Column:
    """Outflows booked as negative amounts become positive."""
    return F.when(outflow, -F.col(amount)).otherwise(F.col(amount))


def switch_nature(group: str, amount: str, act: str, switch: str, excluded_act: str, out_label: str, in_label: str) -> Column:
    """Direction of a switch from the sign of its amount; other rows keep their act."""
    is_switch = (F.col(group) == switch) & (F.col(act) != excluded_act)
    return (
        F.when(is_switch & (F.col(amount) < 0), out_label)
        .when(is_switch & (F.col(amount) > 0), in_label)
        .otherwise(F.col(act))
    )


def split_by_label(measure: str, label: str, values: Sequence[str]) -> dict[str, Column]:
    """``measure_<value>`` columns: the measure where the label has that value, else 0."""
    return {f"{measure}_{v}": F.when(F.col(label) == v, F.col(measure)).otherwise(0) for v in values}


def net_inflow(inflow: str, outflow: str, switch_in: str, switch_out: str) -> Column:
    return F.col(inflow) - F.col(outflow) + F.col(switch_in) - F.col(switch_out)


def new_business(effect: str, year: int, inflow: str) -> Column:
    return F.when(F.year(F.col(effect)) == year, F.col(inflow)).otherwise(0)


def new_contract(effect: str, year: int, counted: str) -> Column:
    """1 on the counted row of a contract that took effect in the year."""
    return F.when((F.col(counted) == 1) & (F.year(F.col(effect)) == year), 1).otherwise(0)


def period_columns(year_col: str, month_col: str, value: str, year: int, month: int) -> dict[str, Column]:
    """The value in year N to the month, N-1 to the month, whole N-1 and whole N-2."""
    y, m, v = F.col(year_col), F.col(month_col), F.col(value)

    def when(condition: Column) -> Column:
        return F.when(condition, v).otherwise(0)

    return {
        "MT_REEL_MOIS_N": when((y == year) & (m <= month)),
        "MT_REEL_MOIS_N_1": when((y == year - 1) & (m <= month)),
        "MT_REEL_ANNEE_N_1": when(y == year - 1),
        "MT_REEL_ANNEE_N_2": when(y == year - 2),
    }


def period_sums(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in columns.items()])


def status_count(counter: str, status: str, statuses: Sequence[str], inflow: str) -> Column:
    """Sum of the counter over rows with a listed status or some inflow."""
    counted = F.col(status).isin(*statuses) | (F.col(inflow) > 0)
    return F.sum(F.when(counted, F.col(counter)).otherwise(0))


def motive_flags(df: DataFrame, keys: Sequence[str], flags: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """1/0 flags from motive codes, one row per key however many rows it has."""
    return df.groupBy(*keys).agg(
        *[F.max(F.coalesce(F.col(c).isin(*codes), F.lit(False)).cast("int")).alias(n) for n, (c, codes) in flags.items()]
    )


def scaled(amount: str, unit: int = 1000) -> Column:
    return F.col(amount) / unit
