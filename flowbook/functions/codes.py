"""Codes, labels and localized numbers as Spark columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def pad_code(code: Column | str, width: int, *, numeric_only: bool = False, only_short: bool = False) -> Column:
    """Left-pad a code with zeros.

    ``numeric_only`` pads positive numbers and leaves other codes (``A7``) alone; the
    test uses ``try_cast``, so a text code is not an error under ANSI.  ``only_short``
    leaves codes longer than ``width`` alone, where ``lpad`` would cut them.
    """
    text = _col(code).cast("string")
    padded = F.lpad(text, width, "0")
    if numeric_only:
        padded = F.when(text.try_cast("double") > 0, padded).otherwise(text)
    if only_short:
        padded = F.when(F.length(text) < width, padded).otherwise(text)
    return padded


def parse_number(text: Column | str, decimal_sep: str = ",", type_: str = MONEY) -> Column:
    """``"1 234,50"`` -> 1234.50; anything that is not a number becomes null."""
    compact = F.regexp_replace(_col(text).cast("string"), r"[\s  ]", "")
    return F.regexp_replace(compact, "\\" + decimal_sep, ".").try_cast(type_)


def money(amount: Column | str) -> Column:
    """An amount as an exact decimal, so that sums do not depend on their order."""
    return _col(amount).cast(MONEY)


def truncated(amount: Column | str) -> Column:
    """Whole units towards zero (the optional integer view of a position)."""
    return _col(amount).try_cast("double").cast("bigint")


def coalesced_name(parts: Sequence[Column | str], fallback: Column | str) -> Column:
    """Name parts joined by a space, or the fallback when every part is missing.

    ``concat_ws`` never returns null, so the emptiness of its result is tested instead.
    """
    joined = F.trim(F.concat_ws(" ", *[_col(p) for p in parts]))
    return F.coalesce(F.nullif(joined, F.lit("")), _col(fallback))


def split_item(text: Column | str, separator: str, position: int) -> Column:
    """The n-th part (from 1) of a separated text; null where there are fewer parts."""
    parts = F.split(_col(text), separator)
    return F.try_element_at(parts, F.lit(position))


def repaired_contract(contract: Column | str, applies: Column) -> Column:
    """Drop a trailing ``92`` suffix from padded contract numbers where ``applies`` holds."""
    number = _col(contract)
    suffixed = applies & (F.substring(number, 15, 2) == "92")
    return F.when(suffixed, F.lpad(F.substring(number, 1, 14), 16, "0")).otherwise(number)


def composite_key(*parts: Column | str) -> Column:
    """Codes glued together; missing parts count as empty."""
    return F.concat_ws("", *[_col(p) for p in parts])


def parsed_date(text: Column | str, pattern: str = "dd/MM/yyyy") -> Column:
    """A date from text; unreadable text becomes null."""
    return F.try_to_date(_col(text).cast("string"), pattern)


def filled(value: Column | str, default: object) -> Column:
    """The value, or the default where it is null."""
    return F.coalesce(_col(value), F.lit(default))


def blank_to(value: Column | str, default: str) -> Column:
    """An empty text replaced by a default; null stays null."""
    text = _col(value)
    return F.when(text == "", default).otherwise(text)
