"""Rules held as data.

A ``RuleSet`` is an ordered list of (predicate, label) pairs that compiles to one
``CASE WHEN``; the first match wins.  A ``BucketSet`` is a list of (bucket, predicate,
sign) triples that compiles to conditional sums.  Predicates are Spark SQL text, so rule
tables can be kept in a file, printed and reviewed, and need no running session.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FromColumn:
    """A label that is the value of another column (or any SQL expression)."""

    expression: str


NO_DEFAULT = object()


def quoted(value: object) -> str:
    """A SQL literal."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def one_of(column: str, values: Iterable[object]) -> str:
    """``column IN (...)``; text values are trimmed, as a stray space would never match."""
    cleaned = [v.strip() if isinstance(v, str) else v for v in values]
    return f"{column} IN ({', '.join(quoted(v) for v in cleaned)})"


def none_of(column: str, values: Iterable[object]) -> str:
    """``column NOT IN (...)``: null in, no match out."""
    return f"NOT ({one_of(column, values)})"


def has_text(column: str, part: str) -> str:
    return f"contains({column}, {quoted(part)})"


def both(*predicates: str) -> str:
    return "(" + ") AND (".join(predicates) + ")"


def either(*predicates: str) -> str:
    return "(" + ") OR (".join(predicates) + ")"


def _label(value: object) -> str:
    if isinstance(value, RuleSet):
        return value.sql()
    if isinstance(value, FromColumn):
        return f"({value.expression})"
    return quoted(value)


@dataclass(frozen=True)
class RuleSet:
    """Ordered rules; a label may be a constant, ``FromColumn`` or a nested ``RuleSet``."""

    rules: Sequence[tuple[str, object]]
    default: object = NO_DEFAULT

    def sql(self) -> str:
        """The rules as one ``CASE`` expression."""
        if not self.rules:
            return _label(self.default)
        whens = " ".join(f"WHEN {predicate} THEN {_label(label)}" for predicate, label in self.rules)
        default = "" if self.default is NO_DEFAULT else f" ELSE {_label(self.default)}"
        return f"CASE {whens}{default} END"

    def column(self) -> Column:
        return F.expr(self.sql())


def relabel(df: DataFrame, stages: Sequence[tuple[str, RuleSet]]) -> DataFrame:
    """Ordered labelling stages; a later stage sees the columns an earlier one has set."""
    return reduce(lambda frame, stage: frame.withColumn(stage[0], stage[1].column()), stages, df)


@dataclass(frozen=True)
class BucketSet:
    """Amount buckets, with totals and complements computed from the summed buckets.

    ``rules``: (bucket, predicate, sign); within a bucket the first match wins and an
    unmatched row counts 0.  ``totals``: name -> buckets added up.  ``differences``:
    name -> (minuend, subtrahend).  Because sums are linear, totals and differences are
    taken once per group, after the aggregate, not once per row.
    """

    rules: Sequence[tuple[str, str, int]]
    amount: str
    totals: Mapping[str, Sequence[str]] = field(default_factory=dict)
    differences: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def buckets(self) -> list[str]:
        return list(dict.fromkeys(name for name, _, _ in self.rules))

    @property
    def names(self) -> list[str]:
        return [*self.buckets, *self.differences, *self.totals]

    def _case(self, bucket: str) -> str:
        whens = " ".join(
            f"WHEN {predicate} THEN {'' if sign > 0 else '-'}({self.amount})"
            for name, predicate, sign in self.rules if name == bucket
        )
        return f"CASE {whens} ELSE 0 END"

    def columns(self) -> dict[str, Column]:
        """Row-level bucket columns."""
        return {name: F.expr(self._case(name)) for name in self.buckets}

    def classify(self, df: DataFrame) -> DataFrame:
        """Buckets, differences and totals as columns of each row."""
        return self.derive(df.withColumns(self.columns()))

    def sums(self) -> list[Column]:
        return [F.expr(f"coalesce(sum({self._case(name)}), 0) AS {name}") for name in self.buckets]

    def derive(self, df: DataFrame) -> DataFrame:
        """Add differences, then totals, to a frame that has the buckets."""
        if self.differences:
            df = df.selectExpr("*", *[f"{a} - {b} AS {n}" for n, (a, b) in self.differences.items()])
        if self.totals:
            df = df.selectExpr("*", *[f"{' + '.join(parts)} AS {n}" for n, parts in self.totals.items()])
        return df

    def aggregate(self, df: DataFrame, keys: Sequence[str], *extra: Column) -> DataFrame:
        """One row per key with every bucket, difference and total."""
        return self.derive(df.groupBy(*keys).agg(*self.sums(), *extra))


# --- what a rule table says and what it does ----------------------------------------------

_TEXT = r"'(?:[^'\\]|\\.)*'"
_LISTED = re.compile(rf"(\w+) IN \(((?:{_TEXT}|[^')])*)\)")
_COMPARED = re.compile(rf"(\w+) = ({_TEXT})")
_CONTAINED = re.compile(rf"contains\((\w+), ({_TEXT})\)")


@dataclass(frozen=True)
class Literal:
    """A fixed value of a rule: the column it is compared with, and the test as SQL."""

    column: str
    value: str
    test: str


def literals(predicate: str) -> list[Literal]:
    """The text values a predicate names, in its order, each once."""
    found = []
    for match in _LISTED.finditer(predicate):
        found += [(match.start(), match[1], text, "{} = {}") for text in re.findall(_TEXT, match[2])]
    found += [(m.start(), m[1], m[2], "{} = {}") for m in _COMPARED.finditer(predicate)]
    found += [(m.start(), m[1], m[2], "contains({}, {})") for m in _CONTAINED.finditer(predicate)]
    made = [Literal(column, re.sub(r"\\(.)", r"\1", text[1:-1]), form.format(column, text)) for _, column, text, form in sorted(found, key=lambda f: f[0])]
    return list(dict.fromkeys(made))


def flat_rules(rules: RuleSet | BucketSet) -> list[tuple[str, str, str, str]]:
    """``number, predicate, label, group`` of every rule, nested ones after the rule that holds them (``2``, ``2.1``, ...).

    In a group the first match wins: all rules of a ``RuleSet`` on one level, or the rules of one bucket.
    """
    if isinstance(rules, BucketSet):
        return [(str(n), predicate, name if sign > 0 else f"-{name}", name) for n, (name, predicate, sign) in enumerate(rules.rules, 1)]

    def walk(own: RuleSet, prefix: str, reached: str | None) -> list[tuple[str, str, str, str]]:
        out = []
        for n, (predicate, label) in enumerate(own.rules, 1):
            number = f"{prefix}{n}"
            inner = predicate if reached is None else both(reached, predicate)
            name = label.expression if isinstance(label, FromColumn) else "" if isinstance(label, RuleSet) else str(label)
            out.append((number, inner, name, prefix))
            if isinstance(label, RuleSet):
                before = [f"NOT coalesce({p}, false)" for p, _ in own.rules[:n - 1]]
                out += walk(label, f"{number}.", both(inner, *before))
        return out

    return walk(rules, "", None)


def rule_hits(df: DataFrame, rules: RuleSet | BucketSet, name: str = "") -> DataFrame:
    """One row per rule: how many rows match it, how many it decides, and which of its literals no row has.

    Columns: ``rules, rule, label, matched, won, literals, unseen``.  A rule with ``matched`` 0 found nothing in these
    rows; one with ``matched`` above 0 and ``won`` 0 lies behind earlier rules and can be dropped.  All rules are counted
    in one aggregate over the rows, so the table is read once.
    """
    flat = flat_rules(rules)
    counts, shown = [], []
    earlier: dict[str, list[str]] = {}
    for n, (number, predicate, label, group) in enumerate(flat):
        hit = f"coalesce({predicate}, false)"
        before = earlier.setdefault(group, [])
        won = both(hit, *[f"NOT {b}" for b in before]) if before else hit
        before.append(hit)
        own = literals(predicate)
        counts += [F.expr(f"count_if({hit})").alias(f"m{n}"), F.expr(f"count_if({won})").alias(f"w{n}")]
        counts += [F.expr(f"count_if({x.test})").alias(f"l{n}_{k}") for k, x in enumerate(own)]
        unseen = F.array_compact(F.array(*[F.when(F.col(f"l{n}_{k}") == 0, F.lit(x.value)) for k, x in enumerate(own)])) if own else F.array().cast("array<string>")
        shown.append(F.struct(
            F.lit(name).alias("rules"), F.lit(number).alias("rule"), F.lit(label).alias("label"), F.col(f"m{n}").alias("matched"), F.col(f"w{n}").alias("won"),
            F.lit(len(own)).cast("long").alias("literals"), unseen.alias("unseen"),
        ))
    return df.agg(*counts).select(F.explode(F.array(*shown)).alias("r")).select("r.*")


def with_each_literal(df: DataFrame, rules: RuleSet | BucketSet, choose: Column, fixed: Mapping[str, Column]) -> DataFrame:
    """The rows with stand-in values for the columns that the rules name, so that every literal occurs.

    ``choose`` is an integer per row; a column takes its literals in turn by it, and null after the last.  Columns of
    ``fixed`` are set as given.
    """
    named: dict[str, dict[str, None]] = {}
    for _, predicate, _, _ in flat_rules(rules):
        for literal in literals(predicate):
            named.setdefault(literal.column, {})[literal.value] = None
    own = {}
    for column, values in named.items():
        if column not in fixed:
            listed = F.array(*[F.lit(v) for v in values], F.lit(None).cast("string"))
            own[column] = F.element_at(listed, (F.pmod(choose, F.lit(len(values) + 1)) + 1).cast("int"))
    return df.withColumns({**own, **fixed})
