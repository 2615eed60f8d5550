"""Entropy balancing: document rates closest to uniform (in relative entropy) that meet token constraints.

The words of every source must meet its target.  Beside that, the mix keeps the corpus's shares of languages and of
length classes as far as a penalty says.  The rates have the form ``exp(source + language + length class)``, cut at the
highest rate allowed; the multipliers maximise the dual, a concave function, by Newton steps.  A step's gradient and
its dense matrix are one aggregation over cells of documents (source x language x class); the driver solves the
small system.  Rates are then rounded into whole copies, so that every source's words come close to its target.
Everything on the documents is DataFrame operations.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import computed_once

WORD = r"[^\x20\x09-\x0D]+"
PHASES = 64
BUCKETS, BUCKET_ROWS = 64, 100_000
PENALTY = 0.5


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), total: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources in code-point order, null last, take the weights in turn and share ``total`` times all words; a target
    stops at ``most`` times its source's size and the excess is shared again by weight.  The table has a row per
    source, so its windows are small.  The water level is found in one pass: sources fill up in the order of cap / weight.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(in_order) - 1) % len(weights) + 1)
    caps = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    caps = caps.withColumns({
        "full_before": F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "weight_left": F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        "budget": F.sum("source_size").over(everything) * float(total),
    })
    level = (F.col("budget") - F.col("full_before")) / F.col("weight_left")
    caps = caps.withColumn("level", F.when(level * F.col("weight") < F.col("cap"), level))
    # Sources fill in order, so the first one that is not full has the level of all later ones.
    place = F.struct(F.col("level").isNull(), F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    return caps.withColumn("water", F.min_by("level", place).over(everything)).select(
        "source", "source_size",
        F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.col("water") * F.col("weight")).alias("target"),
    )


def solved(matrix: list[list[float]], vector: list[float]) -> list[float]:
    """The solution of a small dense system (symmetric, positive definite) by elimination with pivots."""
    n = len(vector)
    rows = [[*row, v] for row, v in zip(matrix, vector)]
    for k in range(n):
        pivot = max(range(k, n), key=lambda i: abs(rows[i][k]))
        rows[k], rows[pivot] = rows[pivot], rows[k]
        for i in range(k + 1, n):
            f = rows[i][k] / rows[k][k]
            if f:
                rows[i] = [x - f * y for x, y in zip(rows[i], rows[k])]
    out = [0.0] * n
    for k in reversed(range(n)):
        out[k] = (rows[k][n] - sum(rows[k][j] * out[j] for j in range(k + 1, n))) / rows[k][k]
    return out


def _lookup(values: Mapping[str, float], key: Column) -> Column:
    """The value of a key in a small table written into the plan; 0 for others."""
    if not values:
        return F.lit(0.0)
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for item in values.items() for x in item]), key), F.lit(0.0))


def tilted(groups: Sequence[Column], multipliers: Mapping[str, float], most: float) -> Column:
    """The rate of a cell from the multipliers of its groups."""
    return F.least(F.exp(reduce(lambda a, b: a + b, [_lookup(multipliers, g) for g in groups])), F.lit(float(most)))


def multipliers(cells: DataFrame, hard: Mapping[str, float], soft: Mapping[str, float], most: float, penalty: float = PENALTY,
                tolerance: float = 1e-10, rounds: int = 100) -> dict[str, float]:
    """The multiplier of every group of ``cells`` (``groups``: array of a cell's group names, ``words``).

    ``hard`` groups (name -> words) are met, ``soft`` ones are pulled towards theirs: missing a share of ``x`` costs
    ``x / penalty`` of its multiplier.  Each step is one aggregation to a row per pair of groups that meet; the list of
    groups is a setting, so that table is small.  Steps are cut to 1 and halved while they lower the dual.  Fails if the hard
    constraints do not hold to ``tolerance`` in the end.
    """
    names = [*hard, *soft]
    if not names:
        return {}
    place = {g: k for k, g in enumerate(names)}
    goal = {**hard, **soft}
    own = F.array_intersect("groups", F.array(*[F.lit(g) for g in names]))
    cells = computed_once(cells.select("groups", own.alias("own"), "words").where("words > 0"), "balance-cells")

    def measured(at: Mapping[str, float]) -> tuple[float, list[float], list[list[float]]]:
        eta = F.aggregate("own", F.lit(0.0), lambda total, g: total + _lookup(at, g))
        rate = F.least(F.exp(eta), F.lit(float(most)))
        capped = eta > math.log(most)
        # The part of the dual that a cell has: its words times the conjugate of the entropy, linear above the cap.
        cost = F.when(capped, most + most * (eta - math.log(most))).otherwise(rate)
        met = cells.select("own", (F.col("words") * rate).alias("taken"), F.when(capped, 0.0).otherwise(F.col("words") * rate).alias("free"), (F.col("words") * cost).alias("cost"))
        pairs = met.select(F.explode("own").alias("a"), "own", "taken", "free").select("a", F.explode("own").alias("b"), "taken", "free").groupBy("a", "b").agg(
            F.sum("taken").alias("taken"), F.sum("free").alias("free"))
        total = met.agg(F.sum("cost").alias("cost")).select(F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b"), F.col("cost").alias("taken"), F.lit(0.0).alias("free"))
        value, slope, matrix = 0.0, [goal[g] for g in names], [[0.0] * len(names) for _ in names]
        for r in pairs.unionByName(total).collect():
            if r.a is None:
                value -= r.taken or 0.0
                continue
            i, j = place[r.a], place[r.b]
            matrix[i][j] = r.free
            if i == j:
                slope[i] -= r.taken
        for g in names:
            value += at[g] * goal[g]
        for g in soft:
            value -= penalty * goal[g] * at[g] ** 2 / 2
            slope[place[g]] -= penalty * goal[g] * at[g]
            matrix[place[g]][place[g]] += penalty * goal[g]
        for i in range(len(names)):
            matrix[i][i] += 1e-9 * goal[names[i]]
        return value, slope, matrix

    at = {g: 0.0 for g in names}
    value, slope, matrix = measured(at)
    for _ in range(rounds):
        if all(abs(slope[place[g]]) <= tolerance * goal[g] for g in names):
            return at
        step = solved(matrix, slope)
        # A source whose documents are all at the highest rate has no curvature, so its own step is cut, not all steps.
        step, scale = [max(-1.0, min(1.0, x)) for x in step], 1.0
        while True:
            new = {g: at[g] + scale * step[place[g]] for g in names}
            found = measured(new)
            if found[0] >= value - 1e-12 * abs(value) or scale < 1e-4:
                break
            scale /= 2
        at, (value, slope, matrix) = new, found
    if all(abs(slope[place[g]]) <= 1e-6 * goal[g] for g in hard):
        return at
    raise ArithmeticError(f"entropy balancing did not converge in {rounds} steps: {[(g, slope[place[g]] / goal[g]) for g in hard]}")


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), total: float = 1.5, most: float = 2.0,
        keep: Sequence[str] | None = None, balance: Sequence[str] = ("lang",), penalty: float = PENALTY) -> DataFrame:
    """The documents with ``size, source_size, target, rate, copies, taken``.

    Needs ``doc_id, text, source``; the columns ``keep`` (default: all) stay as they are, and columns with the added
    names are replaced.  Of the columns ``balance`` those that exist, and the length class (a doubling of the words), keep
    their corpus shares as far as the sources' targets and ``penalty`` let them; their values, like the sources, are a
    setting and few.  A null or empty text has size 0 and takes 0 words; a null source or value is one of its own.  A very
    long text is one value like any other.  Repeated rows are documents of their own with copies each.  An empty table
    gives no rows.  Two runs give the same copies: the order of documents is by hash of ``doc_id`` and text.

    Rounding: in each source, documents are lined up by size class and hash, and the fraction of the rate becomes an
    extra copy at equal steps along that line, so copies keep the sizes' distribution.  Of 64 starting points of the
    steps the one is taken whose words come closest to the target.  No document is taken more than ``most`` times, rounded up.
    """
    added = ["size", "source_size", "target", "rate", "copies", "taken"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    # Size classes a hundredth apart and hash buckets, as many as the rows need, keep every ordered group small, also in
    # a hot source of equal documents.  What is kept travels as one struct, so no name of its own can meet one of these.
    buckets = max(BUCKETS, -(-docs.count() // BUCKET_ROWS))
    kept = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(None).alias("none"))
    traits = [c for c in balance if c in docs.columns]
    trait = F.array(*[F.concat(F.lit(f"{k}"), F.coalesce(F.concat(F.lit(":"), F.col(f"`{c}`").cast("string")), F.lit(""))) for k, c in enumerate(traits)]) if traits else F.array().cast("array<string>")
    line = docs.select(kept.alias("kept"), F.xxhash64("doc_id", "text").alias("_h"), n_words(F.col("text")).alias("size"), F.col("source").alias("_s"), trait.alias("_traits")).select(
        # A null source as two plain keys: the window and the join below then share one partitioning.
        "kept", "size", "_h", F.coalesce("_s", F.lit("")).alias("_s"), F.col("_s").isNull().alias("_sn"), F.floor(F.log1p("size") * 100).alias("_class"), "_traits",
        F.pmod("_h", F.lit(buckets)).alias("_bucket"),
    )
    kind = ["_s", "_sn", "_class", "_traits"]
    counts = computed_once(line.groupBy(*kind, "_bucket").agg(F.count("*").alias("_n"), F.sum("size").alias("_words")), "size-classes")
    per_source = counts.groupBy(F.when(~F.col("_sn"), F.col("_s")).alias("source")).agg(F.sum("_words").alias("source_size"))
    # A row per source, stored so that Spark knows its size before it plans the joins.
    aims = computed_once(targets(per_source, weights, total, most).select(
        F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_sn"), "source_size", "target"), "targets")
    sourced = F.concat(F.lit("s"), F.when(F.col("_sn"), "").otherwise(F.concat(F.lit(":"), "_s")))
    # Doublings of 1 + words: 69 steps of a hundredth each.
    length = F.concat(F.lit("n"), F.floor(F.col("_class") / 69).cast("string"))
    groups = F.concat(F.array(sourced, length), F.col("_traits"))
    kinds = computed_once(
        counts.groupBy(*kind).agg(F.sum("_n").alias("_n"), F.sum("_words").alias("words")).withColumn("groups", groups).join(aims, ["_s", "_sn"]), "kinds")
    full = F.col("target") >= F.col("source_size") * float(most) * (1 - 1e-12)
    empty = (F.col("target") <= 0) | (F.col("source_size") <= 0)
    hard = {r.g: float(r.t) for r in aims.where(~full & ~empty).select(sourced.alias("g"), F.col("target").alias("t")).collect()}
    shares = kinds.select(F.explode(F.slice("groups", 2, 100)).alias("g"), "words", F.when(full, F.col("words") * float(most)).otherwise(0.0).alias("fixed")).groupBy("g").agg(
        F.sum("words").alias("words"), F.sum("fixed").alias("fixed")).collect()
    sums = aims.agg(F.sum("target").alias("t"), F.sum("source_size").alias("w")).first()
    soft = {}
    for r in shares:
        # What sources at their highest rate take of a group is settled; at least a hundredth of the group stays a goal.
        goal = r.words * (sums.t or 0.0) / sums.w - r.fixed if sums.w else 0.0
        if r.words > 0:
            soft[r.g] = max(goal, 0.01 * r.words)
    solution = multipliers(kinds.where(~full & ~empty), hard, soft, most, penalty) if hard else {}
    rate = F.when(empty, 0.0).when(full, float(most)).otherwise(tilted([F.col("groups")[k] for k in range(2 + len(traits))], solution, most))
    along = Window.partitionBy("_s", "_sn").orderBy("_class", "_traits").rowsBetween(Window.unboundedPreceding, -1)
    rated = computed_once(kinds.withColumn("rate", rate).withColumn("_before", F.coalesce(F.sum(F.col("_n") * F.col("rate")).over(along), F.lit(0.0))).select(
        *kind, "source_size", "target", "rate", "_before"), "rates")
    within = Window.partitionBy(*kind).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.withColumn("_rows_before", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(rated, kind)
    cells = computed_once(cells.select(*kind, "_bucket", (F.col("_before") + F.col("rate") * F.col("_rows_before")).alias("_begin"), "source_size", "target", "rate"), "cells")
    inside = Window.partitionBy(*kind, "_bucket").orderBy("_h", "size")
    placed = line.withColumn("_row", F.row_number().over(inside)).join(cells, [*kind, "_bucket"])
    placed = computed_once(placed.select("kept", "size", "_s", "_sn", "_begin", "_row", "source_size", "target", "rate"), "placed")

    def copies(phase: Column) -> Column:
        here = F.col("_begin") + phase
        step = F.floor(here + F.col("rate") * F.col("_row")) - F.floor(here + F.col("rate") * (F.col("_row") - 1))
        return F.least(F.greatest(step, F.floor("rate")), F.ceil("rate")).cast("long")

    found = placed.groupBy("_s", "_sn").agg(
        F.first("target").alias("_t"),
        *[F.sum(copies(F.lit(k / PHASES)) * F.col("size")).alias(f"_p{k}") for k in range(PHASES)],
    )
    misses = F.array(*[F.struct(F.abs(F.col(f"_p{k}") - F.col("_t")).alias("miss"), F.lit(k / PHASES).alias("phase")) for k in range(PHASES)])
    # Stored, so that Spark knows its size before it plans the join: a row per source.
    best = computed_once(found.select("_s", "_sn", F.array_min(misses)["phase"].alias("_phase")), "phases")
    decided = placed.join(best, ["_s", "_sn"]).withColumn("copies", copies(F.col("_phase")))
    return decided.withColumn("taken", F.col("copies") * F.col("size")).select(*[F.col(f"kept.`{c}`").alias(c) for c in names], *added)
