import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowbook.functions.calendar import Period
from flowbook.operators import backfill as bf
from flowbook.operators import checks, dedupe, flows, joins, positions
from flowbook.operators.cube import CubeSpec, Dimension, run_levels
from flowbook.operators.rules import RuleSet

D = dt.date


def test_one_per_key_needs_an_order_and_breaks_ties(rows, values):
    df = rows("k string, d date, v int", ("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 2), 3), ("a", D(2024, 1, 2), 2), (None, D(2024, 1, 1), 9), ("b", None, 4))
    with pytest.raises(ValueError):
        dedupe.one_per_key(df, ["k"], [])
    out = values(dedupe.one_per_key(df, ["k"], [F.col("d").desc_nulls_last(), "v"]).select("k", "v"))
    assert out == [("a", 2), ("b", 4), (None, 9)]
    assert values(dedupe.all_newest(df, ["k"], [F.col("d").desc_nulls_last()]).select("k", "v")) == [("a", 2), ("a", 3), ("b", 4), (None, 9)]


def test_hot_key_is_cut_before_the_shuffle(rows):
    df = rows("k string, v int", ("a", 1)).repartition(2)
    plan = dedupe.one_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit"), plan
    assert "Partial" in plan


def test_current_row_with_null_status_stays(rows, values):
    current = rows("k int, s string", (1, None), (2, "open"))
    archive = rows("k int, s string", (1, "old"), (2, "old"), (3, "old"))
    out = dedupe.current_else_archive(current, archive, ["k"], ["s"], "s", "in error")
    assert values(out) == [(1, None), (2, "open"), (3, "in error")]


def test_flag_and_totals_handle_null_keys(rows, values):
    df = rows("k string, v int", ("a", 2), ("a", 1), (None, 5), (None, 4))
    flagged = dedupe.flag_one_per_key(df, ["k"], ["v"], "f")
    assert values(flagged.select("k", "v", "f")) == [("a", 1, 1), ("a", 2, 0), (None, 4, 1), (None, 5, 0)]
    totals = dedupe.group_totals(df, ["k"], {"t": F.sum("v")})
    assert values(totals.select("k", "v", "t")) == [("a", 1, 3), ("a", 2, 3), (None, 4, 9), (None, 5, 9)]


def test_label_per_code(rows, values):
    df = rows("c string, l string, s string", ("x", "long", "A"), ("x", "other", "B"), ("x", "another", "B"))
    assert values(dedupe.label_per_code(df, "c", "l", F.col("s"))) == [("x", "another")]


def test_open_close_matches_null_keys(rows, values):
    opening = rows("k string, o string, v int", ("a", None, 1), ("a", None, 2), ("b", "x", 5))
    closing = rows("k string, o string, v int, d date", ("a", None, 10, D(2024, 1, 1)), ("c", None, 7, D(2024, 1, 2)))
    out = positions.open_close(opening, closing, ["k", "o"], "v", attributes={"d": "max"})
    assert values(out) == [("a", None, 3, 10, D(2024, 1, 1)), ("b", "x", 5, 0, None), ("c", None, 0, 7, D(2024, 1, 2))]


def test_open_close_as_of_and_snapshot_pair(rows, values):
    df = rows("k string, d date, v int", ("a", D(2023, 12, 1), 1), ("a", D(2023, 12, 31), 2), ("a", D(2024, 2, 1), 3), ("a", D(2024, 9, 1), 9), ("b", D(2024, 2, 1), 4))
    assert values(positions.open_close_as_of(df, ["k"], "d", "v", D(2023, 12, 31), D(2024, 6, 30))) == [("a", 2, 3), ("b", 0, 4)]
    pair = positions.snapshot_pair(df, ["k"], "d", D(2023, 12, 31), D(2024, 6, 30), {"o": "v"}, {"c": "v", "cd": "d"}, added=["v"])
    assert values(pair) == [("a", 2, 3, D(2024, 2, 1)), ("b", None, 4, D(2024, 2, 1))]


def test_snapshot_pair_adds_rows_of_one_key_and_date(rows, values):
    df = rows("k string, d date, v int, r int", ("a", D(2024, 2, 1), 100, 7), ("a", D(2024, 2, 1), 50, 8), (None, D(2023, 2, 1), 1, 1))
    pair = positions.snapshot_pair(df, ["k"], "d", D(2023, 12, 31), D(2024, 6, 30), {"o": "v"}, {"c": "v", "r": "r"}, added=["v"])
    assert values(pair) == [("a", None, 150, 8), (None, 1, 1, 1)]


def test_as_of_keeps_ties_on_request(rows, values):
    df = rows("k string, d date, v int", ("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 1), 2), ("a", D(2024, 5, 1), 3))
    assert values(positions.as_of(df, ["k"], "d", D(2024, 2, 1), keep_ties=True).select("v")) == [(1,), (2,)]
    assert values(positions.as_of(df, ["k"], "d", "2024-02-01", tiebreak=["v"]).select("v")) == [(1,)]
    assert values(positions.as_of_snapshot(df, "d", D(2024, 2, 1)).select("v")) == [(1,), (2,)]


def test_offsetting_flows_drop_a_contract_only_in_signed_mode(rows, values):
    df = rows("k string, s int, v int, w int", ("a", 1, 5, None), ("a", 2, -5, 0), ("b", 1, 0, 0), ("c", 1, 1, 1), (None, 1, 2, 2))
    assert values(positions.drop_inactive(df, ["k"], ["v", "w"]).select("k").distinct()) == [("c",), (None,)]
    assert values(positions.drop_inactive(df, ["k"], ["v", "w"], "absolute").select("k", "s")) == [("a", 1), ("a", 2), ("c", 1), (None, 1)]
    with pytest.raises(ValueError):
        positions.drop_inactive(df, ["k"], ["v"], "other")


def test_empty_rows_go_only_without_label(rows, values):
    df = rows("l string, v int", (None, 0), (None, None), (None, 1), ("x", 0), ("x", None))
    assert values(positions.drop_empty_rows(df, "l", ["v"])) == [("x", 0), ("x", None), (None, 1)]


def test_live_only_never_multiplies(rows):
    held = rows("k int, v int", (1, 5), (2, 6))
    status = rows("k int, s string", (1, "open"), (1, "open"), (2, "shut"))
    assert [tuple(r) for r in positions.live_only(held, status, ["k"], F.col("s") == "open").collect()] == [(1, 5)]


def test_repeated_dimension_key_fails(rows):
    facts = rows("k int, v int", (1, 10), (2, 20), (None, 30))
    with pytest.raises(Exception, match="repeated key"):
        joins.lookup(facts, rows("k int, n string", (1, "a"), (1, "b")), ["k"]).collect()
    same_row = joins.lookup(facts, rows("k int, n string", (1, "a"), (1, "a"), (None, "x"), (None, "y")), ["k"], fill={"n": "?"})
    assert sorted(r["n"] for r in same_row.collect()) == ["?", "?", "a"]
    assert same_row.agg(F.sum("v")).first()[0] == 60


def test_rows_without_a_key_are_spread(spark, rows, values):
    facts = spark.range(4000).select((F.when(F.col("id") % 10 == 0, F.col("id") % 7)).alias("k"), "id")
    dim = rows("k bigint, n string", *[(k, f"n{k}") for k in range(7)], (None, "none"))
    plain, spread = (joins.lookup(facts, dim, ["k"], spread_nulls=s) for s in (False, True))
    assert values(plain) == values(spread) and spread.columns == ["k", "id", "n"]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        most = [max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("part")).count().collect()) for df in (plain, spread)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert most[0] >= 3600 and most[1] < 1200


def test_stack_checks_names_and_types(rows):
    a, b = rows("x int, y string", (1, "a")), rows("y string, x int", ("b", 2))
    assert [tuple(r) for r in joins.stack([a, b], ["x", "y"]).collect()] == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="missing"):
        joins.stack([a, rows("x int", (1,))], ["x", "y"])
    with pytest.raises(ValueError, match="expected"):
        joins.stack([a, rows("x bigint, y string", (1, "a"))], ["x", "y"])


def test_gross_up_with_zero_divisor_and_null(rows):
    money = "decimal(18,2)"
    df = rows(f"g int, p {money}, w {money}", (1, Decimal(1), Decimal(90)), (1, Decimal(2), Decimal(90)), (2, Decimal(3), Decimal(7)), (2, Decimal(-3), Decimal(7)),
              (3, Decimal(4), None))
    out = sorted((r["g"], float(r["x"])) for r in flows.gross_up(df, "p", "w", ["g"], "x").collect())
    assert out == [(1, 30.0), (1, 60.0), (2, 0.0), (2, 0.0), (3, 0.0)]


def test_transfer_flags_have_one_row_per_contract(rows, values):
    df = rows("k int, e string, x string", (1, "A", None), (1, None, "S"), (2, "Z", "Z"), (3, None, None))
    out = flows.motive_flags(df, ["k"], {"te": ("e", ["A", "F", "S"]), "ts": ("x", ["A", "F", "S"])})
    assert values(out) == [(1, 1, 1), (2, 0, 0), (3, 0, 0)]


def cube(rows, **more):
    fact = rows("pk int, sk int, d date, v int", (1, 1, D(2024, 1, 1), 10), (1, 2, D(2024, 2, 1), 20), (2, 1, D(2024, 2, 1), 40), (9, 1, D(2023, 12, 1), 80))
    product = rows("pk int, L1 string, L2 string", (1, "a", "all"), (2, "b", "all"))
    source = rows("sk int, N string", (1, "x"), (2, "y"))
    return CubeSpec(fact=fact, dims={"p": Dimension(product, "pk", "pk"), "s": Dimension(source, "sk", "sk")}, value="v", month_col="d")


def test_cube_shows_filters_and_windows(rows, values):
    spec = cube(rows)
    assert values(spec.show("p", "L1").run()) == [("a", 30), ("b", 40), (None, 80)]
    assert values(spec.show("p", "L1").where("p", "L2", ["all"]).where("s", "N", ["x"]).run()) == [("a", 10), ("b", 40)]
    assert values(spec.show("s", "N").ytd(D(2024, 1, 31)).run()) == [("x", 10)]
    assert values(spec.months([D(2024, 2, 1)]).show("s", "N").run(having=F.col("s_N") == "y")) == [("y", 20)]
    assert values(spec.show("maille_fine", "d").where("maille_fine", "pk", [2]).run()) == [(D(2024, 2, 1), 40)]
    assert values(spec.indicator("BIG", RuleSet([("v > 30", "big")], "small")).run()) == [("big", 120), ("small", 30)]
    assert values(spec.members("p", "L1", like="A%")) == [("a",)]


def test_cube_specification_is_immutable_and_strict(rows):
    spec = cube(rows).where("p", "L1", ["a"])
    assert spec.where("p", "L1", ["b"]).filters["p"] == ("L1", ("b",)) and spec.filters["p"] == ("L1", ("a",))
    with pytest.raises(ValueError):
        spec.where("p", "L2", ["all"])
    assert spec.unfiltered("p").where("p", "L2", ["all"]).filters["p"][0] == "L2"
    with pytest.raises(KeyError):
        spec.show("nowhere", "x")
    assert spec.reset().filters == {} and spec.reset().shown == {}


def test_cube_levels_come_from_one_aggregate(rows, values):
    spec = cube(rows)
    levels = {
        "all": spec.show("p", "L1"),
        "x": spec.show("p", "L2").where("s", "N", ["x"]).where("p", "L1", ["a", "b"]),
        "feb": spec.show("maille_fine", "pk").months([D(2024, 2, 1)]).indicator("BIG", RuleSet([("v > 30", "big")], "small")),
    }
    out = {tuple(r) for r in run_levels(levels).select("level", "maille_fine_pk", "p_L1", "p_L2", "indicateur_BIG", "Value").collect()}
    assert out == {
        ("all", None, "a", None, None, 30), ("all", None, "b", None, None, 40), ("all", None, None, None, None, 80), ("x", None, None, "all", None, 50),
        ("feb", 1, None, None, "small", 20), ("feb", 2, None, None, "big", 40),
    }
    for name, one in levels.items():
        own = one.run()
        assert values(own) == sorted((tuple(r[c] for c in own.columns) for r in run_levels(levels).filter(F.col("level") == name).collect()), key=repr)
    shared = {"a": spec.where("s", "N", ["x"]).show("p", "L1"), "b": spec.where("s", "N", ["x"]).show("s", "N")}
    assert {(r["level"], r["p_L1"], r["s_N"], r["Value"]) for r in run_levels(shared).collect()} == {
        ("a", "a", None, 10), ("a", "b", None, 40), ("a", None, None, 80), ("b", None, "x", 130)}
    with pytest.raises(ValueError, match="share the fact"):
        run_levels({"a": spec, "b": cube(rows)})


def test_backfill_equals_one_run_per_month(spark, values):
    import random

    random.seed(3)
    day = lambda: D(2022, 1, 1) + dt.timedelta(days=random.randrange(900))
    moved = [(random.choice("ab") if random.random() > .1 else None, day(), random.randrange(50)) for _ in range(200)]
    valued = [(random.choice("abc"), day(), random.randrange(50)) for _ in range(40)]
    f, p = spark.createDataFrame(moved, "k string, d date, m int"), spark.createDataFrame(valued, "k string, d date, v int")
    first, last = Period(2022, 11), Period(2024, 3)
    out = bf.backfill(f, "d", ["m"], p, "d", "v", ["k"], first, last)
    found = {(r.period, r.k): (r.m, r.PM_DEBUT, r.PM_FIN) for r in out.collect()}

    def held(key, limit):
        known = [x for x in valued if x[0] == key and x[1] <= limit]
        newest = max((x[1] for x in known), default=None)
        return sum(x[2] for x in known if x[1] == newest)

    period = first
    expected = {}
    while (period.year, period.month) <= (last.year, last.month):
        for key in ("a", "b", "c", None):
            flow = [x for x in moved if x[0] == key and period.start <= x[1] <= period.end]
            opened = key is not None and any(x[0] == key and x[1] <= period.previous_year_end for x in valued)
            closed = key is not None and any(x[0] == key and x[1] <= period.end for x in valued)
            if flow or opened or closed:
                expected[(period.month_start, key)] = (sum(x[2] for x in flow), held(key, period.previous_year_end), held(key, period.end))
        period = Period(period.year + 1, 1) if period.month == 12 else Period(period.year, period.month + 1)
    assert found == expected


def test_checks(rows, values):
    before = rows("y int, v int", (1, 10), (1, 5), (2, 7))
    after = rows("y int, v int", (1, 10))
    out = {r["y"]: (r["total_before"], r["total_after"], r["rows_change"]) for r in checks.control_totals(before, after, ["y"], "v").collect()}
    assert out == {1: (15, 10, -1), 2: (7, 0, -1)}
    df = rows("c string, v int", ("a", 1), ("z", 2), (None, 3))
    assert values(checks.domain_check(df, "c", ["a"])) == [("z", 1), (None, 1)]
    assert values(checks.unclassified(df, "c", ["z"], "v")) == [("z", 1, 2)]


def test_refresh_computes_touched_months_only(spark, rows, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("source", "target", "state"))
    first, last = Period(2023, 11), Period(2024, 4)

    def add(mode, *data):
        df = rows("k int, m int, d date", *data).withColumn("func_month", F.date_format("d", "yyyyMM"))
        df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("func_month").parquet(source)

    reads = []

    def build(df, low, high):
        reads.append({r["d"].strftime("%Y%m") for r in df.select("d").distinct().collect()})
        return bf.year_to_date(df, ["k"], "d", ["m"], low, high)

    def update():
        return [p.key for p in bf.refresh(spark, source, target, state, build, first, last)]

    def stored():
        return sorted((str(r["period"]), r["k"], r["m"]) for r in spark.read.parquet(target).collect())

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "target").glob("period=*/*.parquet")}

    add("overwrite", (1, 1, D(2023, 2, 1)), (1, 2, D(2023, 11, 5)), (1, 4, D(2024, 1, 9)), (2, 8, D(2024, 3, 1)), (9, 9, D(2022, 1, 1)), (9, 9, D(2024, 8, 1)))
    assert update() == ["202311", "202312", "202401", "202402", "202403", "202404"]
    whole = [("202311", 1, 3), ("202312", 1, 3), ("202401", 1, 4), ("202402", 1, 4), ("202403", 1, 4), ("202403", 2, 8), ("202404", 1, 4), ("202404", 2, 8)]
    assert stored() == whole and update() == []
    before = files()
    reads.clear()
    add("append", (1, 100, D(2024, 3, 7)))
    assert update() == ["202403", "202404"]
    assert reads == [{"202401", "202403"}]
    assert stored() == [(p, k, m + 100 * (p >= "202403" and k == 1)) for p, k, m in whole]
    kept = {n: t for n, t in files().items() if n in before}
    assert kept == {n: t for n, t in before.items() if n in kept} and len(kept) == 4
    # A month that loses its rows is removed.
    for month in ("202401", "202403"):
        for f in (tmp_path / "source" / f"func_month={month}").glob("*"):
            f.unlink()
        (tmp_path / "source" / f"func_month={month}").rmdir()
    assert update() == ["202401", "202402", "202403", "202404"] and stored() == whole[:2]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_backfill_shuffles_keys_not_months(spark):
    """Rows repeated for each reporting month pass no shuffle, so none is dealt by period; the stored history has a row per key."""
    f = spark.createDataFrame([("a", D(2024, 1, 5), 1), (None, D(2024, 2, 1), 2), ("b", D(2023, 12, 31), 4)], "k string, d date, m int")
    p = spark.createDataFrame([("a", D(2020, 1, 1), 7), ("a", D(2024, 2, 9), None), (None, D(2024, 3, 1), 9)], "k string, d date, v int")
    first, last = Period(2024, 1), Period(2024, 3)
    out = bf.backfill(f, "d", ["m"], p, "d", "v", ["k"], first, last)
    assert "period" not in " ".join(line for line in plan_of(out).split("\n") if "Exchange" in line)
    assert bf.histories(f, "d", ["m"], p, "d", "v", ["k"], first, last).count() == 2
    assert sorted(((r.period.month, r.k, r.m, r.PM_DEBUT, r.PM_FIN) for r in out.collect()), key=repr) == sorted([
        (1, "a", 1, 7, 7), (2, "a", 1, 7, 0), (3, "a", 1, 7, 0), (2, None, 2, 0, 0), (3, None, 2, 0, 9)], key=repr)


def test_counted_row_drops_inactive_keys_in_one_join(spark):
    rows = [("a", 1, 5), ("a", 2, -5), ("b", 1, 3), ("b", 2, None), (None, 7, 1), (None, 8, 1), ("c", 1, None)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    found = dedupe.flag_one_per_key(df, ["k"], ["o"], "f", "coalesce(v, 0)")
    assert sorted(((r.k, r.o, r.f) for r in found.collect()), key=repr) == sorted([("b", 1, 1), ("b", 2, 0), (None, 7, 1), (None, 8, 0)], key=repr)
    kept = dedupe.flag_one_per_key(df, ["k"], ["o"], "f")
    assert kept.count() == 7 and kept.filter("f = 1").count() == 4


def test_null_safe_lookup_matches_no_null_and_uses_the_exchange(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, v int")
    once = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    assert sorted(map(tuple, joins.lookup(rows, once, ["k"], unique=True, null_safe=True).collect()), key=repr) == sorted(
        [("a", 1, 10), (None, 2, None), ("c", 3, None)], key=repr)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = dedupe.flag_one_per_key(rows, ["k"], ["v"], "f", "v")
        dealt = [plan_of(joins.lookup(flagged, once, ["k"], unique=True, null_safe=n)).count("Exchange hashpartitioning") for n in (True, False)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert dealt[0] == dealt[1] - 1


def test_grouped_sides_meet_in_a_join_and_give_the_ledger(rows, values):
    f = rows("k string, j int, m decimal(18,2), l string", ("a", 1, Decimal(3), "x"), (None, 1, Decimal(4), "z"), ("c", None, None, None))
    p = rows("k string, j int, m decimal(18,2), pm decimal(18,2), l string", ("a", 1, Decimal(1), Decimal(7), "y"), (None, 1, None, None, "b"), (None, None, None, Decimal(9), "w"))
    wide = dict(flow_measures=["m"], position_measures=["pm"], attributes={"l": "max"})
    joined = positions.ledger_of_groups(f, p, ["k", "j"], ["m", "pm"], {"l": "max"})
    assert joined.columns == ["k", "j", "m", "pm", "l"] and "Aggregate" not in plan_of(joined)
    assert values(joined) == values(positions.ledger(f, p, ["k", "j"], **wide)) == sorted([
        ("a", 1, Decimal(4), Decimal(7), "y"), (None, 1, Decimal(4), Decimal(0), "z"), ("c", None, Decimal(0), Decimal(0), None), (None, None, Decimal(0), Decimal(9), "w"),
    ], key=repr)


def test_cube_deals_the_fact_by_no_flag(spark, tmp_path):
    from flowbook.queries.cube_queries import cube_budget

    spark.createDataFrame([(1, 1, 1, n, "A", "O", 0.01, "1998-03-02", 10.0) for n in (3, 4, 7)], (
        "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_tax double, "
        "l_shipdate string, l_extendedprice double")).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "S", 0)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1, "LARGE", 20, "B")], "p_partkey long, p_type string, p_size int, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    # As over large tables: what Spark has no size for is not broadcast by itself.
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = cube_budget(spark, str(tmp_path))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line]
        assert joins and not [line for line in joins if "l_returnflag" in line or "l_linestatus" in line or "l_linenumber" in line]
        assert rows.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rows_of_one_task_are_spread_within_a_partition(spark, tmp_path):
    import glob

    from flowbook.sources.tables import write_partitions

    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "32k")
    try:
        df = spark.range(0, 60_000, 1, 1).selectExpr("id AS contract", "uuid() AS label", "'a' AS version")
        write_partitions(df, f"{tmp_path}/spread", ["version"], ["contract"])
    finally:
        spark.conf.unset(size)
    assert len(glob.glob(f"{tmp_path}/spread/version=a/*.parquet")) > 1
    back = spark.read.parquet(f"{tmp_path}/spread")
    assert back.count() == back.select("contract").distinct().count() == 60_000


def test_summed_repeats_adds_up_what_repeats_and_deals_only_that(rows, values):
    from flowbook.operators.positions import summed, summed_repeats

    df = rows(
        "a string, b date, x decimal(28,2), y decimal(28,2)",
        ("p", None, Decimal("1.10"), None), ("p", None, Decimal("2.20"), Decimal("3")), (None, None, None, None), (None, None, None, Decimal("-4")),
        ("q", dt.date(2024, 1, 1), None, Decimal("5")), ("q", dt.date(2024, 1, 2), Decimal("6"), None), ("", None, Decimal("7"), None), (None, dt.date(2024, 1, 1), None, None),
    )
    found, wanted = summed_repeats(df, ["a", "b"], ["x", "y"]), summed(df, ["a", "b"], ["x", "y"])
    assert found.dtypes == wanted.dtypes
    assert values(found) == values(wanted)
    alone = summed_repeats(df.filter("a = 'q'"), ["a", "b"], ["x", "y"])
    assert values(alone) == values(summed(df.filter("a = 'q'"), ["a", "b"], ["x", "y"]))
    alone.collect()
    final = alone._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "isFinalPlan=true" in final and "hashpartitioning(a" not in final
    assert values(summed_repeats(df.limit(0), ["a", "b"], ["x", "y"])) == []


def test_first_per_key_gives_the_first_row_with_nulls_last(rows, values):
    df = rows("k string, o string, p int, v int", ("a", None, 1, 1), ("a", "x", 2, 1), ("a", "x", 1, 3), (None, None, None, 2), ("b", "y", 1, 1), ("b", "z", 1, -1))
    found = dedupe.first_per_key(df, ["k"], ["o", "p"], "v").selectExpr("k", "__first.o", "__first.p")
    assert values(found) == sorted([("a", "x", 1), (None, None, None)], key=repr)


def test_the_functions_of_the_base_are_small_enough_to_be_compiled(spark):
    """The last joins, labels and columns of the base: the JVM does not compile a function of more than 8,000 bytes."""
    import __spark_entry__

    base = __spark_entry__.queries()["monthly_base"](spark, "/root/testdata/sf0.001")
    plan = base._jdf.queryExecution()
    plan.toRdd().count()
    stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan.executedPlan())
    sizes = [stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.size())]
    assert sizes and max(sizes) <= 8000


def test_a_stored_frame_leaves_no_shuffle_files(spark, rows, values):
    import time

    from flowbook.session import CLEANUP, computed_once

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = lambda: {f for f in (str(x) for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles())) if "shuffle_" in f}
    before, setting = names(), spark.conf.get(CLEANUP)
    stored = computed_once(rows("k string, v int", ("a", 1), ("a", 2), (None, 3)).groupBy("k").agg(F.sum("v").alias("v")), "test")
    for _ in range(50):
        if not names() - before:
            break
        time.sleep(0.2)
    assert not names() - before
    assert spark.conf.get(CLEANUP) == setting
    assert values(stored) == [("a", 3), (None, 3)]
