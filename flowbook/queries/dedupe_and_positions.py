"""One row per key, snapshots, positions and ledgers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.dedupe import all_newest, current_else_archive, flag_one_per_key, label_per_code, one_per_key
from ..operators.positions import (
    as_of, as_of_snapshot, drop_empty_rows, drop_inactive, ledger, live_only, open_close, open_close_as_of,
)
from ..operators.rules import BucketSet
from .registry import query, shown, table

MONEY = "decimal(18,2)"


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("date").alias("d"), F.col("value").cast(MONEY).alias("value"))


@query("latest_per_key", """
SELECT user_id, event_id, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id) = 1
""")
def latest_per_key(spark, sf_dir):
    return shown(one_per_key(events(spark, sf_dir), ["user_id"], [F.col("d").desc_nulls_last(), "event_id"]).drop("d"))


@query("current_else_archive", """
WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS status, 0 AS src FROM customer WHERE c_acctbal >= 3000),
h AS (SELECT o_custkey AS c_custkey, o_orderpriority AS c_name, 'archived' AS status, 1 AS src FROM orders)
SELECT c_custkey, c_name, status FROM (SELECT * FROM c UNION ALL SELECT * FROM h)
QUALIFY ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY src, c_name) = 1
""")
def current_else_archive_query(spark, sf_dir):
    """Current contracts, else archived ones marked so; a current row without status stays."""
    current = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 3000).select(
        "c_custkey", "c_name", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("status"))
    archive = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_name"), F.col("o_orderstatus").alias("status"))
    return current_else_archive(current, archive, ["c_custkey"], ["c_name"], "status", "archived")


@query("label_per_code", """
SELECT l_suppkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY p_brand DESC, p_name) = 1
""")
def label_per_code_query(spark, sf_dir):
    """The preferred label of each code."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    labelled = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").join(parts, ["l_partkey"])
    return label_per_code(labelled, "l_suppkey", "p_name", F.col("p_brand"))


@query("movement_dedupe", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) = 1
""")
def movement_dedupe(spark, sf_dir):
    """One movement per business key, the latest; ties broken by the other columns."""
    kept = one_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [
        F.col("l_shipdate").desc(), "l_partkey", "l_suppkey", "l_extendedprice"])
    return shown(kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast(MONEY).alias("amount")))


@query("one_counted_row", """
SELECT o_custkey, o_orderkey, CAST(CASE WHEN ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 THEN 1 ELSE 0 END AS BIGINT) AS cnt FROM orders
""")
def one_counted_row(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return shown(flag_one_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "cnt").drop("o_orderdate"))


@query("as_of_snapshot", """
SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events
WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15')
""")
def as_of_snapshot_query(spark, sf_dir):
    """All rows of the newest snapshot on or before a date."""
    return as_of_snapshot(events(spark, sf_dir), "d", dt.date(2024, 1, 15)).select("event_id", "user_id", "d")


@query("history_read", """
SELECT user_id, COUNT(*) AS versions, MIN(CAST(ts AS DATE)) AS first_seen, MAX(CAST(ts AS DATE)) AS last_seen FROM events GROUP BY user_id
""")
def history_read(spark, sf_dir):
    """Every version of a key (no snapshot filter)."""
    return events(spark, sf_dir).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("versions"), F.min("d").alias("first_seen"), F.max("d").alias("last_seen"))


@query("open_close", """
WITH e AS (SELECT user_id, event_type, CAST(ts AS DATE) AS d, CAST(value AS DECIMAL(18,2)) AS v FROM events),
o AS (SELECT user_id, event_type, v FROM e WHERE d = DATE '2024-01-10'), c AS (SELECT user_id, event_type, v FROM e WHERE d = DATE '2024-01-25'),
k AS (SELECT user_id, NULLIF(event_type, 'view') AS kind, v AS a, 0 AS b FROM o UNION ALL SELECT user_id, NULLIF(event_type, 'view'), 0, v FROM c)
SELECT user_id, kind, CAST(SUM(a) AS DOUBLE) AS "PM_DEBUT", CAST(SUM(b) AS DOUBLE) AS "PM_FIN" FROM k GROUP BY user_id, kind
""")
def open_close_query(spark, sf_dir):
    """Opening beside closing value; keys with a null part are kept and matched."""
    rows = events(spark, sf_dir).withColumn("kind", F.nullif(F.col("event_type"), F.lit("view")))
    opening = rows.filter(F.col("d") == dt.date(2024, 1, 10))
    closing = rows.filter(F.col("d") == dt.date(2024, 1, 25))
    return shown(open_close(opening, closing, ["user_id", "kind"], "value"))


@query("open_close_history", """
WITH e AS (SELECT user_id, event_type, CAST(ts AS DATE) AS d, SUM(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY ALL),
o AS (SELECT user_id, event_type, v FROM e WHERE d <= DATE '2024-01-10' QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY d DESC) = 1),
c AS (SELECT user_id, event_type, v FROM e WHERE d <= DATE '2024-01-25' QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY d DESC) = 1)
SELECT c.user_id, c.event_type, CAST(COALESCE(o.v, 0) AS DOUBLE) AS "PM_DEBUT", CAST(c.v AS DOUBLE) AS "PM_FIN"
FROM c LEFT JOIN o ON o.user_id = c.user_id AND o.event_type = c.event_type
""")
def open_close_history(spark, sf_dir):
    """Both positions from one scan of a valuation history."""
    return shown(open_close_as_of(
        events(spark, sf_dir), ["user_id", "event_type"], "d", "value", dt.date(2024, 1, 10), dt.date(2024, 1, 25)))


@query("latest_valuation_ties", """
SELECT user_id, event_id, d FROM (SELECT user_id, event_id, CAST(ts AS DATE) AS d, DENSE_RANK() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) AS r
  FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20') WHERE r = 1
""")
def latest_valuation_ties(spark, sf_dir):
    """Every row of the newest date of each key as of a date."""
    return as_of(events(spark, sf_dir), ["user_id"], "d", dt.date(2024, 1, 20), keep_ties=True).select("user_id", "event_id", "d")


@query("as_of_per_key", """
SELECT user_id, event_id, d FROM (SELECT user_id, event_id, CAST(ts AS DATE) AS d FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20')
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY d DESC, event_id) = 1
""")
def as_of_per_key(spark, sf_dir):
    return as_of(events(spark, sf_dir), ["user_id"], "d", dt.date(2024, 1, 20), tiebreak=["event_id"]).select("user_id", "event_id", "d")


@query("live_positions", """
SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') GROUP BY l_orderkey
""")
def live_positions(spark, sf_dir):
    """Positions of live contracts only; the status join cannot multiply rows."""
    positions = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast(MONEY).alias("value"))
    contracts = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    live = live_only(positions, contracts, ["l_orderkey"], F.col("o_orderstatus") == "O")
    return shown(live.groupBy("l_orderkey").agg(F.sum("value").alias("value")))


SIGNED = """
f AS (SELECT user_id, event_type, SUM(CASE WHEN event_type IN ('purchase', 'signup') THEN v ELSE 0 END) AS inflow, SUM(CASE WHEN event_type = 'error' THEN v ELSE 0 END) AS outflow
  FROM (SELECT user_id, event_type, CAST(value AS DECIMAL(18,2)) AS v FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12') GROUP BY ALL),
p AS (SELECT user_id, event_type, SUM(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-04' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS a,
  SUM(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-12' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS b
  FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-04', DATE '2024-01-12') GROUP BY ALL),
g AS (SELECT user_id, event_type, SUM(inflow) AS inflow, SUM(outflow) AS outflow, SUM(a) AS a, SUM(b) AS b FROM (
  SELECT user_id, event_type, inflow, outflow, 0 AS a, 0 AS b FROM f UNION ALL SELECT user_id, event_type, 0, 0, a, b FROM p) GROUP BY ALL)
"""


def event_ledger(spark, sf_dir):
    """Flows of a period and the positions at both ends, per user and kind."""
    rows = events(spark, sf_dir)
    buckets = BucketSet([("inflow", "event_type IN ('purchase', 'signup')", 1), ("outflow", "event_type = 'error'", 1)], "value")
    keys = ["user_id", "event_type"]
    flows = buckets.aggregate(rows.filter(F.col("d").between(dt.date(2024, 1, 5), dt.date(2024, 1, 12))), keys)
    held = open_close(
        rows.filter(F.col("d") == dt.date(2024, 1, 4)), rows.filter(F.col("d") == dt.date(2024, 1, 12)), keys, "value")
    return ledger(flows, held, keys, buckets.names)


@query("positions_flows", f"""
WITH {SIGNED}
SELECT user_id, event_type, CAST(inflow AS DOUBLE) AS inflow, CAST(outflow AS DOUBLE) AS outflow, CAST(a AS DOUBLE) AS "PM_DEBUT", CAST(b AS DOUBLE) AS "PM_FIN" FROM g
""")
def positions_flows(spark, sf_dir):
    return shown(event_ledger(spark, sf_dir))




@query("drop_inactive", f"""
WITH l AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, SUM(CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END) AS x FROM lineitem GROUP BY ALL),
t AS (SELECT l_orderkey, SUM(x) AS s FROM l GROUP BY l_orderkey)
SELECT l.l_orderkey, l_linenumber, CAST(x AS DOUBLE) AS x FROM l JOIN t USING (l_orderkey) WHERE s <> 0
""")
def drop_inactive_query(spark, sf_dir):
    """Contracts whose signed amounts cancel out are dropped (the inherited rule)."""
    return shown(drop_inactive(signed_lines(spark, sf_dir), ["l_orderkey"], ["x"]))


@query("drop_inactive_absolute", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END) AS DOUBLE) AS x
FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber
  HAVING SUM(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END) <> 0) GROUP BY ALL
""")
def drop_inactive_absolute(spark, sf_dir):
    """Only contracts without any amount are dropped."""
    return shown(drop_inactive(signed_lines(spark, sf_dir), ["l_orderkey"], ["x"], mode="absolute"))


def signed_lines(spark, sf_dir):
    amount = F.col("l_quantity").cast(MONEY)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", -amount).otherwise(amount)).alias("x"))


@query("drop_empty_rows", f"""
WITH {SIGNED}, h AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN NULL ELSE event_type END AS label FROM g)
SELECT user_id, event_type, label, CAST(inflow AS DOUBLE) AS inflow, CAST(outflow AS DOUBLE) AS outflow, CAST(a AS DOUBLE) AS "PM_DEBUT", CAST(b AS DOUBLE) AS "PM_FIN"
FROM h WHERE label IS NOT NULL OR NOT (inflow = 0 AND outflow = 0 AND a = 0 AND b = 0)
""")
def drop_empty(spark, sf_dir):
    """Rows without a label go if all their measures are 0 or missing."""
    rows = event_ledger(spark, sf_dir).withColumn("label", F.when(F.col("user_id") % 3 != 0, F.col("event_type")))
    return shown(drop_empty_rows(rows, "label", ["inflow", "outflow", "PM_DEBUT", "PM_FIN"]))


@query("max_valuation_date", "SELECT event_type, MAX(CAST(ts AS DATE)) AS last_date FROM events GROUP BY event_type")
def max_valuation_date(spark, sf_dir):
    return events(spark, sf_dir).groupBy("event_type").agg(F.max("d").alias("last_date"))


@query("newest_ties_by_customer", """
SELECT o_custkey, o_orderkey FROM orders QUALIFY DENSE_RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus DESC) = 1
""")
def newest_ties_by_customer(spark, sf_dir):
    ranked = all_newest(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderstatus").desc()])
    return ranked.select("o_custkey", "o_orderkey")
