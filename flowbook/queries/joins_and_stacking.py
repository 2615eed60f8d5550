"""Lookups, stacking and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codes import composite_key, pad_code
from ..operators.checks import Controls, observed_totals, unclassified, written_with_controls
from ..operators.joins import Lookup, header_driven, inline_lookup, lookup, lookup_chain, stack, stack_missing
from ..operators.rules import RuleSet
from ..plans import rulebook as rb
from ..session import working_folder
from .registry import query, shown, table

MONEY = "decimal(18,2)"


@query("lookup_chain", """
SELECT n_name, r_name, COALESCE(p_brand, 'none') AS brand, COUNT(*) AS movements, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT p_partkey, p_brand FROM part WHERE p_size > 5) ON l_partkey = p_partkey GROUP BY ALL
""")
def lookup_chain_query(spark, sf_dir):
    """Five lookups; each dimension is checked to have one row per key."""
    def dim(name, **renamed):
        return table(spark, sf_dir, name).select(*[F.col(old).alias(new) for new, old in renamed.items()])

    facts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.col("l_extendedprice").cast(MONEY).alias("v"))
    described = lookup_chain(facts, [
        Lookup(dim("orders", l_orderkey="o_orderkey", c_custkey="o_custkey"), ["l_orderkey"]),
        Lookup(dim("customer", c_custkey="c_custkey", n_nationkey="c_nationkey"), ["c_custkey"]),
        Lookup(dim("nation", n_nationkey="n_nationkey", n_name="n_name", r_regionkey="n_regionkey"), ["n_nationkey"]),
        Lookup(dim("region", r_regionkey="r_regionkey", r_name="r_name"), ["r_regionkey"]),
        Lookup(table(spark, sf_dir, "part").filter("p_size > 5").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand")),
               ["l_partkey"], fill={"brand": "none"}),
    ])
    return shown(described.groupBy("n_name", "r_name", "brand").agg(F.count(F.lit(1)).alias("movements"), F.sum("v").alias("amount")))


@query("lookup_null_keys", """
SELECT l_returnflag, COALESCE(p_brand, 'none') AS brand, COUNT(*) AS movements, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem LEFT JOIN part ON p_partkey = CASE WHEN l_orderkey % 10 = 0 THEN l_partkey END GROUP BY ALL
""")
def lookup_null_keys(spark, sf_dir):
    """A lookup in which nine of ten rows have no key; they are dealt by their other columns."""
    facts = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 10 == 0, F.col("l_partkey")).alias("p_partkey"), "l_returnflag", "l_orderkey", F.col("l_extendedprice").cast(MONEY).alias("v"))
    brands = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    found = lookup_chain(facts, [Lookup(brands, ["p_partkey"], fill={"brand": "none"}, spread_nulls=True)])
    return shown(found.groupBy("l_returnflag", "brand").agg(F.count(F.lit(1)).alias("movements"), F.sum("v").alias("amount")))


@query("composite_lookup", """
WITH s AS (SELECT DISTINCT s_nationkey || '-' || s_suppkey % 10 AS k, CAST('seg' || s_nationkey AS VARCHAR) AS segment FROM supplier)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, COALESCE(segment, 'Inconnu') AS segment
FROM lineitem LEFT JOIN s ON k = (l_partkey % 25) || '-' || (l_suppkey % 10)
""")
def composite_lookup(spark, sf_dir):
    """Lookup on a key glued from two codes, with a default label."""
    dash = F.lit("-")
    segments = table(spark, sf_dir, "supplier").select(
        composite_key(F.col("s_nationkey").cast("string"), dash, (F.col("s_suppkey") % 10).cast("string")).alias("k"),
        F.concat(F.lit("seg"), "s_nationkey").alias("segment")).distinct()
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").withColumn(
        "k", composite_key((F.col("l_partkey") % 25).cast("string"), dash, (F.col("l_suppkey") % 10).cast("string")))
    return shown(lookup(lines, segments, ["k"], fill={"segment": "Inconnu"}).drop("k"))


@query("channel_lookup", """
WITH c(code, network, channel) AS (VALUES ('001','GUICHET BANCAIRE',''), ('002','PLATEFORME BANCAIRE',''), ('003','DOM-TOM',''), ('004','DOM-TOM',''), ('005','ESPACES HOUSE',''),
  ('006','ENTREPRISE',''), ('007','ENTREPRISE',''), ('008','ENTREPRISE',''), ('009','PHONE ASSUR',''), ('010','AGA','RESEAU PROPRIETAIRE'), ('011','A2P','RESEAU PROPRIETAIRE'),
  ('012','A2P','RESEAU PROPRIETAIRE'), ('013','AEP','RESEAU PROPRIETAIRE'), ('014','AEP','RESEAU PROPRIETAIRE'), ('015','PROTECTION JURIDIQUE',''), ('016','COURTIER MSC','RESEAU TIERS'),
  ('017','DELEGUE MSC','RESEAU TIERS'), ('018','COURTIER A','RESEAU TIERS'), ('019','COURTIER B','RESEAU TIERS'), ('020','COURTIER C','RESEAU TIERS'), ('021','ASTRAL','RESEAU TIERS'),
  ('022','CII2','RESEAU TIERS'), ('023','COURTIERS GENERALISTES','RESEAU TIERS'), ('024','HOUSE PARTENAIRE',''), ('025','HOUSE PARTENAIRE',''), ('026','HOUSE PARTENAIRE',''))
SELECT lpad(CAST(c_nationkey + 1 AS VARCHAR), 3, '0') AS code, network, channel, COUNT(*) AS customers
FROM customer LEFT JOIN c ON code = lpad(CAST(c_nationkey + 1 AS VARCHAR), 3, '0') GROUP BY ALL
""")
def channel_lookup(spark, sf_dir):
    """The inline channel table joined to coded customers."""
    channels = inline_lookup(spark, rb.channel_rows(rb.DEFAULT_NAMES), ["code", "network", "channel"])
    customers = table(spark, sf_dir, "customer").select(pad_code(F.col("c_nationkey") + 1, 3).alias("code"))
    return customers.join(channels, ["code"], "left").groupBy("code", "network", "channel").agg(F.count(F.lit(1)).alias("customers"))


@query("header_driven_join", """
SELECT o_orderkey, o_orderstatus, COUNT(l_orderkey) AS details, CAST(COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS amount
FROM (SELECT * FROM lineitem WHERE l_returnflag = 'R') RIGHT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey GROUP BY ALL
""")
def header_driven_join(spark, sf_dir):
    """Every header of the window with its details; headers without any stay."""
    detail = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").cast(MONEY).alias("v"))
    header = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus")
    rows = header_driven(detail, header, ["o_orderkey"])
    return shown(rows.groupBy("o_orderkey", "o_orderstatus").agg(
        F.count("v").alias("details"), F.coalesce(F.sum("v"), F.lit(0)).alias("amount")))


@query("stack_systems", """
SELECT 'A' AS system, CAST(o_custkey AS BIGINT) AS contract, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM orders
UNION ALL SELECT 'B', user_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) FROM events
UNION ALL SELECT 'C', l_suppkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) FROM lineitem
""")
def stack_systems(spark, sf_dir):
    """Three systems stacked by name, with the schema checked; column order may differ."""
    def system(label, name, contract, amount, flipped=False):
        columns = [F.lit(label).alias("system"), F.col(contract).cast("bigint").alias("contract"), F.col(amount).cast(MONEY).alias("amount")]
        return table(spark, sf_dir, name).select(*(reversed(columns) if flipped else columns))

    return shown(stack([
        system("A", "orders", "o_custkey", "o_totalprice"),
        system("B", "events", "user_id", "value", flipped=True),
        system("C", "lineitem", "l_suppkey", "l_extendedprice"),
    ], ["system", "contract", "amount"]))


@query("union_missing_columns", """
SELECT 'PM' AS kind, event_type AS label, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS reserve, CAST(NULL AS DOUBLE) AS flow, NULL AS status FROM events GROUP BY event_type
UNION ALL SELECT 'FLUX', o_orderpriority, NULL, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), o_orderstatus FROM orders GROUP BY ALL
""")
def union_missing_columns(spark, sf_dir):
    """Frames with different columns stacked; what a frame lacks is null."""
    reserves = table(spark, sf_dir, "events").groupBy(F.lit("PM").alias("kind"), F.col("event_type").alias("label")).agg(
        F.sum(F.col("value").cast(MONEY)).alias("reserve"))
    flows = table(spark, sf_dir, "orders").groupBy(
        F.lit("FLUX").alias("kind"), F.col("o_orderpriority").alias("label"), F.col("o_orderstatus").alias("status"),
    ).agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("flow"))
    return shown(stack_missing([reserves, flows]))


@query("whole_row_dedupe", """
SELECT l_returnflag, l_linestatus, l_suppkey, COUNT(*) AS n FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey, l_linenumber FROM lineitem) GROUP BY ALL
""")
def whole_row_dedupe(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey", "l_linenumber").dropDuplicates()
    return rows.groupBy("l_returnflag", "l_linestatus", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("client_id_pick", """
WITH d AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS dim_id FROM customer WHERE c_acctbal > 0)
SELECT o_orderkey, COALESCE(dim_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '0') END) AS client
FROM orders LEFT JOIN d ON o_custkey = c_custkey
""")
def client_id_pick(spark, sf_dir):
    """The client id of the dimension, else that of the system."""
    dim = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_custkey") % 3 != 0, pad_code("c_custkey", 10)).alias("dim_id"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 5 != 0, pad_code("o_custkey", 10)).alias("system_id"))
    return lookup(orders, dim, ["o_custkey"]).select("o_orderkey", F.coalesce("dim_id", "system_id").alias("client"))


@query("control_totals", """
WITH b AS (SELECT strftime(l_shipdate, '%Y') AS y, CAST(l_extendedprice AS DECIMAL(18,2)) AS v, l_returnflag FROM lineitem)
SELECT y, CAST(SUM(v) AS DOUBLE) AS total_before, CAST(COALESCE(SUM(v) FILTER (l_returnflag <> 'R'), 0) AS DOUBLE) AS total_after,
  COUNT(*) AS rows_before, COUNT(*) FILTER (l_returnflag <> 'R') AS rows_after,
  CAST(COALESCE(SUM(v) FILTER (l_returnflag <> 'R'), 0) - SUM(v) AS DOUBLE) AS total_change, COUNT(*) FILTER (l_returnflag <> 'R') - COUNT(*) AS rows_change
FROM b GROUP BY y
""")
def control_totals_query(spark, sf_dir):
    """Totals by year before and after a cleaning step, observed while the cleaned rows are written."""
    rows = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy").alias("y"), "l_returnflag", F.col("l_extendedprice").alias("v"))
    years = Controls(measure="v", key="y", members=[str(y) for y in range(1990, 2010)])
    _, before, after = written_with_controls(rows, lambda df: df.filter("l_returnflag <> 'R'"), working_folder(spark, "cleaned"), years)
    return shown(observed_totals(spark, "y", before, after))


@query("domain_check", """
SELECT c_mktsegment, COUNT(*) AS rows FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') GROUP BY c_mktsegment
""")
def domain_check_query(spark, sf_dir):
    """Values outside the allowed list, observed while the table is written."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    controls = Controls(domains={"c_mktsegment": ["BUILDING", "MACHINERY", "HOUSEHOLD"]})
    _, (known, seen), _ = written_with_controls(customers, lambda df: df, working_folder(spark, "checked"), controls)
    found = [(value, rows) for _, value, rows in known.violations(seen)]
    return spark.createDataFrame(found, "c_mktsegment string, rows long")


@query("unclassified", """
SELECT 'LES PROBLEMES' AS fund, COUNT(*) AS rows, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM lineitem WHERE l_suppkey NOT IN (1, 2, 3) HAVING COUNT(*) > 0
""")
def unclassified_query(spark, sf_dir):
    """What a rule table left on its default."""
    funds = rb.campaign_fund({"1": "Fund one", "2": "Fund two", "3": "Fund three"})
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("CODE_ISIN"), F.col("l_extendedprice").cast(MONEY).alias("v"))
    return shown(unclassified(rows.withColumn("fund", funds.column()), "fund", [rb.UNKNOWN_FUND], "v"))


@query("distinct_members", "SELECT DISTINCT upper(p_type) AS member FROM part WHERE upper(p_type) LIKE '%M%'")
def distinct_members(spark, sf_dir):
    members = table(spark, sf_dir, "part").select(F.upper("p_type").alias("member")).distinct()
    return members.filter(F.col("member").like("%M%"))


@query("campaign_labels", """
SELECT CASE WHEN k IN ('011','012','039') THEN '4 : A2P' WHEN k IN ('010','001','006','007','009','038','028') THEN '1 : AGA' WHEN k IN ('013','014') THEN '3 : Salarié' ELSE 'Autre' END AS network,
  COUNT(*) AS customers FROM (SELECT lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS k FROM customer) GROUP BY 1
""")
def campaign_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(pad_code(F.col("c_nationkey").cast("string"), 3).alias("CANAL_RDU_PRINCIPAL"))
    return rows.groupBy(rb.CAMPAIGN_NETWORK.column().alias("network")).agg(F.count(F.lit(1)).alias("customers"))


@query("support_labels", """
WITH p AS (SELECT CASE p_type WHEN 'PROMO' THEN 'EUR' WHEN 'SMALL' THEN 'UC' WHEN 'LARGE' THEN 'EUC' ELSE p_type END AS t FROM part),
s AS (SELECT CASE t WHEN 'EUR' THEN 'EURO' WHEN 'EUC' THEN 'EUROCROISSANCE' ELSE t END AS support FROM p)
SELECT support, CASE WHEN support IN ('EURO', 'EUROCROISSANCE') THEN 'EURO' ELSE 'UC' END AS two_types, COUNT(*) AS parts FROM s GROUP BY ALL
""")
def support_labels(spark, sf_dir):
    """Support type, then collapsed to two."""
    raw = RuleSet([("p_type = 'PROMO'", "EUR"), ("p_type = 'SMALL'", "UC"), ("p_type = 'LARGE'", "EUC")], rb.FromColumn("p_type"))
    rows = table(spark, sf_dir, "part").withColumn("LB_TYPE", raw.column()).withColumn("TYPE_SUPPORT", rb.SUPPORT_TYPE_1.column())
    return rows.groupBy(F.col("TYPE_SUPPORT").alias("support"), rb.TWO_SUPPORT_TYPES.column().alias("two_types")).agg(F.count(F.lit(1)).alias("parts"))


@query("file_network_labels", """
WITH n AS (SELECT CASE c_nationkey % 9 WHEN 0 THEN 'x AEP' WHEN 1 THEN 'AGA 1' WHEN 2 THEN 'Agents LU' WHEN 3 THEN 'A2P+' WHEN 4 THEN 'CGP' WHEN 5 THEN 'Direct'
  WHEN 6 THEN '#NA' WHEN 7 THEN 'xPartx' ELSE 'zzz' END AS r FROM customer)
SELECT CASE WHEN contains(r, 'AEP') THEN 'AEP' WHEN contains(r, 'AGA') OR contains(r, 'Agents LU') THEN 'AGA' WHEN contains(r, 'A2P') THEN 'A2P' WHEN contains(r, 'CGP') THEN 'CGPI'
  WHEN contains(r, 'Direct') THEN 'GESTION PRIVEE DIRECTE' WHEN contains(r, '#NA') OR r LIKE '%Part%' THEN 'PARTENAIRE BANCAIRE' ELSE 'AGA' END AS network, COUNT(*) AS n FROM n GROUP BY 1
""")
def file_network_labels(spark, sf_dir):
    raw = ["x AEP", "AGA 1", "Agents LU", "A2P+", "CGP", "Direct", "#NA", "xPartx"]
    label = RuleSet([(f"c_nationkey % 9 = {i}", r) for i, r in enumerate(raw)], "zzz").column()
    rows = table(spark, sf_dir, "customer").select(label.alias("RESEAU"))
    return rows.groupBy(rb.FILE_NETWORK.column().alias("network")).agg(F.count(F.lit(1)).alias("n"))
