"""Flow classification and amount operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedupe import group_totals
from ..operators.flows import (
    gross_up, motive_flags, net_inflow, new_business, new_contract, period_columns, period_sums, scaled, sign_normalised, split_by_label,
    status_count, switch_nature, units_times_price,
)
from ..operators.joins import settled
from ..operators.rules import BucketSet, RuleSet
from ..plans import rulebook as rb
from .registry import query, shown, table

MONEY = "decimal(18,2)"


@query("flow_buckets", """
SELECT user_id,
  CAST(SUM(CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS inflow,
  CAST(SUM(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS switch_in,
  CAST(SUM(CASE WHEN event_type = 'click' AND value > 10 THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS switch_in_auto,
  CAST(SUM(CASE WHEN event_type = 'error' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS fee,
  CAST(SUM(CASE WHEN event_type = 'click' AND NOT value > 10 THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS switch_in_client,
  CAST(SUM(CASE WHEN event_type IN ('purchase', 'signup', 'error') THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS total,
  COUNT(*) AS movements
FROM events GROUP BY user_id
""")
def flow_buckets(spark, sf_dir):
    """Labels to buckets, with a total and a complement."""
    buckets = BucketSet(
        amount="amount",
        rules=[
            ("inflow", "event_type IN ('purchase', 'signup')", 1),
            ("switch_in", "event_type = 'click'", 1),
            ("switch_in_auto", "event_type = 'click' AND amount > 10", 1),
            ("fee", "event_type = 'error'", 1),
        ],
        totals={"total": ("inflow", "fee")},
        differences={"switch_in_client": ("switch_in", "switch_in_auto")},
    )
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.col("value").cast(MONEY).alias("amount"))
    return shown(buckets.aggregate(rows, ["user_id"], F.count(F.lit(1)).alias("movements")))


ACT_CODES = ("VI", "CC", "RN", "VC", "PA", "QH", "AE", "TA", "EA", "SA", "RT", "RP", "AP", "EX", "AH", "SI", "TP", "AV", "FR", "PB", "XX")
ACTS = f"""
a AS (SELECT l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS m,
        ([{', '.join(repr(c) for c in ACT_CODES)}])[(l_partkey + l_linenumber) % {len(ACT_CODES)} + 1] AS code,
        CASE WHEN l_returnflag = 'A' THEN 'RAG' WHEN l_returnflag = 'N' THEN 'X' END AS motive,
        CASE WHEN l_linestatus = 'O' THEN 'RAG' ELSE 'Y' END AS extra,
        CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS te, CASE WHEN l_tax >= 0.05 THEN 1 ELSE 0 END AS ts FROM lineitem)
"""


def coded_acts(spark, sf_dir):
    codes = F.array(*[F.lit(c) for c in ACT_CODES])
    index = ((F.col("l_partkey") + F.col("l_linenumber")) % len(ACT_CODES) + 1).cast("int")
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.col("l_extendedprice").cast(MONEY).alias("MONTANT_BRUT"),
        F.element_at(codes, index).alias("CODE_ACTE_COURT"),
        RuleSet([("l_returnflag = 'A'", "RAG"), ("l_returnflag = 'N'", "X")]).column().alias("LIBELLE_MOTIF_ACTE"),
        RuleSet([("l_linestatus = 'O'", "RAG")], "Y").column().alias("LIBELLE_ACTE_COMPLEMENT"),
        F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("TOP_TE"),
        F.when(F.col("l_tax") >= 0.05, 1).otherwise(0).alias("TOP_TS"),
    )


def _sum(condition: str, sign: str = "") -> str:
    return f"SUM(CASE WHEN {condition} THEN {sign}m ELSE 0 END)"


RAG = "(motive = 'RAG' OR extra = 'RAG')"
REVERSALS_INNER = f"""
SELECT l_suppkey,
  SUM(CASE WHEN code IN ('VI','CC') AND te = 0 THEN m WHEN code IN ('RN','SE') THEN -m ELSE 0 END) AS "Versement_Initial",
  {_sum("code = 'VC'")} AS "Versement_Complementaire",
  SUM(CASE WHEN code IN ('PA','QT','QH') THEN m WHEN code IN ('AE','QR') THEN -m ELSE 0 END) AS "Prelevement_Automatique",
  {_sum("(code IN ('VI','CC') AND te = 1) OR code IN ('TA','TE','VP','VT')")} AS "Transfert_Entrant",
  {_sum(f"code = 'EA' AND {RAG}")} AS "Arbitrage_Entrant_RAG",
  {_sum(f"code = 'SA' AND {RAG}")} AS "Arbitrage_Sortant_RAG",
  {_sum(f"code = 'EA' AND NOT COALESCE({RAG}, FALSE)")} AS "Arbitrage_Entrant_Client",
  {_sum(f"code = 'SA' AND NOT COALESCE({RAG}, FALSE)")} AS "Arbitrage_Sortant_Client",
  SUM(CASE WHEN code IN ('RT','RP','RG') AND ts = 0 THEN m WHEN code IN ('AP','AT','AX') THEN -m ELSE 0 END) AS "Rachat",
  SUM(CASE WHEN code IN ('EX','RE') THEN m WHEN code = 'AH' THEN -m ELSE 0 END) AS "Echu",
  {_sum("code = 'SI'")} AS "Sinistre",
  SUM(CASE WHEN (code IN ('RT','RP','RG') AND ts = 1) OR code IN ('TP','TT') THEN m WHEN code IN ('AV','AQ') THEN -m ELSE 0 END) AS "Transfert_Sortant",
  {_sum("code = 'FR'")} AS "Frais_de_gestion", {_sum("code = 'PB'")} AS "Participation_aux_benefices"
FROM a GROUP BY l_suppkey
"""


@query("flow_reversals", f"""
WITH {ACTS}, s AS ({REVERSALS_INNER})
SELECT l_suppkey, COLUMNS(* EXCLUDE (l_suppkey))::DOUBLE,
  CAST("Versement_Initial" + "Versement_Complementaire" + "Prelevement_Automatique" + "Transfert_Entrant" AS DOUBLE) AS "Collecte_Brute_TOTALE",
  CAST("Rachat" + "Echu" + "Sinistre" + "Transfert_Sortant" AS DOUBLE) AS "Prestation_TOTALE",
  CAST("Arbitrage_Entrant_RAG" + "Arbitrage_Entrant_Client" AS DOUBLE) AS "Arbitrage_Entrant",
  CAST("Arbitrage_Sortant_RAG" + "Arbitrage_Sortant_Client" AS DOUBLE) AS "Arbitrage_Sortant"
FROM s
""")
def flow_reversals(spark, sf_dir):
    """Act codes to buckets; reversal codes count negative."""
    return shown(rb.system2_buckets().aggregate(coded_acts(spark, sf_dir), ["l_suppkey"]))


@query("flow_switches_legacy", f"""
WITH {ACTS}
SELECT l_suppkey, CAST({_sum(f"code = 'EA' AND {RAG}")} AS DOUBLE) AS "Arbitrage_Entrant_RAG",
  CAST({_sum("code = 'EA' AND (motive <> 'RAG' OR extra <> 'RAG')")} AS DOUBLE) AS "Arbitrage_Entrant_Client"
FROM a GROUP BY l_suppkey
""")
def flow_switches_legacy(spark, sf_dir):
    """The inherited switch test: a row with exactly one RAG label counts on both sides."""
    sums = rb.system2_buckets(legacy_switches=True).aggregate(coded_acts(spark, sf_dir), ["l_suppkey"])
    return shown(sums.select("l_suppkey", "Arbitrage_Entrant_RAG", "Arbitrage_Entrant_Client"))


TYPED = """
t AS (SELECT l_suppkey, l_shipdate,
    CASE WHEN l_linenumber <= 3 THEN 'VERSEMENT' WHEN l_linenumber <= 5 THEN 'RACHAT TOTAL' ELSE 'REORIENTATION D''EPARGNE' END AS family,
    CASE CAST(round(l_tax * 100) AS INTEGER) WHEN 0 THEN 'Versement initial' WHEN 1 THEN 'Versement transfert' WHEN 2 THEN 'Rachat partiel'
      WHEN 3 THEN 'Sortie décès' WHEN 4 THEN 'Conversion en rente' WHEN 5 THEN 'Transfert'
      WHEN 6 THEN 'Ajustement annuel gratuit' WHEN 7 THEN 'Annulation : Ajustement annuel gratuit' ELSE 'Divers' END AS detail,
    CASE WHEN l_discount >= 0.05 THEN 'PRELEVEMENT' ELSE 'CHEQUE' END AS pay,
    CASE WHEN l_quantity <= 20 THEN 'MONTANT_NET' WHEN l_quantity <= 40 THEN 'MONTANT_BRUT' WHEN l_quantity <= 45 THEN 'FRAIS_ARBITRAGE'
      WHEN l_quantity <= 48 THEN 'FRAIS_FIXES' ELSE 'FRAIS_GESTION' END AS category,
    CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2)) AS m FROM lineitem),
y AS (SELECT *, CASE WHEN family = 'VERSEMENT' THEN CASE detail WHEN 'Versement initial' THEN 'VI' WHEN 'Versement transfert' THEN 'TE'
        ELSE CASE WHEN pay = 'PRELEVEMENT' THEN 'PA' ELSE 'VC' END END
    WHEN family = 'RACHAT TOTAL' THEN CASE detail WHEN 'Rachat partiel' THEN 'RT' WHEN 'Sortie décès' THEN 'SI' WHEN 'Conversion en rente' THEN 'EC'
        ELSE CASE WHEN contains(detail, 'Transfert') THEN 'TS' ELSE 'AR' END END
    ELSE CASE WHEN (detail LIKE 'Annulation :%') = (m < 0) THEN 'AE' ELSE 'AS' END END AS ty FROM t),
z AS (SELECT *, CASE WHEN ty IN ('AE','AS') AND category IN ('MONTANT_NET','FRAIS_ARBITRAGE') THEN m
                     WHEN ty NOT IN ('AE','AS') AND category = 'MONTANT_BRUT' THEN m ELSE 0 END AS a FROM y)
"""


def typed_movements(spark, sf_dir):
    step = F.round(F.col("l_tax") * 100).cast("int")
    return table(spark, sf_dir, "lineitem").withColumn("step", step).select(
        "l_suppkey", "l_shipdate",
        RuleSet([("l_linenumber <= 3", "VERSEMENT"), ("l_linenumber <= 5", "RACHAT TOTAL")], rb.REALLOCATION).column().alias("LIBELLE_TYPE_TRANSACTION"),
        RuleSet([(f"step = {i}", text) for i, text in enumerate([
            "Versement initial", "Versement transfert", "Rachat partiel", "Sortie décès", "Conversion en rente", "Transfert",
            "Ajustement annuel gratuit", "Annulation : Ajustement annuel gratuit"])], "Divers").column().alias("DETAIL_TRANSACTION"),
        RuleSet([("l_discount >= 0.05D", "PRELEVEMENT")], "CHEQUE").column().alias("LIBELLE_PAIEMENT"),
        RuleSet([("l_quantity <= 20", "MONTANT_NET"), ("l_quantity <= 40", "MONTANT_BRUT"), ("l_quantity <= 45", "FRAIS_ARBITRAGE"),
                 ("l_quantity <= 48", "FRAIS_FIXES")], "FRAIS_GESTION").column().alias("CATEGORIE_TYPE_MONTANT"),
        sign_normalised("l_extendedprice", F.col("l_returnflag") == "R").cast(MONEY).alias("MONTANT"),
    )


FREE_AE = "ty = 'AE' AND ((detail = 'Ajustement annuel gratuit' AND a >= 0) OR (detail = 'Annulation : Ajustement annuel gratuit' AND a < 0))"
FREE_AS = ("ty = 'AS' AND category IN ('MONTANT_NET','FRAIS_ARBITRAGE') AND "
           "((detail = 'Ajustement annuel gratuit' AND a < 0) OR (detail = 'Annulation : Ajustement annuel gratuit' AND a >= 0))")


@query("flow_two_stage", f"""
WITH {TYPED},
s AS (SELECT l_suppkey,
  SUM(CASE WHEN ty = 'VI' THEN a ELSE 0 END) AS vi, SUM(CASE WHEN ty = 'VC' THEN a ELSE 0 END) AS vc,
  SUM(CASE WHEN ty = 'TE' THEN a ELSE 0 END) AS te, SUM(CASE WHEN ty = 'PA' THEN a ELSE 0 END) AS pa,
  SUM(CASE WHEN ty = 'AE' THEN a ELSE 0 END) AS ae, SUM(CASE WHEN {FREE_AE} THEN a ELSE 0 END) AS aer,
  SUM(CASE WHEN ty = 'AS' THEN -a ELSE 0 END) AS sa, SUM(CASE WHEN {FREE_AS} THEN -a ELSE 0 END) AS sar,
  SUM(CASE WHEN ty IN ('RT','AR') THEN a ELSE 0 END) AS rt, SUM(CASE WHEN ty = 'SI' THEN a ELSE 0 END) AS si,
  SUM(CASE WHEN ty = 'EC' THEN a ELSE 0 END) AS ec, SUM(CASE WHEN ty = 'TS' THEN a ELSE 0 END) AS ts FROM z GROUP BY 1)
SELECT l_suppkey, CAST(vi AS DOUBLE) AS "Versement_Initial", CAST(vc AS DOUBLE) AS "Versement_Complementaire", CAST(te AS DOUBLE) AS "Transfert_Entrant",
  CAST(pa AS DOUBLE) AS "Prelevement_Automatique", CAST(ae AS DOUBLE) AS "Arbitrage_Entrant", CAST(aer AS DOUBLE) AS "Arbitrage_Entrant_RAG",
  CAST(sa AS DOUBLE) AS "Arbitrage_Sortant", CAST(sar AS DOUBLE) AS "Arbitrage_Sortant_RAG", CAST(rt AS DOUBLE) AS "Rachat",
  CAST(si AS DOUBLE) AS "Sinistre", CAST(ec AS DOUBLE) AS "Echu", CAST(ts AS DOUBLE) AS "Transfert_Sortant",
  CAST(ae - aer AS DOUBLE) AS "Arbitrage_Entrant_Client", CAST(sa - sar AS DOUBLE) AS "Arbitrage_Sortant_Client",
  CAST(vi + vc + te + pa AS DOUBLE) AS "Collecte_Brute_TOTALE", CAST(rt + si + ec + ts AS DOUBLE) AS "Prestation_TOTALE"
FROM s
""")
def flow_two_stage(spark, sf_dir):
    """Type code first, then the amount by type and category, then buckets."""
    typed = typed_movements(spark, sf_dir).withColumn("Type_Transaction", rb.SYSTEM3_TYPES.column())
    return shown(rb.SYSTEM3_BUCKETS.aggregate(typed.withColumn("MONTANT_TRANSACTION", rb.SYSTEM3_AMOUNT.column()), ["l_suppkey"]))


@query("fee_buckets", f"""
WITH {TYPED}
SELECT l_suppkey,
  CAST(SUM(CASE WHEN family = 'VERSEMENT' AND category = 'FRAIS_FIXES' AND m > 0 THEN m ELSE 0 END) AS DOUBLE) AS "Frais_Versement",
  CAST(SUM(CASE WHEN family LIKE 'REORIENTATION%' AND category = 'FRAIS_ARBITRAGE' AND m > 0 THEN m ELSE 0 END) AS DOUBLE) AS "Frais_Arbitrage",
  CAST(SUM(CASE WHEN family = 'RACHAT TOTAL' AND category = 'FRAIS_GESTION' AND m > 0 THEN m ELSE 0 END) AS DOUBLE) AS "Frais_Rachat"
FROM t GROUP BY l_suppkey
""")
def fee_buckets(spark, sf_dir):
    return shown(rb.SYSTEM3_FEES.aggregate(typed_movements(spark, sf_dir), ["l_suppkey"]))


@query("settled_flows", """
SELECT o_custkey, l_returnflag, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, COUNT(*) AS movements
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderstatus = 'F' AND l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'
GROUP BY ALL
""")
def settled_flows(spark, sf_dir):
    """Movements of a period whose header is settled."""
    detail = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate").cast("date").between("1998-01-01", "1998-12-31"))
    header = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    rows = settled(detail, header, ["l_orderkey"], F.col("o_orderstatus") == "F")
    return shown(rows.groupBy("o_custkey", "l_returnflag").agg(
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("amount"), F.count(F.lit(1)).alias("movements")))


@query("gross_up", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS net
           FROM lineitem),
g AS (SELECT l_orderkey, SUM(net) AS total FROM l GROUP BY l_orderkey)
SELECT l.l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(net AS DOUBLE) AS net,
  CASE WHEN total = 0 THEN 0 ELSE CAST(
    ((2 * CAST(net * 100 AS HUGEINT) * CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS HUGEINT) * 10000 + CAST(total * 100 AS HUGEINT))
      // (2 * CAST(total * 100 AS HUGEINT)) + 50) // 100 AS DOUBLE) / 10000 END AS gross
FROM l JOIN g ON l.l_orderkey = g.l_orderkey JOIN orders ON l.l_orderkey = o_orderkey
""")
def gross_up_query(spark, sf_dir):
    """The order's total spread over its lines by net amount; an order whose lines sum to 0 gives 0."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast(MONEY).alias("units"), F.col("l_tax").cast(MONEY).alias("price"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").cast(MONEY).alias("whole"))
    priced = lines.withColumn("net", units_times_price("units", "price").cast(MONEY)).drop("units", "price").join(orders, ["l_orderkey"])
    spread = gross_up(priced, "net", "whole", ["l_orderkey"], "gross")
    return shown(spread.withColumn("gross", F.round("gross", 4)).drop("whole"))


@query("sign_normalise", """
WITH e AS (SELECT event_type, user_id, CAST(CASE WHEN user_id % 2 = 0 THEN -value ELSE value END AS DECIMAL(18,2)) AS m FROM events),
n AS (SELECT *, CASE WHEN event_type = 'click' AND m < 0 THEN 'out' WHEN event_type = 'click' AND m > 0 THEN 'in' ELSE event_type END AS nature FROM e)
SELECT nature, CAST(SUM(CASE WHEN nature IN ('out', 'error') THEN -m ELSE m END) AS DOUBLE) AS amount,
       CAST(SUM(CASE WHEN nature IN ('out', 'error') THEN -m ELSE m END) AS DOUBLE) / 1000 AS thousands, COUNT(*) AS n FROM n GROUP BY nature
""")
def sign_normalise(spark, sf_dir):
    """Switches named by their sign, outflows made positive, amounts in thousands."""
    rows = table(spark, sf_dir, "events").select(
        "event_type", F.lit("customer").alias("act_group"), sign_normalised("value", F.col("user_id") % 2 == 0).cast(MONEY).alias("m"))
    is_click = rows.withColumn("grp", F.when(F.col("event_type") == "click", "click").otherwise("other"))
    named = is_click.withColumn("nature", switch_nature("grp", "m", "event_type", "click", "never", "out", "in"))
    totals = named.withColumn("m", sign_normalised("m", F.col("nature").isin("out", "error"))).groupBy("nature").agg(
        F.sum("m").cast("double").alias("amount"), F.count(F.lit(1)).alias("n"))
    return totals.withColumn("thousands", scaled("amount"))


@query("split_by_support", """
SELECT l_suppkey,
  CAST(SUM(CASE WHEN p_type = 'PROMO' THEN v ELSE 0 END) AS DOUBLE) AS "amount_PROMO",
  CAST(SUM(CASE WHEN p_type = 'SMALL' THEN v ELSE 0 END) AS DOUBLE) AS "amount_SMALL",
  CAST(SUM(CASE WHEN p_type = 'LARGE' THEN v ELSE 0 END) AS DOUBLE) AS "amount_LARGE"
FROM (SELECT l_suppkey, p_type, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem JOIN part ON l_partkey = p_partkey)
GROUP BY l_suppkey
""")
def split_by_support(spark, sf_dir):
    """One measure in columns by support type."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", F.col("l_extendedprice").cast(MONEY).alias("amount")).join(parts, ["l_partkey"])
    split = split_by_label("amount", "p_type", ["PROMO", "SMALL", "LARGE"])
    return shown(rows.groupBy("l_suppkey").agg(*[F.sum(c).alias(n) for n, c in split.items()]))


@query("net_inflow", """
WITH u AS (SELECT user_id, SUM(CASE WHEN event_type = 'purchase' THEN v ELSE 0 END) AS i, SUM(CASE WHEN event_type = 'error' THEN v ELSE 0 END) AS o,
    SUM(CASE WHEN event_type = 'click' THEN v ELSE 0 END) AS si, SUM(CASE WHEN event_type = 'view' THEN v ELSE 0 END) AS so
  FROM (SELECT user_id, event_type, CAST(value AS DECIMAL(18,2)) AS v FROM events) GROUP BY user_id)
SELECT user_id, CAST(i AS DOUBLE) AS inflow, CAST(o AS DOUBLE) AS outflow, CAST(si AS DOUBLE) AS switch_in, CAST(so AS DOUBLE) AS switch_out,
  CAST(i - o + si - so AS DOUBLE) AS net FROM u
""")
def net_inflow_query(spark, sf_dir):
    kinds = {"purchase": "inflow", "error": "outflow", "click": "switch_in", "view": "switch_out"}
    buckets = BucketSet([(name, rb.same("event_type", kind), 1) for kind, name in kinds.items()], "amount")
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.col("value").cast(MONEY).alias("amount"))
    return shown(buckets.aggregate(rows, ["user_id"]).withColumn("net", net_inflow("inflow", "outflow", "switch_in", "switch_out")))


@query("new_business", """
WITH r AS (SELECT o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS v, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT o_custkey, CAST(SUM(CASE WHEN year(o_orderdate) = 1998 THEN v ELSE 0 END) AS DOUBLE) AS new_business,
  CAST(SUM(CASE WHEN rn = 1 AND year(o_orderdate) = 1998 THEN 1 ELSE 0 END) AS BIGINT) AS new_contracts FROM r GROUP BY o_custkey
""")
def new_business_query(spark, sf_dir):
    """Inflow of contracts that took effect in the year, and their count by the counted row."""
    from ..operators.dedupe import flag_one_per_key

    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("effect"), F.col("o_totalprice").cast(MONEY).alias("inflow"))
    counted = flag_one_per_key(orders, ["o_custkey"], ["effect", "o_orderkey"], "CNT")
    return shown(counted.groupBy("o_custkey").agg(
        F.sum(new_business("effect", 1998, "inflow")).alias("new_business"), F.sum(new_contract("effect", 1998, "CNT")).alias("new_contracts")))


@query("period_compare", """
WITH l AS (SELECT l_returnflag, l_linestatus, year(l_shipdate) AS y, month(l_shipdate) AS m, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem)
SELECT l_returnflag, l_linestatus,
  CAST(SUM(CASE WHEN y = 1999 AND m <= 7 THEN v ELSE 0 END) AS DOUBLE) AS "MT_REEL_MOIS_N",
  CAST(SUM(CASE WHEN y = 1998 AND m <= 7 THEN v ELSE 0 END) AS DOUBLE) AS "MT_REEL_MOIS_N_1",
  CAST(SUM(CASE WHEN y = 1998 THEN v ELSE 0 END) AS DOUBLE) AS "MT_REEL_ANNEE_N_1",
  CAST(SUM(CASE WHEN y = 1997 THEN v ELSE 0 END) AS DOUBLE) AS "MT_REEL_ANNEE_N_2"
FROM l GROUP BY ALL
""")
def period_compare(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"), F.col("l_extendedprice").cast(MONEY).alias("v"))
    return shown(period_sums(rows, ["l_returnflag", "l_linestatus"], period_columns("y", "m", "v", 1999, 7)))


@query("status_counter", """
SELECT o_orderpriority, CAST(SUM(CASE WHEN o_orderstatus IN ('F', 'P') OR o_totalprice > 250000 THEN 1 ELSE 0 END) AS BIGINT) AS counted, COUNT(*) AS orders
FROM orders GROUP BY o_orderpriority
""")
def status_counter(spark, sf_dir):
    """A counter that needs a listed status or an inflow above the threshold."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderpriority", "o_orderstatus", (F.col("o_totalprice") - 250000).alias("inflow"), F.lit(1).alias("cnt"))
    return shown(rows.groupBy("o_orderpriority").agg(
        status_count("cnt", "o_orderstatus", ["F", "P"], "inflow").alias("counted"), F.count(F.lit(1)).alias("orders")))


@query("transfer_flags", """
SELECT o_custkey, CAST(MAX(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS BIGINT) AS "TOP_TE",
  CAST(MAX(CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) AS "TOP_TS" FROM orders GROUP BY o_custkey
""")
def transfer_flags(spark, sf_dir):
    """Entry and exit flags of a contract over its whole history, one row per contract."""
    orders = table(spark, sf_dir, "orders").withColumn("exit", F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")))
    return shown(motive_flags(orders, ["o_custkey"], {
        "TOP_TE": ("o_orderpriority", ["1-URGENT", "2-HIGH"]), "TOP_TS": ("exit", ["5-LOW"])}))


@query("rounded_sums", """
SELECT p_brand, CAST(SUM(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)), 2) AS DECIMAL(18,2))) AS DOUBLE) AS rounded,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS exact, COUNT(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
""")
def rounded_sums(spark, sf_dir):
    """Sums of rounded products beside sums of exact ones."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    product = F.col("l_extendedprice").cast(MONEY) * F.col("l_discount").cast(MONEY)
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", product.alias("x")).join(parts, ["l_partkey"])
    return shown(rows.groupBy("p_brand").agg(
        F.sum(F.round("x", 2)).alias("rounded"), F.sum("x").alias("exact"), F.count(F.lit(1)).alias("n")))


@query("group_total_per_row", """
SELECT o_orderkey, o_custkey, COUNT(*) OVER (PARTITION BY o_custkey) AS orders_of_customer,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS customer_total FROM orders
""")
def group_total_per_row(spark, sf_dir):
    """Whole-group count and sum attached to each row."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast(MONEY).alias("v"))
    totals = {"orders_of_customer": F.count(F.lit(1)), "customer_total": F.sum("v")}
    return shown(group_totals(orders, ["o_custkey"], totals).drop("v"))
