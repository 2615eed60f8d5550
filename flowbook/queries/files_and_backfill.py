"""CSV ingestion, monthly stores, and the multi-month backfill."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.calendar import Period
from ..functions.codes import parse_number
from ..operators.backfill import carried_forward, refresh, year_to_date
from ..operators.checks import Controls, written_with_controls
from ..plans import csv_system
from ..plans.campaign import campaign_history, ledger_by_month
from ..session import remove_folder, working_folder
from ..sources.files import chosen_files, file_names, read_csv_lines, read_monthly_files, reject_counts, split_lines, write_by_file
from ..sources.tables import declared, read_day, read_month, write_month, write_partitions
from . import standins as st
from . import system_sql as sq
from .registry import query, shown, table
from .reports_and_systems import intermediate, network

MONEY = "decimal(18,2)"
FIRST, LAST = Period(1997, 11), Period(1998, 6)
FUNDS = {"FR0011129717": "Fund A", "FR0013076031": "Fund B", "FR0013466562": "Fund B"}


@query("backfill_ytd", """
WITH p AS (SELECT CAST(unnest(generate_series(DATE '1997-11-01', DATE '1998-06-01', INTERVAL 1 MONTH)) AS DATE) AS period)
SELECT period, l_returnflag, l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM p JOIN lineitem ON CAST(l_shipdate AS DATE) BETWEEN CAST(date_trunc('year', period) AS DATE) AND last_day(period) GROUP BY ALL
""")
def backfill_ytd(spark, sf_dir):
    """Year-to-date flows of eight reporting months in one job."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_suppkey", F.col("l_shipdate").cast("date").alias("d"), F.col("l_extendedprice").cast(MONEY).alias("amount"))
    return shown(year_to_date(lines, ["l_returnflag", "l_suppkey"], "d", ["amount"], FIRST, LAST))


@query("backfill_delta", """
WITH p AS (SELECT CAST(unnest(generate_series(DATE '1997-11-01', DATE '1998-06-01', INTERVAL 1 MONTH)) AS DATE) AS period)
SELECT strftime(period, '%Y%m') AS period, l_returnflag, l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, strftime(period, '%Y%m') >= '199804' AS again
FROM p JOIN lineitem ON CAST(l_shipdate AS DATE) BETWEEN CAST(date_trunc('year', period) AS DATE) AND last_day(period) GROUP BY ALL
""")
def backfill_delta(spark, sf_dir):
    """A stored backfill of eight months after late movements of April 1998: April to June are computed again, the others stay."""
    keys = ["l_returnflag", "l_suppkey"]
    source, target, state = (working_folder(spark, name) for name in ("movements", "ledger", "ledger-state"))
    lines = table(spark, sf_dir, "lineitem").select(
        *keys, F.col("l_shipdate").cast("date").alias("d"), F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.date_format("l_shipdate", "yyyyMM").alias("func_month"), "l_linenumber")
    late = (F.col("func_month") == "199804") & (F.col("l_linenumber") % 3 == 0)
    write_partitions(lines.filter(~late), source, ["func_month"])

    def build(rows, first, last):
        return year_to_date(rows, keys, "d", ["amount"], first, last)

    refresh(spark, source, target, state, build, FIRST, LAST)
    lines.filter(late).write.mode("append").partitionBy("func_month").parquet(source)
    again = refresh(spark, source, target, state, build, FIRST, LAST)
    stored = spark.read.parquet(target).withColumn("period", F.col("period").cast("string"))
    return shown(stored.withColumn("again", F.col("period").isin(*[p.key for p in again])))


@query("backfill_positions", """
WITH p AS (SELECT CAST(unnest(generate_series(DATE '1997-11-01', DATE '1998-06-01', INTERVAL 1 MONTH)) AS DATE) AS period),
d AS (SELECT l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS d, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY ALL)
SELECT period, l_suppkey, l_returnflag, CAST(v AS DOUBLE) AS value FROM p JOIN d ON d.d <= last_day(period)
QUALIFY ROW_NUMBER() OVER (PARTITION BY period, l_suppkey, l_returnflag ORDER BY d.d DESC) = 1
""")
def backfill_positions(spark, sf_dir):
    """The newest valuation of each key at the end of each of eight months, in one job."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("d"), F.col("l_extendedprice").cast(MONEY).alias("value"))
    return shown(carried_forward(lines, ["l_suppkey", "l_returnflag"], "d", "value", FIRST, LAST))


def _flux(label: str, more: str = "") -> str:
    return f"SUM(CASE WHEN LB_TYPE_FLUX = '{label}'{more} THEN MT_BRUT ELSE 0 END)"


_LEDGER = f"""
{sq.SEGMENTS}, {st.ctes(st.SYSTEM1, 's1')},
p AS (SELECT CAST(unnest(generate_series(DATE '1997-11-01', DATE '1998-06-01', INTERVAL 1 MONTH)) AS DATE) AS period),
mv AS (SELECT d.* REPLACE (COALESCE(CD_OG, 'libre') AS CD_OG), LB_TYPE_MVT FROM s1_movement_detail d JOIN s1_movement_header USING (ID_CONTRAT, ID_MVT) WHERE LB_STATUT = 'Soldé'),
f AS (SELECT period, {sq.K1}, {_flux('Prime comptant')} AS vi, {_flux('Versement libre')} AS vc, {_flux('Versement libre programmé')} AS pa, {_flux('Transfert interne entrant')} AS te,
  {_flux('Rachat partiel')} + {_flux('Paiement dossier sinistre')} + {_flux('Transfert interne sortant')} AS out, {_flux('Arbitrage achat')} AS ae, {_flux('Arbitrage vente')} AS sa,
  {_flux('Frais de gestion')} + {_flux('Frais sur investissement')} AS fees
  FROM p JOIN mv ON DT_INVEST BETWEEN CAST(date_trunc('year', period) AS DATE) AND last_day(period) GROUP BY ALL),
v AS (SELECT * REPLACE (COALESCE(CD_OG, 'libre') AS CD_OG) FROM s1_positions),
vd AS (SELECT {sq.K1}, DT_POSITION, SUM(PM) AS pm FROM v GROUP BY ALL),
pc AS (SELECT period, {sq.K1}, pm AS pf FROM p JOIN vd ON DT_POSITION <= last_day(period) QUALIFY ROW_NUMBER() OVER (PARTITION BY period, {sq.K1} ORDER BY DT_POSITION DESC) = 1),
po AS (SELECT period, {sq.K1}, pm AS pd FROM p JOIN vd ON DT_POSITION < date_trunc('year', period) QUALIFY ROW_NUMBER() OVER (PARTITION BY period, {sq.K1} ORDER BY DT_POSITION DESC) = 1),
g AS (SELECT period, {sq.K1}, {sq.total(('vi', 'vc', 'pa', 'te', 'out', 'ae', 'sa', 'fees', 'pd', 'pf'))}
  FROM (SELECT * FROM f UNION ALL BY NAME SELECT * FROM pc UNION ALL BY NAME SELECT * FROM po) GROUP BY ALL),
active AS (SELECT period, ID_CONTRAT FROM g GROUP BY ALL HAVING SUM(vi + vc + pa + te + out + ae + sa + fees + pd + pf) <> 0),
lg AS (SELECT g.* FROM g JOIN active a ON a.period = g.period AND a.ID_CONTRAT IS NOT DISTINCT FROM g.ID_CONTRAT)
"""


@query("backfill_ledger", f"""
WITH {_LEDGER}
SELECT period, CD_FUND AS "CD_FUND", CAST(SUM(vi + vc + pa + te) AS DOUBLE) AS "Collecte_Brute_TOTALE", CAST(SUM(out) AS DOUBLE) AS "Prestation_TOTALE",
  CAST(SUM(pd) AS DOUBLE) AS "PM_DEBUT", CAST(SUM(pf) AS DOUBLE) AS "PM_FIN", COUNT(*) AS positions FROM lg GROUP BY ALL
""")
def backfill_ledger(spark, sf_dir):
    """The ledger of eight months (flows, opening, closing, inactive contracts dropped per month), by fund."""
    months = ledger_by_month(st.frames(spark, sf_dir, st.SYSTEM1), FIRST, LAST)
    return shown(months.groupBy("period", "CD_FUND").agg(
        *[F.sum(c).alias(c) for c in ("Collecte_Brute_TOTALE", "Prestation_TOTALE", "PM_DEBUT", "PM_FIN")], F.count(F.lit(1)).alias("positions")))


@query("backfill_campaign", f"""
WITH {_LEDGER}, {sq.NETWORK_ROWS},
i AS (SELECT period, ID_CONTRAT, CD_FUND, SUM(vi + vc + pa + te) AS inflow FROM lg WHERE CD_FUND IN ('FR0011129717', 'FR0013076031', 'FR0013466562') GROUP BY ALL)
SELECT CAST(year(period) AS BIGINT) AS annee, CAST(month(period) AS BIGINT) AS mois,
  CASE WHEN CANAL_RDU_PRINCIPAL IN ('011','012','039') THEN '4 : A2P' WHEN CANAL_RDU_PRINCIPAL IN ('010','001','006','007','009','038','028') THEN '1 : AGA'
    WHEN CANAL_RDU_PRINCIPAL IN ('013','014') THEN '3 : Salarié' ELSE 'Autre' END AS reseau,
  CASE CD_FUND WHEN 'FR0011129717' THEN 'Fund A' ELSE 'Fund B' END AS fonds_campagne, CAST(SUM(inflow) AS DOUBLE) AS "Collecte_Brute"
FROM i JOIN s1_contracts_archive USING (ID_CONTRAT) LEFT JOIN nw ON CODE_PORTEFEUILLE = lpad(CD_PTF_RDU, 10, '0') GROUP BY ALL
""")
def backfill_campaign(spark, sf_dir):
    """Campaign-fund inflow by reporting month, network and fund."""
    tables = st.frames(spark, sf_dir, st.SYSTEM1)
    return shown(campaign_history(tables, network(spark, sf_dir), FUNDS, FIRST, LAST))


# --- files ------------------------------------------------------------------------------------

RESERVE_COLUMNS = (
    "NUMERO_CONTRAT", "SITUATION_CONTRAT", "CODE_PORTEFEUILLE", "RESEAU", "TYPE_SUPPORT", "ACTE_GESTION", "PM_FIN", "NOM_APPORTEUR", "NOM_PRODUIT",
    "DATE_EFFET_CONTRAT",
)
FLOW_COLUMNS = (
    "NUMERO_CONTRAT", "SITUATION_CONTRAT", "CODE_PORTEFEUILLE", "RESEAU", "TYPE_SUPPORT", "ACTE_GESTION", "TYPE_TRANSACTION", "MONTANT_BRUT", "MONTANT_NET",
    "DATE_EFFET_FLUX", "DATE_EFFET_CONTRAT", "NOM_APPORTEUR", "NOM_PRODUIT",
)
SCHEMAS = {"PM": declared({c: "string" for c in RESERVE_COLUMNS}), "FLUX": declared({c: "string" for c in FLOW_COLUMNS})}
TODAY = Period(2000, 9)
_RAW_NETWORKS = ("AEP x", "Agents LU", "A2P", "CGP", "Direct", "#NA", "Part. B", "zz")


def _written(amount):
    """An amount as the files hold it: spaces between thousands, comma for the point."""
    return F.translate(F.format_number(amount, 2), ",.", " ,")


def monthly_files(spark, sf_dir):
    """The order lines written as monthly CSV files ``<kind>_<month>_<year>.csv``.

    A file of that name is a folder of part files, as Spark writes it.  The lines are dealt by month once, before their
    texts are made, and stored so; both kinds are written from there without a further shuffle.
    """
    def write(folder):
        dealt = table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("d"),
            F.col("l_extendedprice").cast(MONEY).alias("amount")).withColumn("month", F.date_format("d", "yyyyMM"))
        stored = working_folder(spark, "lines-by-month")
        write_partitions(dealt, stored, ["month"])
        lines = spark.read.schema(dealt.schema).parquet(stored).drop("month")
        common = {
            "NUMERO_CONTRAT": F.when(F.col("l_suppkey") % 10 == 0, "0").otherwise(F.concat(F.lit("C"), "l_orderkey")),
            "SITUATION_CONTRAT": F.when(F.col("l_linenumber") == 7, "0").otherwise("En cours"),
            "CODE_PORTEFEUILLE": F.when(F.col("l_partkey") % 4 == 0, F.lit("9990001")).otherwise((F.col("l_suppkey") % 25).cast("string")),
            "RESEAU": F.element_at(F.array(*[F.lit(n) for n in _RAW_NETWORKS]), (F.col("l_suppkey") % 8 + 1).cast("int")),
            "TYPE_SUPPORT": F.when(F.col("l_returnflag") == "A", "EURO").otherwise("UC"),
            "NOM_APPORTEUR": F.concat(F.lit("App "), "l_suppkey"),
            "NOM_PRODUIT": F.concat(F.lit("Produit "), "l_linenumber"),
            "DATE_EFFET_CONTRAT": F.date_format("d", "dd/MM/yyyy"),
        }
        flow = {
            "ACTE_GESTION": F.when(F.col("l_linenumber") <= 2, "Rachat partiel").when(F.col("l_linenumber") == 3, "Arbitrage libre").otherwise("Versement"),
            "TYPE_TRANSACTION": F.when(F.col("l_linenumber") == 3, "Arbitrage").otherwise("Prime"),
            "MONTANT_BRUT": _written(F.when((F.col("l_linenumber") <= 2) | ((F.col("l_linenumber") == 3) & (F.col("l_returnflag") == "R")), -F.col("amount")).otherwise(F.col("amount"))),
            "MONTANT_NET": _written(F.col("amount")),
            "DATE_EFFET_FLUX": F.when(F.col("l_linestatus") == "O", F.date_format("d", "dd/MM/yyyy")),
        }
        reserve = {"ACTE_GESTION": F.lit("Encours"), "PM_FIN": _written(F.col("amount"))}
        for kind, columns, own in (("PM", RESERVE_COLUMNS, reserve), ("FLUX", FLOW_COLUMNS, flow)):
            name = F.concat(F.lit(f"{kind}_"), F.month("d"), F.lit("_"), F.year("d"), F.lit(".csv"))
            rows = lines.withColumns({**common, **own}).select(name.alias("file"), *columns)
            write_by_file(rows, f"{folder}/{kind}")
        remove_folder(spark, stored)

    return intermediate(spark, sf_dir, "files", write)


_FILES = f"""
l AS (SELECT *, CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem
  WHERE (month(l_shipdate) = 12 AND year(l_shipdate) < 2000) OR (year(l_shipdate) = 2000 AND month(l_shipdate) = 12)),
c AS (SELECT lpad('C' || l_orderkey, 16, '0') AS contract, lpad(CASE WHEN l_partkey % 4 = 0 THEN '9990001' ELSE CAST(l_suppkey % 25 AS VARCHAR) END, 10, '0') AS portfolio,
  CASE WHEN l_partkey % 4 = 0 THEN 1 ELSE 0 END AS international,
  ([{', '.join(repr(n) for n in ('AEP', 'AGA', 'A2P', 'CGPI', 'GESTION PRIVEE DIRECTE', 'PARTENAIRE BANCAIRE', 'PARTENAIRE BANCAIRE', 'AGA'))}])[l_suppkey % 8 + 1] AS network,
  CASE WHEN l_returnflag = 'A' THEN 'EURO' ELSE 'UC' END AS support, l_suppkey, l_linenumber AS ln, l_returnflag, l_linestatus, d, amount,
  CASE WHEN l_linenumber <= 2 OR (l_linenumber = 3 AND l_returnflag = 'R') THEN -amount ELSE amount END AS gross FROM l WHERE l_suppkey % 10 <> 0 AND l_linenumber <> 7),
u AS (SELECT DISTINCT 'PM' AS kind, contract, portfolio, international, network, support, 'Encours' AS act, NULL AS grp, NULL AS gross, NULL AS net, amount AS pm, d AS effect, NULL AS moved, l_suppkey, ln FROM c
  UNION ALL SELECT DISTINCT 'FLUX', contract, portfolio, international, network, support, CASE WHEN ln <= 2 THEN 'Rachat partiel' WHEN ln = 3 THEN 'Arbitrage libre' ELSE 'Versement' END,
    CASE WHEN ln = 3 THEN 'Arbitrage' ELSE 'Prime' END, gross, amount, NULL, d, CASE WHEN l_linestatus = 'O' THEN d END, l_suppkey, ln FROM c),
n AS (SELECT *, CASE WHEN grp = 'Arbitrage' AND gross < 0 THEN 'Arbitrage sortant' WHEN grp = 'Arbitrage' AND gross > 0 THEN 'Arbitrage entrant' ELSE act END AS nature FROM u)
"""


@query("csv_ingest", """
WITH l AS (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE (month(l_shipdate) = 12 AND year(l_shipdate) < 2000) OR (year(l_shipdate) = 2000 AND month(l_shipdate) = 12))
SELECT kind || '_' || month(d) || '_' || year(d) || '.csv' AS periode, CAST(month(d) AS BIGINT) AS mois_fichier, CAST(year(d) AS BIGINT) AS annee_fichier,
  CAST(9 AS BIGINT) AS mois_actuel, CAST(2000 AS BIGINT) AS annee_actuelle, COUNT(*) AS rows FROM l, (VALUES ('PM'), ('FLUX')) k(kind) GROUP BY ALL
""")
def csv_ingest(spark, sf_dir):
    """The chosen monthly files of both kinds, read with declared schemas and tagged with their origin."""
    rows = chosen_rows(spark, sf_dir)
    return shown(rows.groupBy("periode", "mois_fichier", "annee_fichier", "mois_actuel", "annee_actuelle").agg(F.count(F.lit(1)).alias("rows")))


def chosen_rows(spark, sf_dir):
    return read_monthly_files(spark, monthly_files(spark, sf_dir), SCHEMAS, TODAY)


@query("chosen_files", """
WITH m AS (SELECT DISTINCT year(l_shipdate) AS y, month(l_shipdate) AS m FROM lineitem)
SELECT kind, CAST(m AS BIGINT) AS month, CAST(y AS BIGINT) AS year FROM m, (VALUES ('PM'), ('FLUX')) k(kind)
WHERE (y < 2000 AND m = 12) OR (y = 2000 AND m = (SELECT MAX(m) FROM m WHERE y = 2000))
""")
def chosen_files_query(spark, sf_dir):
    """Which monthly files are read: every December of past years and the newest month of this one."""
    return shown(chosen_files(file_names(spark, monthly_files(spark, sf_dir)), TODAY).drop("path"))


@query("read_files", """
WITH m AS (SELECT DISTINCT year(l_shipdate) AS y, month(l_shipdate) AS m FROM lineitem WHERE (month(l_shipdate) = 12 AND year(l_shipdate) < 2000)
  OR (year(l_shipdate) = 2000 AND month(l_shipdate) = (SELECT MAX(month(l_shipdate)) FROM lineitem WHERE year(l_shipdate) = 2000)))
SELECT kind || '_' || m || '_' || y || '.csv' AS file_name FROM m, (VALUES ('PM'), ('FLUX')) k(kind)
""")
def read_files(spark, sf_dir):
    """Which monthly files were read, observed while their cleaned rows are written."""
    rows = chosen_rows(spark, sf_dir)
    _, (_, seen), _ = written_with_controls(rows, csv_system.clean, working_folder(spark, "cleaned-files"), Controls(file_column="periode"))
    return spark.createDataFrame([(name,) for name in seen.get["files"]], "file_name string")


_LINE_COLUMNS = ("NUMERO_CONTRAT", "SITUATION_CONTRAT", "TYPE_SUPPORT", "MONTANT_BRUT", "DATE_EFFET_FLUX", "NOM_PRODUIT")


@query("rejected_rows", """
WITH l AS (SELECT CAST(l_extendedprice AS DECIMAL(18,2)) AS v, l_partkey % 17 = 0 AS blank, CASE WHEN l_suppkey % 11 = 0 OR l_suppkey % 13 = 0 THEN ['field_count'] ELSE list_filter([
    CASE WHEN l_orderkey % 10 = 0 THEN 'missing:NUMERO_CONTRAT' END, CASE WHEN l_partkey % 7 = 0 AND l_partkey % 17 <> 0 THEN 'unreadable:MONTANT_BRUT' END,
    CASE WHEN l_partkey % 9 = 0 THEN 'unreadable:DATE_EFFET_FLUX' END, CASE WHEN l_partkey % 5 = 0 AND l_returnflag = 'R' THEN 'outside:TYPE_SUPPORT' END], lambda x: x IS NOT NULL) END AS reasons
  FROM lineitem)
SELECT reason, COUNT(*) AS rows, NULL::DOUBLE AS amount FROM (SELECT unnest(reasons) AS reason FROM l) GROUP BY 1
UNION ALL SELECT 'good', COUNT(*), CAST(SUM(CASE WHEN NOT blank THEN v END) AS DOUBLE) FROM l WHERE len(reasons) = 0
UNION ALL SELECT 'rejected', COUNT(*), NULL FROM l WHERE len(reasons) > 0
""")
def rejected_rows(spark, sf_dir):
    """Lines with a wrong number of fields, unreadable amounts and dates, missing contracts and unknown supports, from one scan."""
    def when(condition, value, text):
        return F.when(F.expr(condition), F.lit(value)).otherwise(text)

    def write(folder):
        fields = [
            when("l_orderkey % 10 = 0", "", F.concat(F.lit("C"), "l_orderkey")), F.lit("En cours"),
            when("l_partkey % 5 = 0 AND l_returnflag = 'R'", "ACTIONS", F.lit("UC")),
            when("l_partkey % 17 = 0", "", when("l_partkey % 7 = 0", "12,3x", _written(F.col("l_extendedprice").cast(MONEY)))),
            when("l_partkey % 9 = 0", "31/02/1998", F.date_format("l_shipdate", "dd/MM/yyyy")),
        ]
        last = F.when(F.expr("l_suppkey % 11 = 0"), F.lit("P;one too many")).when(F.expr("l_suppkey % 13 = 0"), F.lit(None)).otherwise(F.lit("P"))
        table(spark, sf_dir, "lineitem").select(F.concat_ws(";", *fields, last).alias("value")).write.mode("overwrite").text(folder)

    lines = read_csv_lines(spark, intermediate(spark, sf_dir, "lines", write), declared({c: "string" for c in _LINE_COLUMNS}), header=False)
    good, rejected = split_lines(lines, csv_system.row_rules(_LINE_COLUMNS), working_folder(spark, "split-lines"))
    amount = F.sum(parse_number("MONTANT_BRUT")).alias("amount")
    counted = reject_counts(rejected).unionByName(good.agg(F.lit("good").alias("reason"), F.count("*").alias("rows"), amount), allowMissingColumns=True)
    return shown(counted.unionByName(rejected.agg(F.lit("rejected").alias("reason"), F.count("*").alias("rows")), allowMissingColumns=True))


@query("csv_report", f"""
WITH {_FILES}, {sq.NETWORK_ROWS},
r AS (SELECT year(d2) AS y, CASE WHEN nature = 'Encours' AND year(d2) < 2000 THEN 12 WHEN nature <> 'Encours' THEN month(COALESCE(moved, d2)) ELSE 9 END AS m,
    CASE WHEN nature IN ('Arbitrage sortant', 'Rachat partiel') THEN -gross ELSE gross END AS g, * FROM (SELECT *, effect AS d2 FROM n))
SELECT CAST(y AS BIGINT) AS "Annee_valeur", CAST(m AS BIGINT) AS "Mois_valeur", support AS "TYPE_SUPPORT", nature AS nature, network AS "LB_RESEAU", "REGION" AS "REGION",
  CAST(international AS BIGINT) AS "INTERNATIONAL", CAST(CAST(SUM(g) AS DECIMAL(28,2)) * CAST(0.001 AS DECIMAL(4,3)) AS DOUBLE) AS "MONTANT_BRUT",
  CAST(CAST(SUM(pm) AS DECIMAL(28,2)) * CAST(0.001 AS DECIMAL(4,3)) AS DOUBLE) AS "Encours", COUNT(*) AS rows
FROM r LEFT JOIN nw ON "CODE_PORTEFEUILLE" = portfolio GROUP BY ALL
""")
def csv_report(spark, sf_dir):
    """The monthly files cleaned and turned into the reporting table, summed by its dimensions."""
    rows = csv_system.reporting(csv_system.clean(chosen_rows(spark, sf_dir)), network(spark, sf_dir))
    return shown(rows.groupBy("Annee_valeur", "Mois_valeur", "TYPE_SUPPORT", "nature", "LB_RESEAU", "REGION", "INTERNATIONAL").agg(
        F.sum("MONTANT_BRUT").alias("MONTANT_BRUT"), F.sum("Encours").alias("Encours"), F.count(F.lit(1)).alias("rows")))


@query("partition_roundtrip", """
SELECT '199806' AS func_month, l_returnflag, l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, COUNT(*) AS rows
FROM lineitem WHERE strftime(l_shipdate, '%Y%m') = '199806' GROUP BY ALL
""")
def partition_roundtrip(spark, sf_dir):
    """A store of all months; one month is written again and read back: it is replaced, not doubled."""
    def write(folder):
        lines = table(spark, sf_dir, "lineitem").withColumn("func_month", F.date_format("l_shipdate", "yyyyMM"))
        write_partitions(lines, folder, ["func_month"])
        write_month(lines.filter("func_month = '199806'").drop("func_month"), folder, Period(1998, 6), within=["l_suppkey"])

    month = read_month(spark, intermediate(spark, sf_dir, "monthly-store", write), Period(1998, 6))
    return shown(month.groupBy("func_month", "l_returnflag", "l_suppkey").agg(
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("amount"), F.count(F.lit(1)).alias("rows")))


@query("daily_partition", """
SELECT event_type, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount, COUNT(*) AS events FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY ALL
""")
def daily_partition(spark, sf_dir):
    """One day of a table laid out by year, month and day: the read touches that day's folder only."""
    days = {"func_partitioning_year": "yyyy", "func_partitioning_month": "yyyy-MM", "func_partitioning_day": "yyyy-MM-dd"}

    def write(folder):
        events = table(spark, sf_dir, "events").withColumns({name: F.date_format("ts", pattern) for name, pattern in days.items()})
        write_partitions(events, folder, list(days))

    rows = read_day(spark, intermediate(spark, sf_dir, "daily", write), dt.date(2024, 1, 15))
    return shown(rows.groupBy("event_type").agg(F.sum(F.col("value").cast(MONEY)).alias("amount"), F.count(F.lit(1)).alias("events")))
