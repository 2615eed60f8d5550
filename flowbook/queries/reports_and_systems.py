"""The three systems, the dimensions, the monthly base, and the reports on it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import Period
from ..session import shuffles_released, working_folder
from ..sources.tables import read_month, write_partitions
from ..plans import base as base_plan
from ..plans import dimensions, reports
from ..plans.system1 import system1
from ..plans.system2 import system2
from ..plans.system3 import system3
from . import standins as st
from . import system_sql as sq
from .registry import query, shown, table

PERIOD = Period(1998, 6)
_FOLDERS: dict[tuple[str, str, str], str] = {}


def intermediate(spark, sf_dir, name, write):
    """The folder of an intermediate table, written on first use within an application.

    As in the monthly workflow, each system, the base and the reports are jobs of their own
    that meet in stored tables: a lost executor costs one job's work, and no plan spans them all.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _FOLDERS:
        folder = working_folder(spark, name)
        with shuffles_released(spark):
            write(folder)
        _FOLDERS[key] = folder
    return _FOLDERS[key]


def stored_rows(spark, sf_dir, name, build):
    folder = intermediate(spark, sf_dir, name, lambda f: build(spark, sf_dir).write.mode("overwrite").parquet(f))
    return spark.read.parquet(folder)


def segments(spark, sf_dir):
    return dimensions.segments(st.SEGMENTS.frame(spark, sf_dir))


def rows1(spark, sf_dir):
    return system1(st.frames(spark, sf_dir, st.SYSTEM1), PERIOD, segments(spark, sf_dir))


def positions2(spark, sf_dir):
    """The versioned positions of system 2, stored by version."""
    folder = intermediate(spark, sf_dir, "versions2", lambda f: write_partitions(st.system2_versions(spark, sf_dir), f, ["DATE_VERSION"], ["NUMERO_CONTRAT"]))
    return spark.read.parquet(folder)


def tables2(spark, sf_dir):
    ready = {name: frame for name, frame in st.frames(spark, sf_dir, st.SYSTEM2).items() if not name.startswith("positions_")}
    return {**ready, "positions": positions2(spark, sf_dir)}


def rows2(spark, sf_dir):
    return system2(tables2(spark, sf_dir), PERIOD, segments(spark, sf_dir))


def rows3(spark, sf_dir):
    return system3(st.frames(spark, sf_dir, st.SYSTEM3), PERIOD)


@query("system1_base", sq.system_sql(1, sq.S1))
def system1_base(spark, sf_dir):
    """Canonical rows of system 1."""
    return shown(rows1(spark, sf_dir))


@query("system2_base", sq.system_sql(2, sq.S2))
def system2_base(spark, sf_dir):
    """Canonical rows of system 2."""
    return shown(rows2(spark, sf_dir))


@query("extra_measures", f"""
WITH {sq.SEGMENTS}, {sq.S2.replace(sq.measures() + ',', sq.measures() + ', ae - sa AS net_switch, fr, pb,')}
SELECT "TYPE_SUPPORT" AS "TYPE_SUPPORT", "SEGMENT" AS "SEGMENT", CAST(SUM(net_switch) AS DOUBLE) AS "Arbitrage_Net", CAST(SUM(fr) AS DOUBLE) AS "Frais_de_gestion",
  CAST(SUM(pb) AS DOUBLE) AS "Participation_aux_benefices", COUNT(*) AS rows FROM s2_rows GROUP BY ALL
""")
def extra_measures(spark, sf_dir):
    """System 2 with the measures that the canonical row leaves out: net of switches, fees and profit shares."""
    extra = ("Arbitrage_Net", "Frais_de_gestion", "Participation_aux_benefices")
    rows = system2(tables2(spark, sf_dir), PERIOD, segments(spark, sf_dir), extra=extra)
    return shown(rows.groupBy("TYPE_SUPPORT", "SEGMENT").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in extra], F.count(F.lit(1)).alias("rows")))


@query("titles", """
WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS name, CASE WHEN c_custkey % 7 <> 0 THEN 'P' || c_nationkey END AS first, c_mktsegment AS quality,
  CASE c_nationkey % 4 WHEN 0 THEN 'Madame' WHEN 1 THEN 'Monsieur' WHEN 2 THEN '' END AS polite, CASE WHEN c_custkey % 3 = 0 THEN 'SARL' END AS form FROM customer)
SELECT c_custkey, CASE polite WHEN 'Madame' THEN 'Mme' WHEN 'Monsieur' THEN 'M.' ELSE form END AS title, concat_ws(' ', name, first) AS name_3,
  CASE WHEN name IS NULL THEN quality ELSE concat_ws(' ', name, first) END AS name_2 FROM p
""")
def titles(spark, sf_dir):
    """Titles and display names of the persons of systems 2 and 3."""
    key = F.col("c_custkey")
    persons = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(key % 5 != 0, F.col("c_name")).alias("NOM"), F.when(key % 7 != 0, F.concat(F.lit("P"), "c_nationkey")).alias("PRENOM"),
        F.col("c_mktsegment").alias("QUALITE"), F.when(key % 3 == 0, "SARL").alias("LIBELLE_TYPE_SOCIETE"),
        F.when(F.col("c_nationkey") % 4 == 0, "Madame").when(F.col("c_nationkey") % 4 == 1, "Monsieur").when(F.col("c_nationkey") % 4 == 2, "").alias("LIBELLE_POLITESSE"))
    second = dimensions.holder_names_2(persons).withColumnRenamed("NOM_PRENOM_SOUSCRIPTEUR", "name_2")
    third = dimensions.holder_names_3(second.withColumnsRenamed({"NOM": "NOM_CLIENT", "PRENOM": "PRENOM_CLIENT"}))
    return third.select("c_custkey", F.col("CIVILITE").alias("title"), F.col("NOM_PRENOM_SOUSCRIPTEUR").alias("name_3"), "name_2")


@query("system3_base", sq.system_sql(3, sq.S3))
def system3_base(spark, sf_dir):
    """Canonical rows of system 3."""
    return shown(rows3(spark, sf_dir))


def network(spark, sf_dir):
    return dimensions.network(st.NETWORK.frame(spark, sf_dir), banking_partner="17")


def clients(spark, sf_dir):
    return dimensions.clients(st.CLIENTS.frame(spark, sf_dir), st.CLIENT_CONTRACTS.frame(spark, sf_dir))


@query("network_dimension", f"WITH {sq.NETWORK_ROWS} SELECT * FROM nw")
def network_dimension(spark, sf_dir):
    return network(spark, sf_dir)


@query("client_dimension", f"WITH {sq.CLIENT_ROWS} SELECT * FROM cl")
def client_dimension(spark, sf_dir):
    return clients(spark, sf_dir)


def build_base(spark, sf_dir):
    dims = {
        "network": network(spark, sf_dir),
        "clients": clients(spark, sf_dir),
        "contract_file": base_plan.contract_file(st.CONTRACT_FILE.frame(spark, sf_dir)),
        "product_tags": base_plan.product_tags(st.PRODUCT_TAGS.frame(spark, sf_dir)),
        "wealth_clients": base_plan.wealth_clients(st.WEALTH_CLIENTS.frame(spark, sf_dir)),
        "legal_persons": base_plan.legal_persons(st.LEGAL_PERSONS.frame(spark, sf_dir)),
        "partner_portfolios": base_plan.partner_portfolios(st.PARTNER_PORTFOLIOS.frame(spark, sf_dir)),
    }
    systems = [stored_rows(spark, sf_dir, name, build) for name, build in (("system3", rows3), ("system1", rows1), ("system2", rows2))]
    return base_plan.monthly_base(systems, dims, PERIOD, flagged_portfolio="0000000012")


def base(spark, sf_dir):
    """The stored month of the base."""
    folder = intermediate(spark, sf_dir, "base", lambda f: base_plan.store(build_base(spark, sf_dir), f, PERIOD))
    return read_month(spark, folder, PERIOD).drop("func_month")


@query("monthly_base", f"WITH {sq.BASE} SELECT * REPLACE ({sq.as_double((*sq.BASE_MEASURES, 'Affaire_Nouvelle'))}) FROM base")
def monthly_base(spark, sf_dir):
    """The consolidated base: 51 descriptions, counter, new business and 24 measures."""
    return shown(build_base(spark, sf_dir))


_SEGMENTED = """
m0 AS (SELECT * REPLACE (CASE WHEN NOM_PRODUIT = 'PER INDIVIDUEL A' THEN 'PER' ELSE COALESCE(SEGPAT, 'ND') END AS SEGPAT, COALESCE(RESEAU, 'ND') AS RESEAU,
    CASE WHEN TYPE_SUPPORT IN ('EURO', 'EUROCROISSANCE') THEN 'EURO' ELSE 'UC' END AS TYPE_SUPPORT),
    Collecte_Brute_TOTALE - Prestation_TOTALE + Arbitrage_Entrant - Arbitrage_Sortant AS "Collecte_Nette",
    CASE WHEN CNT = 1 AND year(DATE_EFFET) = 1998 THEN 1 ELSE 0 END AS top_an FROM base),
m1 AS (SELECT *, CASE WHEN SEGPAT IN ('NON SEGMENTE', 'ND') THEN CASE
      WHEN RESEAU IN ('A2P','AEP','AGA','HOUSE PARTENAIRE','DIVERS HOUSE','DOM-TOM','GUICHET BANCAIRE','ND') THEN 'GRAND PUBLIC'
      WHEN RESEAU IN ('PARTENAIRE BANCAIRE','PARTENAIRE DISTRIBUTION','GESTION PRIVEE DIRECTE') THEN 'GESTION PRIVEE'
      WHEN RESEAU IN ('CGPI','COURTIERS GENERALISTES') THEN 'AFFLUENT' ELSE SEGPAT END ELSE SEGPAT END AS "SEG" FROM m0),
kinds AS (SELECT NOM_PRODUIT AS np, CASE WHEN COUNT(DISTINCT TYPE_SUPPORT) > 1 THEN 'MULTISUPPORT' WHEN MAX(TYPE_SUPPORT) = 'EURO' THEN 'MONOSUPPORT_EURO' ELSE 'MONOSUPPORT_UC' END AS kind
  FROM m1 GROUP BY 1),
m2 AS (SELECT m1.*, kind AS "TYPE_SUPPORT_2", CASE SEG WHEN 'PER' THEN 1 WHEN 'GESTION PRIVEE' THEN 2 WHEN 'AFFLUENT' THEN 3 WHEN 'GRAND PUBLIC' THEN 4 ELSE 5 END AS prio
  FROM m1 JOIN kinds ON np IS NOT DISTINCT FROM NOM_PRODUIT)
"""
_MARKET_KEYS = ", ".join(reports.MARKET_KEYS)
_MARKET_MEASURES = sq.CANONICAL_MEASURES[:10] + ("PM_FIN", "Collecte_Nette")


@query("market_report", f"""
WITH {sq.BASE}, {_SEGMENTED},
p AS (SELECT {_MARKET_KEYS} FROM m2 WHERE NUMERO_ABONNE IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY NUMERO_ABONNE ORDER BY prio, {_MARKET_KEYS}) = 1),
u AS (SELECT {_MARKET_KEYS}, {', '.join(_MARKET_MEASURES)}, top_an, 0 AS nb FROM m2
  UNION ALL BY NAME SELECT {_MARKET_KEYS}, 1 AS nb, 0 AS top_an FROM p)
SELECT {_MARKET_KEYS}, {', '.join(f'CAST(SUM(COALESCE({m}, 0)) AS DOUBLE) AS "{m}"' for m in _MARKET_MEASURES)},
  CAST(SUM(top_an) AS BIGINT) AS "TOP_AN", CAST(SUM(nb) AS BIGINT) AS "NB_CLIENT" FROM u GROUP BY {_MARKET_KEYS}
""")
def market_report(spark, sf_dir):
    return shown(reports.market_report(base(spark, sf_dir), PERIOD))


@query("mono_multi", f"""
WITH {sq.BASE}, {_SEGMENTED} SELECT NOM_PRODUIT AS "NOM_PRODUIT", TYPE_SUPPORT_2 AS "TYPE_SUPPORT_2", COUNT(*) AS positions, CAST(SUM(PM_FIN) AS DOUBLE) AS "PM_FIN" FROM m2 GROUP BY ALL
""")
def mono_multi(spark, sf_dir):
    """Products by the set of support types sold under them."""
    rows = reports.market_rows(base(spark, sf_dir), PERIOD)
    return shown(rows.groupBy("NOM_PRODUIT", "TYPE_SUPPORT_2").agg(F.count(F.lit(1)).alias("positions"), F.sum("PM_FIN").alias("PM_FIN")))


@query("product_supports", f"""
WITH {sq.BASE}, k AS (SELECT NOM_PRODUIT, string_agg(DISTINCT TYPE_SUPPORT, ',' ORDER BY TYPE_SUPPORT) AS supports, COUNT(*) AS positions FROM base GROUP BY 1) SELECT * FROM k
""")
def product_supports(spark, sf_dir):
    """Support types of each product."""
    rows = reports.product_supports(base(spark, sf_dir))
    return shown(rows.groupBy("NOM_PRODUIT", F.nullif(F.array_join("valeurs_uniques", ","), F.lit("")).alias("supports")).agg(F.count(F.lit(1)).alias("positions")))


@query("client_once_by_priority", f"""
WITH {sq.BASE}, {_SEGMENTED},
p AS (SELECT SEG, NUMERO_ABONNE FROM m2 WHERE NUMERO_ABONNE IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY NUMERO_ABONNE ORDER BY prio, {_MARKET_KEYS}) = 1)
SELECT SEG AS "SEG", COUNT(*) AS clients FROM p GROUP BY SEG
""")
def client_once_by_priority(spark, sf_dir):
    """Clients by segment, each in its best one."""
    counted = reports.market_report(base(spark, sf_dir), PERIOD).groupBy("SEG").agg(F.sum("NB_CLIENT").cast("bigint").alias("clients"))
    return counted.filter("clients > 0")


_FINANCE = """
f AS (SELECT * REPLACE (CASE WHEN SYSTEME = 'SYS2' THEN 'SYS2F' ELSE SYSTEME END AS SYSTEME), CASE WHEN TYPE_PRSN = 'PHY' THEN 'personne physique' ELSE 'personne morale' END AS qualite,
    CASE WHEN RESEAU = 'GESTION PRIVEE DIRECTE' THEN 'Gestion Privée Directe' WHEN RESEAU = 'PARTENAIRE BANCAIRE' THEN 'Partenariats Bancaires'
      WHEN RESEAU = 'COURTIERS GENERALISTES' THEN 'Courtiers Généralistes' WHEN RESEAU = 'CGPI' THEN 'CGP' WHEN RESEAU = 'PARTENAIRE DISTRIBUTION' THEN 'Partenariats Distribution'
      WHEN CANAL = 'GESTION PRIVEE' AND RESEAU IN ('AGA','A2P','AEP') THEN 'Gestion Privée Réseau' WHEN CANAL = 'RESEAU PROPRIETAIRE' AND RESEAU IN ('AGA','A2P','AEP') THEN 'Réseau Propriétaire'
      WHEN RESEAU = 'HOUSE PARTENAIRE' THEN 'HOUSE PARTENAIRES' WHEN RESEAU = 'DIVERS HOUSE' THEN 'DIVERS HOUSE ASSURANCES' WHEN RESEAU = 'DOM-TOM' THEN 'DOM-TOM' ELSE 'non déterminé' END AS canal_d,
    CASE RESEAU WHEN 'AGA' THEN '1 : AGA' WHEN 'A2P' THEN '4 : A2P' WHEN 'AEP' THEN '3 : Salarié' ELSE ' ' END AS rang, CASE WHEN CNT = 1 AND year(DATE_EFFET) = 1998 THEN 1 ELSE 0 END AS top_an FROM base),
f2 AS (SELECT *, CASE WHEN CODE_PORTEFEUILLE = '0000000003' THEN 'SA' WHEN SYSTEME = 'SYS2F' AND canal_d IN ('Courtiers Généralistes', 'CGP') AND UJ = 'MU' THEN 'SA' ELSE UJ END AS uj2 FROM f)
"""
_FINANCE_SUMS = """CAST(SUM(Collecte_Brute_TOTALE) AS DOUBLE) AS "CA", CAST(SUM(Prestation_TOTALE) AS DOUBLE) AS "Prestations", CAST(SUM(PM_DEBUT) AS DOUBLE) AS "PM_début",
  CAST(SUM(PM_FIN) AS DOUBLE) AS "PM_fin", CAST(SUM(Arbitrage_Entrant) AS DOUBLE) AS "Arbitrages_entrée", CAST(SUM(Arbitrage_Sortant) AS DOUBLE) AS "Arbitrages_sortie", CAST(SUM(top_an) AS BIGINT) AS an"""


def finance(spark, sf_dir):
    return reports.finance_rows(base(spark, sf_dir), PERIOD, forced_portfolios=["0000000003"])


@query("finance_extract_1", f"""
WITH {sq.BASE}, {_FINANCE} SELECT SYSTEME AS "SYSTEME", uj2 AS "UJ", canal_d AS "Canal_distrib", rang AS reseau_rang, TYPE_SUPPORT AS support, qualite, {_FINANCE_SUMS}, CAST(SUM(CNT) AS BIGINT) AS cnt
FROM f2 WHERE canal_d IN ('Gestion Privée Directe','Partenariats Bancaires','Courtiers Généralistes','CGP','Partenariats Distribution','Gestion Privée Réseau') GROUP BY ALL
""")
def finance_extract_1(spark, sf_dir):
    return shown(reports.finance_by_channel(finance(spark, sf_dir)))


@query("finance_extract_2", f"""
WITH {sq.BASE}, {_FINANCE} SELECT TYPE_SUPPORT AS "TYPE_SUPPORT", SYSTEME AS "SYSTEME", CAST(SUM(PM_FIN) AS DOUBLE) AS "PM_FIN" FROM f2 WHERE CODE_PRODUIT IN ('00003', '00007', '00011') GROUP BY ALL
""")
def finance_extract_2(spark, sf_dir):
    """Reserves of a list of products (the list is the feature)."""
    return shown(reports.finance_by_product(finance(spark, sf_dir), ["00003", "00007", "00011"]))


@query("finance_extract_3", f"""
WITH {sq.BASE}, {_FINANCE} SELECT SYSTEME AS "SYSTEME", uj2 AS "UJ", canal_d AS "Canal_distrib", rang AS reseau_rang, SITUATION_CLOTURE AS "SITUATION_CLOTURE", {_FINANCE_SUMS},
  CAST(SUM(CASE WHEN SITUATION_CLOTURE IN ('Echu', 'En cours', 'En erreur') OR Collecte_Brute_TOTALE > 0 THEN CNT ELSE 0 END) AS BIGINT) AS cnt FROM f2 GROUP BY ALL
""")
def finance_extract_3(spark, sf_dir):
    return shown(reports.finance_by_status(finance(spark, sf_dir)))


@query("portfolio_cut", f"""
WITH {sq.BASE} SELECT TOP_ONE AS "TOP_ONE", CODE_PORTEFEUILLE AS "CODE_PORTEFEUILLE", TYPE_SUPPORT AS "TYPE_SUPPORT", APPORTEUR AS "APPORTEUR", SYSTEME AS "SYSTEME",
  CAST(SUM(Collecte_Brute_TOTALE) AS DOUBLE) AS "Collecte_Brute_TOTALE", CAST(SUM(Prestation_TOTALE) AS DOUBLE) AS "Prestation_TOTALE", CAST(SUM(Arbitrage_Entrant) AS DOUBLE) AS "Arbitrage_Entrant",
  CAST(SUM(Arbitrage_Sortant) AS DOUBLE) AS "Arbitrage_Sortant", CAST(SUM(PM_FIN) AS DOUBLE) AS "PM_FIN"
FROM base WHERE CODE_PORTEFEUILLE = '0000000008' GROUP BY ALL
""")
def portfolio_cut(spark, sf_dir):
    """One portfolio's flows and reserves (the portfolio is the feature)."""
    return shown(reports.portfolio_cut(base(spark, sf_dir), ["0000000008"]))
