"""Cube queries: a fact from the order lines, dimensions with levels from the other tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.codes import pad_code
from ..operators.cube import CubeSpec, Dimension, run_levels
from ..operators.rules import FromColumn, RuleSet
from ..plans.cube_studies import budget_study, contract_levels, contract_lookup, surrender_study
from .registry import query, shown, table

MONEY = "decimal(18,2)"
NETWORK4 = ("A2P", "AG (AGGX)", "Autres Salariés", "DOM-TOM", "Partenariats Distribution", "CGP", "Courtiers généralistes (hors dommages)", "-")
NETWORK3 = ("Partenariats bancaires hors banque privée", "Gestion Privée Directe", "Partenariat banque privée", "-", "-")
REGIONS = ("Ile de France", "Nord-est", "Ouest", "Sud-est", "Sud-ouest", "Corse")
SURRENDERS = ("-", "Rachat total", "Rachat partiel", "Rachat programmé", "-", "-", "-", "-")
COUNTS = ("-", "-", "-", "-", "Nombre de rachats totaux", "Nombre de rachats partiels", "-", "-")
FAMILIES = ("-", "Prestations y compris acceptations", "Prestations y compris acceptations", "Emissions Totales", "Apport Net", "Apport Net",
            "Emissions PP (yc OD)", "Emissions Vie PUVL Total")
KINDS = ("-", "> Autres indicateurs (Montant)", "> Autres indicateurs (Montant)", "> Indicateurs Production (Montant)", "> Indicateurs Production (Montant)",
         "> Indicateurs Production (Montant)", "> Indicateurs Contrats (Montant)", "> Indicateurs Contrats (Montant)")
DETAILS = ("-", "-", "-", "Affaires nouvelles à PP non temporaire", "Affaires nouvelles à VLP", "-", "-", "Emissions Vie VLP")


def pick(values, expression, default=None):
    """The n-th label by an integer expression."""
    rules = [(f"{expression} = {i}", v) for i, v in enumerate(values)]
    return (RuleSet(rules) if default is None else RuleSet(rules, default)).column()


def sql_pick(values, expression):
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{listed}])[CAST({expression} AS BIGINT) + 1]"


def cube(spark, sf_dir) -> CubeSpec:
    """The cube over the test tables."""
    lines = table(spark, sf_dir, "lineitem")
    date = F.col("l_shipdate").cast("date")
    fact = lines.select(
        "l_suppkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", F.col("l_tax").cast(MONEY).alias("l_tax"),
        date.alias("DATE_COMPTABLE"),
        F.date_add(date, F.col("l_linenumber")).alias("DATE_EFFET"),
        F.trunc(date, "month").alias("func_month"),
        pad_code("l_orderkey", 16).alias("CTA_NUMERO"),
        F.col("l_linestatus").alias("tech_filename"),
        F.col("l_extendedprice").cast(MONEY).alias("value"),
    )
    parts, suppliers = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    # The small dimensions' members are fixed by the tables' definition, so the fact is not scanned for them.  They are
    # broadcast: Spark does not know their sizes, and would deal the fact by two or three values to join them.
    source = F.broadcast(spark.createDataFrame([("A",), ("N",), ("R",)], "l_returnflag string")).select(
        "l_returnflag",
        F.col("l_returnflag").alias("L2_OBJ_COD"),
        RuleSet([("l_returnflag = 'A'", "Saisie manuelle HOUSELUX")], FromColumn("concat('Source ', l_returnflag)")).column().alias("L2_OBJ_LBR"),
        RuleSet([("l_returnflag = 'N'", "Alimentations manuelles")], "Automatique").column().alias("L4_OBJ_LBR"),
        RuleSet([("l_returnflag IN ('A', 'N')", "VIE_SOC")], "AUTRE").column().alias("L6_OBJ_COD"),
    )
    network = suppliers.select(
        "s_suppkey",
        RuleSet([("s_nationkey < 22", "Réseau House France")], "Autre").column().alias("Res_Com_Niv_6"),
        pick(NETWORK4, "s_nationkey % 8").alias("Res_Com_Niv_4"),
        pick(NETWORK3, "s_nationkey % 5").alias("Res_Com_Niv_3"),
        F.col("s_name").alias("Res_Com_Niv_2_Detail_Cube"),
        RuleSet([("s_nationkey % 3 = 0", "HOUSE Partenaires")], "Autres").column().alias("Region_Com_Niv_2_Detail_Cube"),
    )
    market = parts.select("p_partkey", RuleSet([("p_size <= 45", "Total Marché HOUSE France")], "Hors marché").column().alias("L4_OBJ_LBR"))
    entity = F.broadcast(spark.createDataFrame([("F",), ("O",)], "l_linestatus string")).select(
        "l_linestatus", F.lit("Total UJ HOUSE France").alias("L6_UJ_PRISM_LBR"),
        RuleSet([("l_linestatus = 'O'", "HOUSE France VIE SA")], "Autres SA").column().alias("L3_UJ_PRISM_LBR"),
    )
    products = parts.select(
        "p_partkey",
        RuleSet([("p_type = 'PROMO'", "Total Prévoyance")], "Total Epargne Individuelle").column().alias("L7_PRODUIT_LBR"),
        F.col("p_brand").alias("L2_PRODUIT_LBR"),
        RuleSet([("p_size > 10", "Support Epargne")], "Autre support").column().alias("L5_SUPPORT_LBR"),
        RuleSet([("p_type = 'SMALL'", "Support UC"), ("p_type = 'MEDIUM'", "Support EURO")], "-").column().alias("L4_SUPPORT_LBR"),
        RuleSet([("p_type = 'ECONOMY'", "EUROCROISSANCE")], "-").column().alias("L3_SUPPORT_LBR"),
        F.col("p_type").alias("L5_PRISM_LBR"),
        RuleSet([("p_type = 'LARGE'", "Retraite aidée sous objectif")], "-").column().alias("L4_PILOTECO_AGA_LBR"),
    )
    indicators = F.broadcast(spark.range(1, 8)).select(F.col("id").cast(lines.schema["l_linenumber"].dataType).alias("l_linenumber")).select(
        "l_linenumber",
        F.concat(F.lit("I"), "l_linenumber").alias("L2_LBR_DESC"),
        pick(DETAILS, "l_linenumber").alias("L4_LBR_DESC"),
        pick(SURRENDERS, "l_linenumber").alias("L5_LBR_DESC"),
        pick(COUNTS, "l_linenumber").alias("L6_LBR_DESC"),
        pick(FAMILIES, "l_linenumber").alias("L7_LBR_DESC"),
        F.concat(F.lit("L8-"), F.col("l_linenumber") % 2).alias("L8_LBR_DESC"),
        pick(KINDS, "l_linenumber").alias("L9_LBR_DESC"),
    )
    pyramid = suppliers.select(
        "s_suppkey", pad_code("s_suppkey", 10).alias("port_cod"), F.col("s_name").alias("Portefeuille"),
        F.concat(F.lit("D"), "s_nationkey").alias("PP_1_Delegation"), F.concat(F.lit("C"), "s_nationkey").alias("PP_2_Circonsription"),
    )
    region = suppliers.select("s_suppkey", pick(REGIONS, "s_nationkey % 6").alias("OBJ_LBR"))
    return CubeSpec(fact=fact, value="value", month_col="func_month", dims={
        "source": Dimension(source, "l_returnflag", "l_returnflag"),
        "reseau": Dimension(network, "s_suppkey", "l_suppkey"),
        "marche": Dimension(market, "p_partkey", "l_partkey"),
        "uj": Dimension(entity, "l_linestatus", "l_linestatus"),
        "produits": Dimension(products, "p_partkey", "l_partkey"),
        "indicateurs": Dimension(indicators, "l_linenumber", "l_linenumber"),
        "pyramide": Dimension(pyramid, "s_suppkey", "l_suppkey"),
        "region": Dimension(region, "s_suppkey", "l_suppkey"),
    })


CUBE = f"""
cube AS (SELECT CAST(l_shipdate AS DATE) AS dc, CAST(l_shipdate AS DATE) + l_linenumber AS de, CAST(date_trunc('month', l_shipdate) AS DATE) AS fm,
  lpad(CAST(l_orderkey AS VARCHAR), 16, '0') AS cta, l_linestatus, l_returnflag, l_linenumber AS ln, CAST(l_tax AS DECIMAL(18,2)) AS tax,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS v, s_name, s_nationkey, s_suppkey, p_type, p_size, p_brand,
  CASE WHEN l_returnflag IN ('A','N') THEN 'VIE_SOC' ELSE 'AUTRE' END AS src6,
  {sql_pick(NETWORK4, "s_nationkey % 8")} AS n4, {sql_pick(NETWORK3, "s_nationkey % 5")} AS n3, s_nationkey < 22 AS in_network,
  {sql_pick(REGIONS, "s_nationkey % 6")} AS reg, {sql_pick(SURRENDERS, "l_linenumber")} AS l5, {sql_pick(COUNTS, "l_linenumber")} AS l6,
  {sql_pick(FAMILIES, "l_linenumber")} AS l7, {sql_pick(KINDS, "l_linenumber")} AS l9, {sql_pick(DETAILS, "l_linenumber")} AS l4
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
net AS (SELECT *, CASE WHEN n4 = 'A2P' THEN 'A2P' WHEN n4 = 'AG (AGGX)' THEN 'AGA' WHEN n4 = 'Autres Salariés' THEN 'AEP' WHEN n4 = 'DOM-TOM' THEN 'DOM-TOM'
    WHEN n3 = 'Partenariats bancaires hors banque privée' THEN 'Partenariats Bancaires' WHEN n4 = 'Partenariats Distribution' THEN 'Partenariats Distribution'
    WHEN n4 = 'CGP' THEN 'CGP' WHEN n4 = 'Courtiers généralistes (hors dommages)' THEN 'Courtiers' WHEN n3 = 'Gestion Privée Directe' THEN 'Gestion Privée Directe'
    WHEN s_nationkey % 3 = 0 THEN 'House Partenaires' WHEN n3 = 'Partenariat banque privée' THEN 'Banque privée' ELSE 'Autres' END AS network FROM cube)
"""


def month_list(first_year, last_year):
    return [dt.date(y, m, 1) for y in range(first_year, last_year + 1) for m in range(1, 13)]


@query("cube_basic", f"""
WITH {CUBE}
SELECT p_brand AS "produits_L2_PRODUIT_LBR", n4 AS "reseau_Res_Com_Niv_4", CAST(SUM(v) AS DOUBLE) AS "Value" FROM cube
WHERE p_type <> 'PROMO' AND year(fm) BETWEEN 1997 AND 1999 AND p_size <= 45 GROUP BY ALL
""")
def cube_basic(spark, sf_dir):
    """Two shown levels, one shown filter, one filter-only dimension and a month list."""
    return shown(
        cube(spark, sf_dir).months(month_list(1997, 1999))
        .show("produits", "L2_PRODUIT_LBR").where("produits", "L7_PRODUIT_LBR", ["Total Epargne Individuelle"])
        .show("reseau", "Res_Com_Niv_4").where("marche", "L4_OBJ_LBR", ["Total Marché HOUSE France"]).run())


@query("cube_ytd", f"""
WITH {CUBE}
SELECT cta AS "maille_fine_CTA_NUMERO", l7 AS "indicateurs_L7_LBR_DESC", CAST(SUM(v) AS DOUBLE) AS "Value" FROM cube
WHERE fm BETWEEN DATE '1998-01-01' AND DATE '1998-08-31' AND l9 <> '-' GROUP BY ALL
HAVING l7 IN ('Apport Net', 'Emissions Totales')
""")
def cube_ytd(spark, sf_dir):
    """Year to date at the fine grain, with a filter on a shown level."""
    spec = cube(spark, sf_dir).ytd(dt.date(1998, 8, 31)).show("maille_fine", "CTA_NUMERO").show("indicateurs", "L7_LBR_DESC")
    return shown(spec.run(having=F.col("indicateurs_L7_LBR_DESC").isin("Apport Net", "Emissions Totales")))


@query("cube_two_levels", f"""
WITH {CUBE}
SELECT l5 AS "indicateurs_L5_LBR_DESC", NULL AS "indicateurs_L6_LBR_DESC", l_returnflag AS "source_L2_OBJ_COD", CAST(SUM(v) AS DOUBLE) AS "Value" FROM cube WHERE l5 LIKE 'Rachat%' GROUP BY ALL
UNION ALL SELECT NULL, l6, l_returnflag, CAST(SUM(v) AS DOUBLE) FROM cube WHERE l6 LIKE 'Nombre%' GROUP BY ALL
""")
def cube_two_levels(spark, sf_dir):
    """One specification executed at two levels of a dimension, stacked."""
    common = cube(spark, sf_dir).show("source", "L2_OBJ_COD")
    return shown(run_levels({
        "amounts": common.show("indicateurs", "L5_LBR_DESC").where("indicateurs", "L5_LBR_DESC", ["Rachat total", "Rachat partiel", "Rachat programmé"]),
        "counts": common.show("indicateurs", "L6_LBR_DESC").where("indicateurs", "L6_LBR_DESC", ["Nombre de rachats totaux", "Nombre de rachats partiels"]),
    }).drop("level"))


@query("cube_members", "SELECT DISTINCT p_brand AS \"L2_PRODUIT_LBR\" FROM part WHERE upper(p_brand) LIKE '%#1%'")
def cube_members(spark, sf_dir):
    """Members of a dimension column that match a pattern in any case."""
    return cube(spark, sf_dir).members("produits", "L2_PRODUIT_LBR", like="%#1%")


@query("cube_indicator", f"""
WITH {CUBE}
SELECT CASE WHEN tax < 0.03 THEN 'low' WHEN tax < 0.06 THEN 'mid' ELSE 'high' END AS "indicateur_TAX", s_name AS "pyramide_Portefeuille", CAST(SUM(v) AS DOUBLE) AS "Value" FROM cube GROUP BY ALL
""")
def cube_indicator(spark, sf_dir):
    """A derived indicator as a shown column."""
    rules = RuleSet([("l_tax < 0.03", "low"), ("l_tax < 0.06", "mid")], "high")
    return shown(cube(spark, sf_dir).indicator("TAX", rules).show("pyramide", "Portefeuille").run())


@query("surrender_study", f"""
WITH {CUBE},
b AS (SELECT * FROM net WHERE src6 = 'VIE_SOC' AND in_network AND p_size <= 45 AND p_type <> 'PROMO' AND p_size > 10 AND year(fm) BETWEEN 1997 AND 1999),
u AS (SELECT dc, de, fm, l_returnflag, l5, NULL AS l6, 'L8-' || ln % 2 AS l8, network, SUM(v) AS m FROM b WHERE l5 <> '-' GROUP BY ALL
  UNION ALL SELECT dc, de, fm, l_returnflag, NULL, l6, 'L8-' || ln % 2, NULL, SUM(v) FROM b WHERE l6 <> '-' GROUP BY ALL)
SELECT dc AS "maille_fine_DATE_COMPTABLE", de AS "maille_fine_DATE_EFFET", fm AS "maille_fine_func_month", l_returnflag AS "source_L2_OBJ_COD",
  l5 AS "indicateurs_L5_LBR_DESC", l6 AS "indicateurs_L6_LBR_DESC", l8 AS "indicateurs_L8_LBR_DESC", network AS "RESEAU", CAST(m AS DOUBLE) AS "MONTANT",
  CAST(month(de) AS BIGINT) AS mois, CAST(year(de) AS BIGINT) AS annee, CAST(quarter(de) AS BIGINT) AS trimestre, CAST(week(de) AS BIGINT) AS semaine_annee,
  CAST(week(de) - week(CAST(date_trunc('quarter', de) AS DATE) + 1) + 1 AS BIGINT) AS semaine_trimestre_iso,
  CAST(date_diff('day', CAST(date_trunc('week', date_trunc('quarter', de)) AS DATE), CAST(date_trunc('week', de) AS DATE)) // 7 + 1 AS BIGINT) AS semaine_trimestre
FROM u
""")
def surrender_study_query(spark, sf_dir):
    return shown(surrender_study(cube(spark, sf_dir), month_list(1997, 1999)))


APE = RuleSet([("l_tax < 0.02", "APE EPARGNE - REGULAR"), ("l_tax < 0.04", "APE EPARGNE - SINGLE VC")], "SANS APE")


@query("cube_budget", f"""
WITH {CUBE},
b AS (SELECT *, CASE WHEN p_type = 'LARGE' THEN 'RETRAITE' WHEN p_type = 'PROMO' THEN 'PREVOYANCE' ELSE 'EPARGNE' END AS kind FROM net
      WHERE src6 = 'VIE_SOC' AND in_network AND year(fm) BETWEEN 1997 AND 1999),
n AS (SELECT *, CASE WHEN ln = 3 THEN 'Affaires nouvelles à PP non temporaire nettes de sans effet' WHEN ln = 4 THEN 'Affaires nouvelles à VLP net de sans effet'
        WHEN ln = 7 THEN 'Emissions Vie PUVL Total' WHEN ln = 6 THEN 'Emissions PP (yc OD)' WHEN ln IN (1, 2) THEN 'Prestations y compris acceptations' ELSE 'ND' END AS nature,
        CASE WHEN ln = 7 THEN 'Emissions Vie VLP' ELSE '0' END AS detail FROM b WHERE p_size <= 45
  UNION ALL SELECT *, CASE WHEN tax < 0.04 THEN 'Ape' ELSE 'ND' END, '0' FROM b),
r AS (SELECT *, CASE WHEN network IN ('Courtiers','AGA','AEP') THEN CASE reg WHEN 'Ile de France' THEN 'ILE DE France' WHEN 'Nord-est' THEN 'NORD EST' WHEN 'Ouest' THEN 'OUEST'
        WHEN 'Sud-est' THEN 'SUD EST' WHEN 'Sud-ouest' THEN 'SUD OUEST' ELSE 'Divers' END
      WHEN network IN ('CGP','Gestion Privée Directe','Partenariats Distribution','Partenariats Bancaires') THEN 'HOUSE WEALTH MANAGEMENT'
      WHEN network = 'A2P' THEN 'A2P' WHEN network IN ('Banque privée','DOM-TOM','House Partenaires') THEN 'AUTRES' ELSE ' ' END AS region FROM n
  WHERE nature <> 'ND' AND kind <> 'PREVOYANCE')
SELECT CASE WHEN l_linestatus = 'O' THEN 'SA yc FPRS' ELSE 'AUTRES SA' END AS "UJ", kind AS "TOP_EPAR_RET_PREV", CASE WHEN l_returnflag = 'A' THEN 'OUI' ELSE 'NON' END AS "VISION_LUX",
  CASE WHEN l_returnflag = 'N' THEN 'Alimentations manuelles' WHEN l_returnflag = 'A' THEN 'Saisie manuelle HOUSELUX' ELSE 'Source ' || l_returnflag END AS "SYSTEME",
  CAST(month(fm) AS BIGINT) AS "MOIS", CAST(year(fm) AS BIGINT) AS "ANNEE", network AS "RESEAU", region AS "REGION", nature AS "NATURE",
  CASE WHEN nature LIKE 'Emissions%' THEN 'Emissions Totales' ELSE nature END AS "NATURE2", detail AS "DETAILS_EMISSIONSVIE", CAST(SUM(v) AS DOUBLE) AS "MONTANT",
  CAST(SUM(CASE WHEN year(fm) = 1999 AND month(fm) <= 7 THEN v ELSE 0 END) AS DOUBLE) AS "MT_REEL_MOIS_N",
  CAST(SUM(CASE WHEN year(fm) = 1998 AND month(fm) <= 7 THEN v ELSE 0 END) AS DOUBLE) AS "MT_REEL_MOIS_N_1",
  CAST(SUM(CASE WHEN year(fm) = 1998 THEN v ELSE 0 END) AS DOUBLE) AS "MT_REEL_ANNEE_N_1",
  CAST(SUM(CASE WHEN year(fm) = 1997 THEN v ELSE 0 END) AS DOUBLE) AS "MT_REEL_ANNEE_N_2"
FROM r GROUP BY ALL
""")
def cube_budget(spark, sf_dir):
    return shown(budget_study(cube(spark, sf_dir), month_list(1997, 1999), 1999, 7, APE))


@query("cube_contract_lookup", f"""
WITH {CUBE}
SELECT cta AS "maille_fine_CTA_NUMERO", l4 AS "indicateurs_L4_LBR_DESC", l6 AS "indicateurs_L6_LBR_DESC", l7 AS "indicateurs_L7_LBR_DESC", CAST(SUM(v) AS DOUBLE) AS "Value"
FROM cube WHERE src6 = 'VIE_SOC' AND in_network AND p_size <= 45 AND p_type <> 'PROMO' AND year(fm) = 1998
  AND l7 IN ('Prestations y compris acceptations', 'Emissions Totales') AND l9 = '> Autres indicateurs (Montant)'
  AND cta IN (SELECT lpad(CAST(n AS VARCHAR), 16, '0') FROM range(0, 400) r(n)) GROUP BY ALL
""")
def cube_contract_lookup(spark, sf_dir):
    """The contract lookup: the feature is a filter on given contracts."""
    contracts = [f"{n:016d}" for n in range(400)]
    return shown(contract_lookup(
        cube(spark, sf_dir), dt.date(1998, 12, 31), contracts, "L7_LBR_DESC",
        ["Prestations y compris acceptations", "Emissions Totales"], ["> Autres indicateurs (Montant)"]))


_LOOKED_UP = f"""src6 = 'VIE_SOC' AND in_network AND p_size <= 45 AND p_type <> 'PROMO' AND year(fm) = 1998 AND cta IN (SELECT lpad(CAST(n AS VARCHAR), 16, '0') FROM range(0, 400) r(n))"""


@query("cube_contract_levels", f"""
WITH {CUBE}
SELECT 'L5_LBR_DESC' AS level, cta AS "maille_fine_CTA_NUMERO", l5 AS "indicateurs_L5_LBR_DESC", NULL AS "indicateurs_L6_LBR_DESC", NULL AS "indicateurs_L7_LBR_DESC", CAST(SUM(v) AS DOUBLE) AS "Value"
FROM cube WHERE {_LOOKED_UP} AND l5 IN ('Rachat total', 'Rachat partiel') GROUP BY ALL
UNION ALL SELECT 'L6_LBR_DESC', cta, NULL, l6, NULL, CAST(SUM(v) AS DOUBLE) FROM cube WHERE {_LOOKED_UP} AND l6 = 'Nombre de rachats totaux' GROUP BY ALL
UNION ALL SELECT 'L7_LBR_DESC', cta, NULL, NULL, l7, CAST(SUM(v) AS DOUBLE) FROM cube WHERE {_LOOKED_UP} AND l7 IN ('Apport Net', 'Emissions Totales') GROUP BY ALL
""")
def cube_contract_levels(spark, sf_dir):
    """Given contracts at three levels of the indicators at once."""
    levels = {"L5_LBR_DESC": ["Rachat total", "Rachat partiel"], "L6_LBR_DESC": ["Nombre de rachats totaux"], "L7_LBR_DESC": ["Apport Net", "Emissions Totales"]}
    return shown(contract_levels(cube(spark, sf_dir), dt.date(1998, 12, 31), [f"{n:016d}" for n in range(400)], levels))
