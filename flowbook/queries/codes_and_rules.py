"""Codes, projections, predicates and rule tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codes import (
    blank_to, coalesced_name, composite_key, filled, pad_code, parse_number, repaired_contract, split_item, truncated,
)
from ..operators.joins import stack
from ..operators.rules import FromColumn, RuleSet, none_of, one_of, relabel, rule_hits, with_each_literal
from ..plans import rulebook as rb
from .registry import query, shown, table


@query("pad_code", """
WITH p AS (SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'A' || p_size ELSE CAST(p_partkey AS VARCHAR) END AS code FROM part)
SELECT p_partkey, code,
       lpad(code, 3, '0') AS cut_code,
       CASE WHEN TRY_CAST(code AS DOUBLE) > 0 THEN lpad(code, 5, '0') ELSE code END AS numeric_code,
       CASE WHEN length(code) < 3 THEN lpad(code, 3, '0') ELSE code END AS short_code
FROM p
""")
def pad_code_query(spark, sf_dir):
    code = F.when(F.col("p_type") == "PROMO", F.concat(F.lit("A"), "p_size")).otherwise(F.col("p_partkey").cast("string"))
    parts = table(spark, sf_dir, "part").select("p_partkey", code.alias("code"))
    return parts.withColumns({
        "cut_code": pad_code("code", 3),
        "numeric_code": pad_code("code", 5, numeric_only=True),
        "short_code": pad_code("code", 3, only_short=True),
    })


@query("clean_number", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_quantity = 13 THEN NULL ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount,
       CASE WHEN l_quantity = 13 THEN NULL ELSE CAST(trunc(l_extendedprice) AS BIGINT) END AS whole_amount
FROM lineitem
""")
def clean_number(spark, sf_dir):
    """Amounts written as '12 345,67' (or as text) read back as numbers."""
    written = F.translate(F.format_number("l_extendedprice", 2), ",.", " ,")
    rows = table(spark, sf_dir, "lineitem").withColumn("text", F.when(F.col("l_quantity") == 13, "n/a").otherwise(written))
    amount = parse_number("text")
    return shown(rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", amount.alias("amount"), truncated(amount).alias("whole_amount")))


@query("null_fallback", """
SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'BUILDING'), c_name) AS label,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'ND' ELSE c_mktsegment END AS filled_label,
       COALESCE(NULLIF(trim(CASE WHEN c_nationkey < 12 THEN c_mktsegment ELSE '' END), ''), c_name) AS person_name,
       CASE WHEN c_nationkey < 12 THEN c_mktsegment ELSE '01' END AS profile
FROM customer
""")
def null_fallback(spark, sf_dir):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    sometimes = F.when(F.col("c_nationkey") < 12, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.coalesce(segment, "c_name").alias("label"),
        filled(segment, "ND").alias("filled_label"),
        coalesced_name([sometimes], "c_name").alias("person_name"),
        blank_to(filled(sometimes, ""), "01").alias("profile"),
    )


@query("numeric_fill", """
SELECT event_type, CAST(CAST(COALESCE(v, 0) AS DECIMAL(18,2)) AS DOUBLE) AS amount, label, COUNT(*) AS n
FROM (SELECT event_type, CASE WHEN user_id < 50 THEN NULL ELSE value END AS v,
             CASE WHEN user_id < 50 THEN NULL ELSE event_type END AS label FROM events)
GROUP BY ALL
""")
def numeric_fill(spark, sf_dir):
    """na.fill(0) fills numbers only: missing labels stay null."""
    known = F.col("user_id") >= 50
    rows = table(spark, sf_dir, "events").select(
        "event_type", F.when(known, F.col("value").cast("decimal(18,2)")).alias("amount"), F.when(known, F.col("event_type")).alias("label"))
    return shown(rows.na.fill(0).groupBy("event_type", "amount", "label").agg(F.count(F.lit(1)).alias("n")))


@query("string_fns", """
SELECT p_partkey,
       split_part(p_name || ' - ' || p_type, ' - ', 1) AS head,
       split_part(p_name || ' - ' || p_type, ' - ', 2) AS tail,
       CAST(NULL AS VARCHAR) AS missing_part,
       substr(p_name, 2, 4) AS middle,
       replace(p_name, ' ', '') AS compact,
       trim('  ' || p_name || ' ') AS trimmed,
       upper(p_name) AS upper_name,
       CAST(length(p_name) AS BIGINT) AS name_length,
       p_brand || ' ; ' || p_type AS joined,
       p_brand || CAST(p_size AS VARCHAR) AS composite,
       lpad(substr(lpad(CAST(p_partkey * 1000 + 92 AS VARCHAR), 16, '0'), 1, 14), 16, '0') AS repaired
FROM part
""")
def string_fns(spark, sf_dir):
    both = F.concat_ws(" - ", "p_name", "p_type")
    number = pad_code(F.col("p_partkey") * 1000 + 92, 16)
    return shown(table(spark, sf_dir, "part").select(
        "p_partkey",
        split_item(both, " - ", 1).alias("head"),
        split_item(both, " - ", 2).alias("tail"),
        split_item(both, " - ", 3).alias("missing_part"),
        F.substring("p_name", 2, 4).alias("middle"),
        F.regexp_replace("p_name", " ", "").alias("compact"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.upper("p_name").alias("upper_name"),
        F.length("p_name").alias("name_length"),
        F.concat_ws(" ; ", "p_brand", "p_type").alias("joined"),
        composite_key("p_brand", F.col("p_size").cast("string")).alias("composite"),
        repaired_contract(number, F.lit(True)).alias("repaired"),
    ))


LABELLED = """
c AS (SELECT c_custkey, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS amount,
  CASE c_nationkey % 12 WHEN 0 THEN 'RESEAU A2P EST' WHEN 1 THEN 'AEP MUTUELLE' WHEN 2 THEN 'AGENTS GENERAUX'
    WHEN 3 THEN 'GESTION PRIVEE' WHEN 4 THEN 'Partenariats Bancaires' WHEN 5 THEN 'PARTENAIRE ASSURANCE'
    WHEN 6 THEN 'CGPI' WHEN 7 THEN 'Courtiers Généralistes' WHEN 8 THEN 'ESPACE CONSEIL DOM'
    WHEN 9 THEN 'PLATEFORMES MUTUELLE' WHEN 10 THEN 'ND' END AS label,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'SYS1' WHEN c_mktsegment = 'FURNITURE' THEN 'SYS2' ELSE 'SYS3' END AS system,
  CASE WHEN c_acctbal > 5000 THEN 'GP' WHEN c_acctbal > 0 THEN 'XX' END AS sub_segment
  FROM customer),
r AS (SELECT *, CASE WHEN contains(label, 'A2P') THEN 'A2P' WHEN label = 'AEP MUTUELLE' THEN 'AEP' WHEN label = 'AGENTS GENERAUX' THEN 'AGA'
    WHEN label = 'GESTION PRIVEE' THEN 'GESTION PRIVEE DIRECTE' WHEN label = 'Partenariats Bancaires' THEN 'PARTENAIRE BANCAIRE'
    WHEN label = 'PARTENAIRE ASSURANCE' THEN 'PARTENAIRE DISTRIBUTION' WHEN label = 'CGPI' THEN 'CGPI'
    WHEN label = 'Courtiers Généralistes' THEN 'COURTIERS GENERALISTES' WHEN label = 'ESPACE CONSEIL DOM' THEN 'DOM-TOM'
    WHEN label = 'PLATEFORMES MUTUELLE' THEN 'MUTUELLE' ELSE label END AS network FROM c)
"""
NETWORK_LABELS = (
    "RESEAU A2P EST", "AEP MUTUELLE", "AGENTS GENERAUX", "GESTION PRIVEE", "Partenariats Bancaires", "PARTENAIRE ASSURANCE",
    "CGPI", "Courtiers Généralistes", "ESPACE CONSEIL DOM", "PLATEFORMES MUTUELLE", "ND",
)


def labelled_customers(spark, sf_dir):
    """Customers with a raw network label (null for some), a system and a sub-segment."""
    label = RuleSet([(f"c_nationkey % 12 = {i}", text) for i, text in enumerate(NETWORK_LABELS)])
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey",
        F.col("c_acctbal").cast("decimal(18,2)").alias("amount"),
        label.column().alias("LB_CANAL"),
        RuleSet([(one_of("c_mktsegment", ["BUILDING", "MACHINERY"]), "SYS1"), ("c_mktsegment = 'FURNITURE'", "SYS2")], "SYS3").column().alias("SYSTEME"),
        RuleSet([("c_acctbal > 5000", "GP"), ("c_acctbal > 0", "XX")]).column().alias("SOUS_SEGPAT"),
    )


@query("rule_first_match", f"""
WITH {LABELLED}
SELECT network, COUNT(*) AS customers, CAST(SUM(amount) AS DOUBLE) AS amount FROM r GROUP BY network
""")
def rule_first_match(spark, sf_dir):
    """Canonical network: contains and IN groups, first match wins, default is the source label."""
    rows = labelled_customers(spark, sf_dir).withColumnRenamed("LB_CANAL", "RESEAU")
    return shown(rows.withColumn("network", rb.canonical_network(rb.DEFAULT_NAMES).column()).groupBy("network").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("amount").alias("amount")))


@query("rule_cascade", f"""
WITH {LABELLED},
s AS (SELECT *, CASE WHEN network = 'ND' AND system = 'SYS3' THEN 'SAS' || c_nationkey ELSE network END AS net2,
        CASE WHEN system = 'SYS3' THEN 'S' ELSE NULL END AS commercial FROM r),
k AS (SELECT *, CASE WHEN net2 IN ('A2P','AEP','AGA') THEN 'RESEAU PROPRIETAIRE'
        WHEN net2 IN ('CGPI','COURTIERS GENERALISTES','PARTENAIRE BANCAIRE','PARTENAIRE DISTRIBUTION') THEN 'RESEAU TIERS'
        WHEN net2 = 'GESTION PRIVEE DIRECTE' THEN 'GESTION PRIVEE' ELSE 'AUTRES' END AS channel FROM s),
w AS (SELECT *, CASE WHEN channel = 'RESEAU PROPRIETAIRE' AND (sub_segment = 'GP' OR system = 'SYS1') THEN 'GESTION PRIVEE' ELSE channel END AS ch2 FROM k)
SELECT net2 AS "RESEAU", ch2 AS "CANAL", commercial AS "LIBELLE_COMMERCIAL",
       CAST(CASE WHEN system = 'SYS1' OR ch2 IN ('RESEAU TIERS', 'GESTION PRIVEE') THEN 1 ELSE 0 END AS BIGINT) AS "TOP_ONE",
       COUNT(*) AS customers, CAST(SUM(amount) AS DOUBLE) AS amount
FROM w GROUP BY ALL
""")
def rule_cascade(spark, sf_dir):
    """Network, overrides per system, channel and its upgrade: each stage reads the one before."""
    rows = labelled_customers(spark, sf_dir).withColumns({
        "LIBNAME_RESEAU": F.lit(None).cast("string"),
        "RESEAU_SAS": F.concat(F.lit("SAS"), "c_nationkey"),
        "LIBELLE_COMMERCIAL": F.lit(None).cast("string"),
        "LIBELLE_COMMERCIAL_SAS": F.lit("S"),
    })
    labelled = relabel(rows, [*rb.network_stages(rb.DEFAULT_NAMES), ("TOP_ONE", rb.wealth_flag(rb.DEFAULT_NAMES))])
    return shown(labelled.groupBy("RESEAU", "CANAL", "LIBELLE_COMMERCIAL", "TOP_ONE").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("amount").alias("amount")))


@query("not_in_null", """
WITH c AS (SELECT NULLIF(c_mktsegment, 'BUILDING') AS seg, CAST(c_acctbal AS DECIMAL(18,2)) AS amount FROM customer)
SELECT seg, CASE WHEN seg NOT IN ('MACHINERY', 'FURNITURE') THEN 'other' END AS outside,
       CASE WHEN seg IN ('MACHINERY', 'FURNITURE') THEN 'listed' WHEN seg IS NULL THEN 'missing' ELSE 'other' END AS written_out,
       COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount
FROM c GROUP BY ALL
""")
def not_in_null(spark, sf_dir):
    """NOT IN on null is neither true nor false: without a default the label is null."""
    listed = ["MACHINERY", "FURNITURE"]
    rows = table(spark, sf_dir, "customer").select(
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("seg"), F.col("c_acctbal").cast("decimal(18,2)").alias("amount"))
    labelled = rows.withColumns({
        "outside": RuleSet([(none_of("seg", listed), "other")]).column(),
        "written_out": RuleSet([(one_of("seg", listed), "listed"), ("seg IS NULL", "missing")], "other").column(),
    })
    return shown(labelled.groupBy("seg", "outside", "written_out").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")))


@query("region_override", """
WITH s AS (SELECT s_suppkey, n_name, s_acctbal,
    CASE WHEN s_suppkey % 2 = 0 THEN 'A2P SUD' ELSE 'AGA' END AS channel,
    CASE s_nationkey % 6 WHEN 0 THEN '15299' WHEN 1 THEN '46361' WHEN 2 THEN '15500' WHEN 3 THEN '46255' WHEN 4 THEN '15199' ELSE '15000' END AS delegation
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT CASE WHEN channel LIKE '%A2P%' THEN CASE delegation WHEN '15299' THEN 'ILE DE FRANCE' WHEN '46361' THEN 'OUEST'
         WHEN '15500' THEN 'NORD-EST' WHEN '46255' THEN 'SUD-EST' WHEN '15199' THEN 'SUD-OUEST' ELSE 'ND' END ELSE n_name END AS region,
       COUNT(*) AS suppliers, CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM s GROUP BY 1
""")
def region_override(spark, sf_dir):
    """Region by delegation code within one network, else the stored region."""
    codes = RuleSet([
        (f"s_nationkey % 6 = {i}", code) for i, code in enumerate(["15299", "46361", "15500", "46255", "15199"])
    ], "15000")
    rows = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), ["s_nationkey"])
    coded = rows.withColumns({
        "channel": F.when(F.col("s_suppkey") % 2 == 0, "A2P SUD").otherwise("AGA"), "delegation": codes.column()})
    return shown(coded.groupBy(rb.region_override("channel", "delegation", "n_name").column().alias("region")).agg(
        F.count(F.lit(1)).alias("suppliers"), F.sum(F.col("s_acctbal").cast("decimal(18,2)")).alias("amount")))


@query("rule_nested", """
WITH l AS (SELECT l_extendedprice, l_returnflag, l_linenumber,
    CASE WHEN l_linenumber <= 3 THEN 'VERSEMENT' WHEN l_linenumber = 4 THEN 'RACHAT PARTIEL' WHEN l_linenumber = 5 THEN 'RACHAT TOTAL'
         WHEN l_linenumber = 6 THEN 'REORIENTATION D''EPARGNE' ELSE 'AUTRE FAMILLE' END AS family,
    CASE CAST(round(l_tax * 100) AS INTEGER) % 5 WHEN 0 THEN CASE WHEN l_linenumber <= 3 THEN 'Versement initial' ELSE 'Rachat partiel' END
         WHEN 1 THEN CASE WHEN l_linenumber <= 3 THEN 'Annulation : Versement transfert' ELSE 'Sortie décès' END
         WHEN 2 THEN 'Conversion en rente' WHEN 3 THEN 'Transfert sortant' ELSE 'Annulation : divers' END AS detail,
    CASE WHEN l_discount >= 0.05 THEN 'PRELEVEMENT' ELSE 'CHEQUE' END AS pay,
    CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS montant FROM lineitem)
SELECT family, detail, CASE
    WHEN family = 'VERSEMENT' THEN CASE WHEN detail = 'Versement initial' THEN 'VI' WHEN detail = 'Annulation : Versement transfert' THEN 'TE'
       WHEN pay = 'PRELEVEMENT' THEN 'PA' ELSE 'VC' END
    WHEN family LIKE 'RACHAT%' THEN CASE WHEN detail = 'Rachat partiel' THEN 'RT' WHEN detail LIKE '%décès%' THEN 'SI'
       WHEN detail = 'Conversion en rente' THEN 'EC' WHEN detail LIKE '%Transfert%' THEN 'TS' ELSE 'AR' END
    WHEN family LIKE 'REORIENTATION%' THEN CASE WHEN (detail LIKE 'Annulation :%') = (montant < 0) THEN 'AE' ELSE 'AS' END
  END AS type_code, COUNT(*) AS n, CAST(SUM(CAST(montant AS DECIMAL(18,2))) AS DOUBLE) AS montant
FROM l GROUP BY ALL
""")
def rule_nested(spark, sf_dir):
    """Three families with their own sub-rules; a family without rules gets null."""
    rows = table(spark, sf_dir, "lineitem").withColumn("tax_step", F.round(F.col("l_tax") * 100).cast("int") % 5)
    coded = rows.select(
        RuleSet([
            ("l_linenumber <= 3", "VERSEMENT"), ("l_linenumber = 4", "RACHAT PARTIEL"), ("l_linenumber = 5", "RACHAT TOTAL"),
            ("l_linenumber = 6", "REORIENTATION D'EPARGNE"),
        ], "AUTRE FAMILLE").column().alias("LIBELLE_TYPE_TRANSACTION"),
        RuleSet([
            ("tax_step = 0", RuleSet([("l_linenumber <= 3", "Versement initial")], "Rachat partiel")),
            ("tax_step = 1", RuleSet([("l_linenumber <= 3", "Annulation : Versement transfert")], "Sortie décès")),
            ("tax_step = 2", "Conversion en rente"), ("tax_step = 3", "Transfert sortant"),
        ], "Annulation : divers").column().alias("DETAIL_TRANSACTION"),
        RuleSet([("l_discount >= 0.05D", "PRELEVEMENT")], "CHEQUE").column().alias("LIBELLE_PAIEMENT"),
        RuleSet([("l_returnflag = 'R'", FromColumn("-CAST(l_extendedprice AS DECIMAL(18,2))"))],
                FromColumn("CAST(l_extendedprice AS DECIMAL(18,2))")).column().alias("MONTANT"),
    )
    return shown(coded.withColumn("type_code", rb.SYSTEM3_TYPES.column()).groupBy(
        F.col("LIBELLE_TYPE_TRANSACTION").alias("family"), F.col("DETAIL_TRANSACTION").alias("detail"), "type_code",
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("MONTANT").alias("montant")))


# The rules once more, as plain SQL: label, condition, number of values named.
_ACTS = ("VI", "CC", "RN", "SE", "VC", "PA", "QT", "QH", "AE", "QR", "TA", "TE", "VP", "VT", "EA", "SA", "RT", "RP", "RG", "AP", "AT", "AX", "EX", "RE", "AH", "SI", "TP",
         "TT", "AV", "AQ", "FR", "PB")
_RAG = "(coalesce(motif = 'RAG', false) OR coalesce(complement = 'RAG', false))"
_SQL_RULES_2 = (
    ("Versement_Initial", "code IN ('VI', 'CC') AND te = 0", 2), ("-Versement_Initial", "code IN ('RN', 'SE')", 2), ("Versement_Complementaire", "code = 'VC'", 1),
    ("Prelevement_Automatique", "code IN ('PA', 'QT', 'QH')", 3), ("-Prelevement_Automatique", "code IN ('AE', 'QR')", 2),
    ("Transfert_Entrant", "(code IN ('VI', 'CC') AND te = 1) OR code IN ('TA', 'TE', 'VP', 'VT')", 6),
    ("Arbitrage_Entrant_RAG", f"code = 'EA' AND {_RAG}", 3), ("Arbitrage_Sortant_RAG", f"code = 'SA' AND {_RAG}", 3),
    ("Arbitrage_Entrant_Client", f"code = 'EA' AND NOT {_RAG}", 3), ("Arbitrage_Sortant_Client", f"code = 'SA' AND NOT {_RAG}", 3),
    ("Rachat", "code IN ('RT', 'RP', 'RG') AND ts = 0", 3), ("-Rachat", "code IN ('AP', 'AT', 'AX')", 3), ("Echu", "code IN ('EX', 'RE')", 2), ("-Echu", "code = 'AH'", 1),
    ("Sinistre", "code = 'SI'", 1), ("Transfert_Sortant", "(code IN ('RT', 'RP', 'RG') AND ts = 1) OR code IN ('TP', 'TT')", 5), ("-Transfert_Sortant", "code IN ('AV', 'AQ')", 2),
    ("Frais_de_gestion", "code = 'FR'", 1), ("Participation_aux_benefices", "code = 'PB'", 1),
)
_NETWORKS = (
    "A2P", "AEP", "AEP MUTUELLE", "SALARIES", "AGENTS GENERAUX", "AGA", "GESTION PRIVEE", "Gestion Privée Directe", "Partenariats Bancaires", "PARTENAIRE BANCAIRE",
    "Partenariats Distribution", "PARTENAIRE ASSURANCE", "Courtiers Spécialistes", "CGPI", "COURTIERS HOUSE FRANCE", "Courtiers Généralistes", "AUTRE DOM", "ESPACE CONSEIL DOM",
    "AGENT HOUSE PARTENAIRE", "SALARIES HOUSE PARTENA", "PLATEFORMES MUTUELLE",
)
_SQL_RULES_NETWORK = (
    ("A2P", "contains(network, 'A2P')", 1), ("AEP", "network IN ('AEP', 'AEP MUTUELLE', 'SALARIES')", 3), ("AGA", "network IN ('AGENTS GENERAUX', 'AGA')", 2),
    ("GESTION PRIVEE DIRECTE", "network IN ('GESTION PRIVEE', 'Gestion Privée Directe')", 2), ("PARTENAIRE BANCAIRE", "network IN ('Partenariats Bancaires', 'PARTENAIRE BANCAIRE')", 2),
    ("PARTENAIRE DISTRIBUTION", "network IN ('Partenariats Distribution', 'PARTENAIRE ASSURANCE')", 2), ("CGPI", "network IN ('Courtiers Spécialistes', 'CGPI')", 2),
    ("COURTIERS GENERALISTES", "network IN ('COURTIERS HOUSE FRANCE', 'Courtiers Généralistes')", 2), ("DOM-TOM", "network IN ('AUTRE DOM', 'ESPACE CONSEIL DOM')", 2),
    ("HOUSE PARTENAIRE", "network IN ('AGENT HOUSE PARTENAIRE', 'SALARIES HOUSE PARTENA')", 2), ("MUTUELLE", "network = 'PLATEFORMES MUTUELLE'", 1),
)
_FLOWS = ("Prime comptant", "Transfert externe entrant", "Versement libre", "Versement libre programmé", "Transfert interne entrant", "Arbitrage achat", "Arbitrage vente", "Rachat partiel",
          "Rachat total", "rachat programmé", "Transfert externe sortant", "Paiement dossier sinistre", "Transfert interne sortant", "Frais de mandat", "Frais de gestion conseillée",
          "Frais sur investissement", "Frais de gestion", "Frais Rachat")
_SQL_RULES_1 = (
    ("Versement_Initial", "flow IN ('Prime comptant', 'Transfert externe entrant')", 2), ("Versement_Complementaire", "flow = 'Versement libre'", 1),
    ("Prelevement_Automatique", "flow = 'Versement libre programmé'", 1), ("Transfert_Entrant", "flow = 'Transfert interne entrant'", 1), ("Arbitrage_Entrant", "flow = 'Arbitrage achat'", 1),
    ("Arbitrage_Entrant_RAG", "flow = 'Arbitrage achat' AND act IN ('RAGALD', 'RAG')", 3), ("Arbitrage_Sortant", "flow = 'Arbitrage vente'", 1),
    ("Arbitrage_Sortant_RAG", "flow = 'Arbitrage vente' AND act IN ('RAGALD', 'RAG')", 3),
    ("Rachat", "flow IN ('Rachat partiel', 'Rachat total', 'rachat programmé', 'Transfert externe sortant')", 4),
    ("Sinistre", "flow = 'Paiement dossier sinistre' AND act <> 'Désinvestissement échu'", 1), ("Echu", "flow = 'Paiement dossier sinistre' AND act = 'Désinvestissement échu'", 2),
    ("Transfert_Sortant", "flow = 'Transfert interne sortant'", 1), ("Frais_Mandat", "flow IN ('Frais de mandat', 'Frais de gestion conseillée')", 2),
    ("Frais_Acquisition", "flow = 'Frais sur investissement'", 1), ("Frais_Gestion", "flow = 'Frais de gestion'", 1), ("Frais_Rachat", "contains(flow, 'Frais Rachat')", 1),
)
_MOVEMENTS = ("RAGALD", "RAG", "Désinvestissement échu")


def _in_turn(values, number):
    return f"([{', '.join(repr(v) for v in values)}, NULL])[CAST({number} AS BIGINT) % {len(values) + 1} + 1]"


def _rule_rows(name, rules):
    """Disjoint rules: what a rule matches, it decides."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rules, '{n}' AS rule, '{label}' AS label, COUNT(*) FILTER ({condition}) AS matched, COUNT(*) FILTER ({condition}) AS won, "
        f"CAST({count} AS BIGINT) AS literals, CAST([] AS VARCHAR[]) AS unseen FROM acts" for n, (label, condition, count) in enumerate(rules, 1))


@query("rule_hits", f"""
WITH acts AS (SELECT {_in_turn(_ACTS, 'l_partkey')} AS code, l_linenumber % 2 AS te, l_suppkey % 2 AS ts, CASE l_orderkey % 4 WHEN 0 THEN 'RAG' WHEN 1 THEN 'x' END AS motif,
  CASE l_orderkey % 7 WHEN 0 THEN 'RAG' WHEN 1 THEN 'x' END AS complement, {_in_turn(_NETWORKS, 'l_partkey')} AS network, {_in_turn(_FLOWS, 'l_partkey')} AS flow,
  {_in_turn((*_MOVEMENTS, 'autre'), 'l_orderkey')} AS act FROM lineitem)
{_rule_rows('system 1 flows', _SQL_RULES_1)} UNION ALL {_rule_rows('system 2 flows', _SQL_RULES_2)} UNION ALL {_rule_rows('network', _SQL_RULES_NETWORK)}
""")
def rule_hits_query(spark, sf_dir):
    """Rows per rule of three rule tables, on stand-in rows that hold every value the rules name; ``unseen`` is empty for all."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    acts = F.element_at(F.array(*[F.lit(v) for v in (*_MOVEMENTS, "autre")], F.lit(None).cast("string")), (F.col("l_orderkey") % 5 + 1).cast("int"))

    def marked(column, number):
        return F.when(F.col(column) % number == 0, "RAG").when(F.col(column) % number == 1, "x")

    tables = {
        "system 1 flows": (rb.SYSTEM1_BUCKETS, {"LB_TYPE_MVT": acts}),
        "system 2 flows": (rb.system2_buckets(), {
            "TOP_TE": F.col("l_linenumber") % 2, "TOP_TS": F.col("l_suppkey") % 2, "LIBELLE_MOTIF_ACTE": marked("l_orderkey", 4), "LIBELLE_ACTE_COMPLEMENT": marked("l_orderkey", 7)}),
        "network": (rb.canonical_network(rb.DEFAULT_NAMES), {}),
    }
    return shown(stack([
        rule_hits(with_each_literal(lines, rules, F.col("l_partkey"), fixed), rules, name) for name, (rules, fixed) in tables.items()
    ], ["rules", "rule", "label", "matched", "won", "literals", "unseen"]))
