"""Source tables of the reports, derived from the test tables.

The reports read contract, movement and valuation tables.  Each stand-in below is a
projection of the test tables to such a schema, written once as SQL expressions that
Spark and DuckDB both read; the logic under test is not part of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

LINES_WITH_ORDERS = "lineitem JOIN orders ON l_orderkey = o_orderkey"


@dataclass(frozen=True)
class StandIn:
    """A projection: source relation, columns as SQL, optional filter, grouping and DISTINCT."""

    source: str
    columns: dict[str, str]
    where: str | None = None
    group_by: tuple[str, ...] = ()
    distinct: bool = False

    def sql(self) -> str:
        listed = ", ".join(f'{expression} AS "{name}"' for name, expression in self.columns.items())
        text = f"SELECT {'DISTINCT ' if self.distinct else ''}{listed} FROM {self.source}"
        if self.where:
            text += f" WHERE {self.where}"
        return text + (f" GROUP BY {', '.join(self.group_by)}" if self.group_by else "")

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        if self.source == LINES_WITH_ORDERS:
            lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
            rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        else:
            rows = table(spark, sf_dir, self.source)
        if self.where:
            rows = rows.filter(self.where)
        named = {name: f"{expression} AS `{name}`" for name, expression in self.columns.items()}
        if self.group_by:
            keys = [F.expr(named[n]) for n, e in self.columns.items() if not _is_aggregate(e)]
            return rows.groupBy(*keys).agg(*[F.expr(named[n]) for n, e in self.columns.items() if _is_aggregate(e)])
        chosen = rows.selectExpr(*named.values())
        return chosen.distinct() if self.distinct else chosen


def _is_aggregate(expression: str) -> bool:
    return "SUM(" in expression or "MIN(" in expression


def text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def money(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(18,2))"


def numbered(values, expression: str, default: str = "NULL") -> str:
    """The n-th label (from 0) by an integer expression."""
    quote = "', chr(39), '"
    whens = " ".join(
        f"WHEN {i} THEN " + (f"concat('{v.replace(chr(39), quote)}')" if "'" in v else f"'{v}'") for i, v in enumerate(values))
    return f"CASE {expression} {whens} ELSE {default} END"


def fund(key: str) -> str:
    listed = numbered(["FR0011129717", "FR0013076031", "FR0013466562", "FR001400CZ43"], key, f"concat('FD', lpad({text(key)}, 8, '0'))")
    return listed


def contract(system: int, key: str) -> str:
    return f"concat('{system}', lpad({text(key)}, 9, '0'))"


def date(literal: str) -> str:
    return f"CAST('{literal}' AS DATE)"


SHIPPED = "CAST(l_shipdate AS DATE)"
TAX_STEP = "CAST(round(l_tax * 100) AS INTEGER)"
NO_DATE = "CAST(NULL AS DATE)"

# --- system 1: a contract per customer, a movement per order ---------------------------------

_S1_KEY = {
    "ID_CONTRAT": contract(1, "o_custkey"),
    "CD_FUND": fund("l_suppkey"),
    "CD_SUPPORT": text("l_suppkey"),
    "CD_PACK": "CASE l_returnflag WHEN 'A' THEN 'libre' WHEN 'N' THEN 'ucgcp' ELSE 'uc' END",
    "CD_OG": "CASE WHEN l_linestatus = 'F' THEN concat('og', l_returnflag) END",
}
_S1_FLOWS = (
    "Prime comptant", "Versement libre", "Versement libre programmé", "Arbitrage achat", "Arbitrage vente", "Rachat partiel", "Paiement dossier sinistre",
)
_S1_CONTRACT = {
    "ID_CONTRAT": contract(1, "c_custkey"),
    "CD_PROD": text("c_nationkey"),
    "LB_CADRE_FISCAL": "CASE c_mktsegment WHEN 'BUILDING' THEN 'per' WHEN 'HOUSEHOLD' THEN 'madelin' ELSE 'vie' END",
    "LB_STATUS": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'En cours' END",
    "DT_SOUSCRIPTION": f"CASE WHEN c_nationkey < 5 THEN {date('1998-03-01')} ELSE {date('1995-03-01')} END",
    "DT_CLOTURE": NO_DATE,
    "CD_PTF_RDU": text("c_nationkey"),
    "CD_UJ": "CASE WHEN c_nationkey % 2 = 0 THEN 'SA' ELSE 'MU' END",
}
_S1_PERSON = {
    "ID_CONTRAT": contract(1, "c_custkey"),
    "LB_ROLE": "CASE WHEN c_nationkey = 24 THEN 'Bénéficiaire' ELSE 'Souscripteur' END",
    "REFERENCE_CLIENT": text("c_custkey"),
    "TYPE_PRSN": "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'MOR' ELSE 'PHY' END",
}
SYSTEM1 = {
    "movement_detail": StandIn(LINES_WITH_ORDERS, {
        **_S1_KEY,
        "ID_MVT": text("l_orderkey"),
        "DT_INVEST": SHIPPED,
        "MT_BRUT": money("l_extendedprice"),
        "LB_TYPE_FLUX": f"CASE {TAX_STEP} WHEN 5 THEN 'Transfert interne entrant' WHEN 6 THEN 'Transfert interne sortant' WHEN 7 THEN 'Frais de gestion' "
                        f"WHEN 8 THEN 'Frais sur investissement' ELSE {numbered(_S1_FLOWS, 'l_linenumber - 1')} END",
    }),
    "movement_header": StandIn("orders", {
        "ID_CONTRAT": contract(1, "o_custkey"),
        "ID_MVT": text("o_orderkey"),
        "LB_STATUT": "CASE WHEN o_orderstatus = 'P' THEN 'En cours' ELSE 'Soldé' END",
        "LB_TYPE_MVT": "CASE o_orderpriority WHEN '1-URGENT' THEN 'RAG' WHEN '2-HIGH' THEN 'Désinvestissement échu' ELSE 'Standard' END",
    }),
    # Some contracts are unknown, and many positions share a date: both must survive.
    "positions": StandIn(LINES_WITH_ORDERS, {
        **_S1_KEY,
        "ID_CONTRAT": f"CASE WHEN o_custkey % 53 <> 0 THEN {contract(1, 'o_custkey')} END",
        "PM": money("l_extendedprice"),
        "NMBR_UC": "CAST(l_quantity AS DECIMAL(18,6))",
        "VL_RACHAT": "CAST(l_discount AS DECIMAL(18,6))",
        "MT_NON_INVESTI": f"CAST({TAX_STEP} AS DECIMAL(18,2))",
        "DT_POSITION": f"CASE WHEN l_suppkey % 3 = 0 THEN CAST(date_trunc('year', l_shipdate) AS DATE) ELSE {SHIPPED} END",
    }),
    "option_products": StandIn("lineitem", {
        "CD_OG": "concat('og', l_returnflag)", "LB_OG_AIA": "concat('Profil ', l_returnflag)", "LB_SOC_GESTION": "'SG'",
    }, distinct=True),
    "option_packs": StandIn("lineitem", {"CD_OG": "concat('og', l_returnflag)", "LB_PACK": "'Pack A'"}, where="l_returnflag = 'A'", distinct=True),
    "supports": StandIn("supplier", {
        "CD_FUND": fund("s_suppkey"),
        "NOM": "s_name",
        "LB_TYPE": numbered(["EUR", "UC", "EUC"], "s_nationkey % 4", "'AUTRE'"),
        "CD_INTERNE": text("s_suppkey"),
        "DT_SITUATION": date("2000-01-01"),
    }),
    "persons": StandIn("customer", _S1_PERSON),
    "persons_archive": StandIn("customer", _S1_PERSON),
    "contracts": StandIn("customer", _S1_CONTRACT, where="c_acctbal >= 0"),
    "contracts_archive": StandIn("customer", _S1_CONTRACT),
    "products": StandIn("nation", {
        "CD_PROD": text("n_nationkey"),
        "LB_PROD": "CASE WHEN n_nationkey % 5 = 0 THEN 'PER INDIVIDUEL A' ELSE concat('Produit ', n_name) END",
    }),
    "distributors": StandIn("nation", {"CD_DISTRIBUTEUR": text("n_nationkey"), "LB_RESEAU": "concat('Canal ', n_regionkey)"}),
}
SEGMENTS = StandIn("supplier", {
    "CODE_UT": text("s_suppkey"), "CODE_UV": text("s_nationkey"), "SEGMENT": "concat('seg ', s_nationkey)",
})

# --- system 2: a contract per order, an act per line number ---------------------------------

_S2_CODES = ("VI", "CC", "RN", "VC", "PA", "QH", "AE", "TA", "EA", "SA", "RT", "RP", "AP", "EX", "AH", "SI", "TP", "AV", "FR")
_S2_ACT = {
    "NUMERO_CONTRAT": contract(2, "l_orderkey"),
    "NUMERO_ACTE": text("l_linenumber"),
    "SENS_ACTE": "CASE WHEN (l_orderkey + l_linenumber) % 5 = 0 THEN 'Annulation' ELSE 'Création' END",
    "CODE_ACTE_COURT": numbered(_S2_CODES, f"(l_orderkey + 3 * l_linenumber) % {len(_S2_CODES)}"),
}
_S2_SUPPORT = {
    "CODE_ISIN": fund("l_suppkey"),
    "CODE_UT": text("l_suppkey"),
    "CODE_UC": text("l_suppkey % 10"),
    "LIBELLE_TYPE_SUPPORT": "CASE l_returnflag WHEN 'A' THEN 'FOND EUROS' ELSE 'UC' END",
    "TOP_EUROCROISSANCE": "CASE WHEN l_suppkey % 7 = 0 THEN 'OUI' ELSE 'NON' END",
    "CODE_PROFIL": "CASE l_linestatus WHEN 'O' THEN '' ELSE '02' END",
    "SUPPORT_CONVENTION": "CASE WHEN l_suppkey % 2 = 0 THEN 'Oui' ELSE 'Non' END",
}
_S2_POSITION = {
    "NUMERO_CONTRAT": contract(2, "l_orderkey"),
    **_S2_SUPPORT,
    "PM_SUPPORT": money("l_extendedprice"),
    "DATE_VALEUR_UC": SHIPPED,
    "LIBELLE_SUPPORT": "concat('Support ', l_suppkey)",
}
SYSTEM2 = {
    "support_flows": StandIn("lineitem", {
        **_S2_ACT, **_S2_SUPPORT,
        "DATE_CREATION_ACTE": SHIPPED,
        "NB_PART_SUPPORT_MVT": "CAST(l_quantity AS DECIMAL(18,6))",
        "VL_SUPPORT": f"CAST({TAX_STEP} + 1 AS DECIMAL(18,6))",
    }),
    "act_flows": StandIn("lineitem", {
        **_S2_ACT,
        "LIBELLE_MOTIF_ACTE": "CASE l_orderkey % 3 WHEN 0 THEN 'RAG' WHEN 1 THEN 'X' END",
        "LIBELLE_ACTE_COMPLEMENT": "CASE WHEN l_linenumber % 4 = 0 THEN 'RAG' END",
        "MONTANT_CLIENT": f"CAST(SUM({money('l_extendedprice')}) AS DECIMAL(18,2))",
    }, group_by=("l_orderkey", "l_linenumber")),
    "positions_opening": StandIn("lineitem", _S2_POSITION, where=f"{SHIPPED} <= {date('1997-12-31')}"),
    "positions_closing": StandIn("lineitem", _S2_POSITION, where=f"{SHIPPED} <= {date('1998-06-30')}"),
    "contracts": StandIn("orders", {
        "NUMERO_CONTRAT": contract(2, "o_orderkey"),
        "DATE_SYSTEME": "CAST(o_orderdate AS DATE)",
        "IDENTIFIANT_PORTEFEUILLE": text("o_custkey % 25"),
        "FISCALITE": "CASE o_orderpriority WHEN '1-URGENT' THEN 'PER' ELSE 'VIE' END",
        "CANAL_PORTEFEUILLE": "CASE WHEN o_orderpriority <> '2-HIGH' THEN 'Courtiers Généralistes' END",
        "RESEAU": "'AGENTS GENERAUX'",
        "NOM_PRODUIT": "concat('P', o_orderstatus, ' - Produit ', o_orderstatus)",
        "CODE_UV": text("o_custkey % 25"),
        "DATE_DEBUT_EFFET_CONTRAT": "CAST(o_orderdate AS DATE)",
        "DATE_FIN_EFFET_CONTRAT": NO_DATE,
        "SOCIETE_ASSURANCE": "CASE o_orderstatus WHEN 'F' THEN 'X MUTUELLE' ELSE 'X' END",
        "LIBELLE_ETAT_CONTRAT": "CASE o_orderstatus WHEN 'F' THEN 'Echu' WHEN 'O' THEN 'En cours' ELSE 'Autre' END",
        "MOTIF_ENTREE": "CASE WHEN o_orderkey % 4 = 0 THEN 'A' END",
        "MOTIF_SORTIE": "CASE WHEN o_orderkey % 6 = 0 THEN 'S' END",
    }),
    "persons": StandIn("orders", {
        "NUMERO_CONTRAT": contract(2, "o_orderkey"),
        "DATE_SYSTEME": "CAST(o_orderdate AS DATE)",
        "ROLE_PERSONNE": "CASE o_orderpriority WHEN '5-LOW' THEN 'Bénéficiaire' ELSE 'Souscripteur' END",
        "IDENTIFIANT_PERSONNE": text("o_custkey"),
        "TYPE_PERSONNE": "CASE o_orderstatus WHEN 'F' THEN 'Personne Physique' WHEN 'O' THEN 'modalité à traduire' ELSE 'Inconnue' END",
    }),
    "profiles": StandIn("region", {
        "PROF_ID": "lpad(CAST(r_regionkey AS STRING), 2, '0')",
        "PROF_FULL_NAME": "concat('profil ', r_regionkey)",
        "PROF_SHORT_NAME": "'X'",
        "CVN_GES": text("r_regionkey"),
        "EFF_D_OFF": NO_DATE,
    }),
}

# The versions of system 2's positions, whole snapshots.
SYSTEM2_VERSIONS = ("1996-12-31", "1997-12-31", "1998-06-30")


def system2_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All snapshots of system 2's positions under one version column, each from one scan of the lines."""
    lines = table(spark, sf_dir, "lineitem").filter(f"{SHIPPED} <= {date(SYSTEM2_VERSIONS[-1])}")
    dates = F.array(*[F.expr(date(v)) for v in SYSTEM2_VERSIONS])
    return lines.selectExpr(*[f"{expression} AS `{name}`" for name, expression in _S2_POSITION.items()], f"{SHIPPED} AS __shipped").select(
        "*", F.explode(F.filter(dates, lambda v: F.col("__shipped") <= v)).alias("DATE_VERSION")).drop("__shipped")


# --- system 3: a contract per part, an operation per order -----------------------------------

_S3_ISIN = f"CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE {fund('l_suppkey')} END"
_S3_FAMILIES = ("VERSEMENT", "RACHAT PARTIEL", "RACHAT TOTAL", "REORIENTATION D'EPARGNE")
_S3_DETAILS = (
    "Versement initial", "Rachat partiel", "Sortie décès", "Ajustement annuel gratuit", "Versement transfert", "Conversion en rente", "Transfert",
    "Annulation : Ajustement annuel gratuit", "Versement libre", "Divers", "Rachat total", "Divers",
)
_S3_FAMILY = numbered(_S3_FAMILIES, "l_orderkey % 4")
_S3_SUPPORT = {
    "CODE_ISIN": _S3_ISIN,
    "CODE_SUPPORT": text("l_suppkey"),
    "CODE_UT": text("l_suppkey % 20"),
    "LIBELLE_SUPPORT": "concat('Support ', l_suppkey)",
}
SYSTEM3 = {
    "valuations": StandIn("lineitem", {
        "NUMERO_CONTRAT": contract(3, "l_partkey"),
        **_S3_SUPPORT,
        "CODE_TYPE_CONTRAT": "'T'",
        "MONTANT": money("l_extendedprice"),
        "DATE_VALORISATION": SHIPPED,
        "LIBELLE_TYPE_MONTANT": "CASE l_linestatus WHEN 'O' THEN concat('Montant de l', chr(39), 'épargne gérée') ELSE 'Autre' END",
    }),
    "contracts": StandIn("part", {
        "NUMERO_CONTRAT": contract(3, "p_partkey"),
        "STATUT": "CASE WHEN p_size <= 45 THEN 'En cours' ELSE 'Clos' END",
        "CODE_CONVENTION_GESTION": "p_type",
        "LIBELLE_CONVENTION_GESTION": "concat('Convention ', p_type)",
        "DATE_DEBUT_EFFET_CONTRAT": date("1996-05-01"),
        "DATE_ANNULATION": NO_DATE,
        "LIBELLE_PRODUIT": "p_brand",
        "LIBELLE_ENTITE_JURIDIQUE": "CASE p_type WHEN 'PROMO' THEN 'HOUSE France Vie' WHEN 'SMALL' THEN 'HOUSE Assurances Vie Mutuelle' ELSE 'x' END",
        "CODE_PORTEFEUILLE": text("p_size % 25"),
        "CANAL_PORTEFEUILLE": "CASE WHEN p_size % 2 = 1 THEN 'CGPI' END",
        "LIBELLE_TYPE_CONTRAT": "CASE p_type WHEN 'LARGE' THEN 'FAR' ELSE 'Z' END",
    }),
    "catalogue_products": StandIn("supplier", {
        "CODE_SUPPORT": text("s_suppkey"),
        "CODE_TYPE_CONTRAT": "'T'",
        "CODE_UT": text("s_suppkey % 20"),
        "CODE_ISIN": _S3_ISIN.replace("l_suppkey", "s_suppkey"),
        "CODE_UV": text("s_nationkey"),
    }),
    "catalogue_supports": StandIn("supplier", {
        "CODE_SUPPORT": text("s_suppkey"), "LIBELLE_NATURE_SUPPORT": numbered(["Capitaux", "Part"], "s_suppkey % 3", "'Autre'"),
    }),
    "operation_detail": StandIn("lineitem", {
        "NUMERO_CONTRAT": contract(3, "l_partkey"),
        "NUMERO_ADHESION": text("l_partkey"),
        "NUMERO_OPERATION": text("l_orderkey"),
        **_S3_SUPPORT,
        "LIBELLE_NATURE_SUPPORT": numbered(["Capitaux", "Part"], "l_suppkey % 3", "'Autre'"),
        "LIBELLE_TYPE_TRANSACTION": _S3_FAMILY,
        "DETAIL_TRANSACTION": numbered(_S3_DETAILS, f"l_orderkey % {len(_S3_DETAILS)}"),
        "MONTANT": f"CASE l_returnflag WHEN 'R' THEN -{money('l_extendedprice')} ELSE {money('l_extendedprice')} END",
        "CODE_CONVENTION_GESTION": "'C'",
        "CATEGORIE_TYPE_MONTANT": numbered(
            ["MONTANT_BRUT", "MONTANT_BRUT", "MONTANT_BRUT", "MONTANT_NET", "FRAIS_ARBITRAGE", "FRAIS_FIXES", "FRAIS_GESTION"], "l_linenumber - 1"),
    }),
    "operations": StandIn("lineitem", {
        "NUMERO_CONTRAT": contract(3, "l_partkey"),
        "NUMERO_OPERATION": text("l_orderkey"),
        "NUMERO_ADHESION": text("l_partkey"),
        "DATE_JOURNALIER": "CAST(MIN(l_shipdate) AS DATE)",
        "CODE_UV": text("l_partkey % 25"),
        "LIBELLE_PAIEMENT": "CASE l_orderkey % 2 WHEN 0 THEN 'PRELEVEMENT' ELSE 'CHEQUE' END",
        "LIBELLE_TYPE_TRANSACTION": _S3_FAMILY,
    }, group_by=("l_partkey", "l_orderkey")),
    "persons": StandIn("part", {
        "NUMERO_CONTRAT": contract(3, "p_partkey"),
        "NUMERO_PERSONNE": "lpad(CAST(p_partkey AS STRING), 10, '0')",
        "LIBELLE_TYPE_PERSONNE": "CASE WHEN p_type = 'ECONOMY' THEN 'Personne morale' ELSE 'Personne physique' END",
    }),
    "conventions": StandIn("part", {
        "CODE_CONVENTION_GESTION": "p_type", "LIBELLE_PROFIL_FORMULE_GESTION": "concat('Profil ', p_type)",
    }, distinct=True),
}

# --- dimensions ------------------------------------------------------------------------------

NETWORK = StandIn("nation", {
    "ID": text("n_nationkey"),
    "CD_AGENCE": "concat('A', n_nationkey)",
    "INTITULE": "CASE WHEN n_nationkey % 4 <> 0 THEN concat('Commercial ', n_nationkey) END",
    "LIB_NAT_GESTION_1": "concat('Nature ', n_nationkey)",
    "CD_CIRCO_PP_1": "concat('C', n_nationkey)",
    "CD_INSPE_PP_1": numbered(["15299", "46361", "15500"], "n_nationkey % 5", "'99999'"),
    "LIB_LONG_INSP_PP_1": "concat('Delegation ', n_nationkey)",
    "CD_REGION_PP_1": text("n_regionkey"),
    "LIB_LONG_REG_PP_1": "concat('Region ', n_regionkey)",
    "ID_DISTR_1": "concat('G', n_nationkey)",
    "CANAL": "CASE WHEN n_nationkey < 23 THEN lpad(CAST(n_nationkey + 9 AS STRING), 3, '0') END",
    "CD_RESEAU": "'R'",
    "CD_REGROUP": "'G'",
    "LIB_CANAL": "CASE WHEN n_nationkey % 2 = 0 THEN 'A2P' ELSE 'AGA' END",
})
CLIENTS = StandIn("customer", {
    "NMCLI": text("c_custkey"),
    "NMPERS": "concat('AB', c_custkey % 700)",
    "CDQUALIT": "'M.'",
    "NOM": "CASE WHEN c_custkey % 10 <> 0 THEN c_name END",
    "PRENOM": "CAST(NULL AS STRING)",
    "DTNAISCL": date("1960-02-29"),
    "ADRESSE": "concat('Rue ', c_nationkey)",
    "CODE_POSTAL": "lpad(CAST(c_nationkey AS STRING), 5, '0')",
    "VILLE": "concat('Ville ', c_nationkey)",
    "PAYS": "'FR'",
    "EMAIL": "CAST(NULL AS STRING)",
    "CSP_BRUTE": "'10'",
    "SEGPAT": "CASE c_mktsegment WHEN 'BUILDING' THEN 'NON SEGMENTE' WHEN 'MACHINERY' THEN 'AFFLUENT' WHEN 'FURNITURE' THEN 'GESTION PRIVEE' END",
    "SOUS_SEGPAT": "CASE WHEN c_acctbal > 5000 THEN 'GP' END",
    "RAISON_SOCIALE": "concat('RS ', c_custkey)",
    "CIVILITE_PM": "CASE WHEN c_nationkey % 3 = 0 THEN 'SARL' WHEN c_nationkey % 3 = 1 THEN 'X' END",
    "TYPE": numbered(["DOUBLE PROFIL", "FICHE PM", "FICHE PP"], "c_nationkey % 4", "'Z'"),
})
CLIENT_CONTRACTS = StandIn("orders", {
    "NMCLI": text("o_custkey"),
    "NMCNT": contract(2, "o_orderkey"),
    "CANAL_DISTRIBUTION": "'010'",
    "ITFAMPRO": "'EPA'",
    "ITFAMRIS": "'R'",
    "CDCATPR": "'C'",
})
CONTRACT_FILE = StandIn("part", {
    "NUMERO_CONTRAT": contract(3, "p_partkey"),
    "RESEAU_SAS": "CASE WHEN p_size % 3 = 0 THEN 'AGA' ELSE 'SAS' END",
    "LIBELLE_COMMERCIAL_SAS": "concat('Sas ', p_brand)",
})
PRODUCT_TAGS = StandIn("supplier", {
    "CLE": "concat(CASE WHEN s_nationkey > 0 THEN lpad(CAST(s_nationkey AS STRING), 5, '0') ELSE '0' END, "
           "CASE WHEN s_suppkey > 0 THEN lpad(CAST(s_suppkey AS STRING), 5, '0') ELSE '0' END)",
    "TMGA": "CASE WHEN s_suppkey % 2 = 0 THEN 'O' ELSE 'N' END",
})
WEALTH_CLIENTS = StandIn("customer", {
    "NUMERO_CLIENT": text("c_custkey"),
    "LIBELLE_COMMERCIAL_GP": "concat('GP ', c_custkey)",
    "SEGMENTATION_GP": "c_mktsegment",
    "APPORTEUR_GP": "concat('AP ', c_nationkey)",
}, where="c_acctbal > 3000")
LEGAL_PERSONS = StandIn("orders", {
    "NMCNT": contract(2, "o_orderkey"), "NATURE_PMO": "concat('Nature ', o_orderstatus)",
}, where="o_orderpriority = '1-URGENT'")
PARTNER_PORTFOLIOS = StandIn("nation", {
    "CODE_PORTEFEUILLE": text("n_nationkey"),
    "LIBELLE_COMMERCIAL_PF": "concat('PF ', n_name)",
    "SEGMENTATION_PF": "concat('Seg ', n_regionkey)",
    "APPORTEUR_PF": "concat('App ', n_nationkey)",
})


def frames(spark: SparkSession, sf_dir: str, standins: dict[str, StandIn]) -> dict[str, DataFrame]:
    return {name: s.frame(spark, sf_dir) for name, s in standins.items()}


def ctes(standins: dict[str, StandIn], prefix: str) -> str:
    """The stand-ins as common table expressions named ``<prefix>_<name>``."""
    return ",\n".join(f"{prefix}_{name} AS ({s.sql()})" for name, s in standins.items())
