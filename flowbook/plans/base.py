"""The consolidated monthly base: three systems stacked, enriched and summed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import Period
from ..functions.codes import composite_key, pad_code
from ..operators.dedupe import first_per_key, null_safe_join, null_safe_order, one_per_key
from ..operators.flows import new_business, split_by_label
from ..operators.joins import Lookup, inline_lookup, lookup, lookup_chain, stack
from ..operators.positions import activity_total, drop_inactive, summed_repeats
from ..operators.rules import relabel
from ..sources.tables import write_month
from ..session import code_cut, computed_once
from . import rulebook as rb
from .canonical import ACTIVITY, COLUMNS, DESCRIPTORS_AFTER, DESCRIPTORS_BEFORE, FLOW_MEASURES, POSITION_MEASURES

# The grouping columns of the stored base.
KEYS = (
    *DESCRIPTORS_BEFORE, "TYPE_UC", "CODE_PORTEFEUILLE", "NUMERO_CLIENT", "NUMERO_ABONNE", "UJ", "TYPE_PRSN", "CIVILITE",
    "NOM_PRENOM_SOUSCRIPTEUR", "DATE_NAISSANCE", "CODE_CSP", "ADRESSE", "CODE_POSTAL", "VILLE", "PAYS", "EMAIL",
    "LIBELLE_COMMERCIAL", "LIBELLE_COMMERCIAL_CRM", "APPORTEUR", "CODE_DELEGATION", "DELEGATION", "CODE_REGION", "REGION",
    "CODE_GESTIONNAIRE", "CANAL_RDU_PRINCIPAL", "CANAL", "RESEAU", "SEGPAT", "SOUS_SEGPAT", "CIVILITE_PM", "NATURE_PMO",
    "TOP_ONE", "SEGMENT", "SEGMENTATION", "TOP_TMGA", "TOP_PORTEFEUILLE", "TOP_RETRAITE", "SYSTEME",
)
SPLIT_TYPES = ("UC", "EURO", "EUROCROISSANCE")
SUMMED = (*FLOW_MEASURES, *POSITION_MEASURES)
SPLIT_MEASURES = tuple(f"{m}_{t}" for m in ("Arbitrage_Entrant", "Arbitrage_Sortant") for t in SPLIT_TYPES)
MEASURES = (*FLOW_MEASURES, *SPLIT_MEASURES, *POSITION_MEASURES)
# The descriptive columns of a canonical row, and the order in which a contract's counted row is first.
DESCRIPTORS = (*DESCRIPTORS_BEFORE, *DESCRIPTORS_AFTER)
ROW = tuple(c for c in DESCRIPTORS if c != "NUMERO_CONTRAT")
COUNT_ORDER = (
    "CODE_ISIN", "CODE_UT", "SYSTEME", *[c for c in DESCRIPTORS if c not in ("NUMERO_CONTRAT", "CODE_ISIN", "CODE_UT", "SYSTEME")],
)

# Descriptions that lookups and labels read or replace; the others pass the joins in one struct with them, and so do the amounts.
LABELLED = ("CODE_PRODUIT", "CODE_ISIN", "CODE_UT", "TYPE_SUPPORT", "CODE_PORTEFEUILLE", "NUMERO_CLIENT", "TYPE_PRSN", "SYSTEME", "LB_CANAL")


def contract_file(table: DataFrame) -> DataFrame:
    padded = table.withColumn("NUMERO_CONTRAT", pad_code("NUMERO_CONTRAT", 16))
    return one_per_key(padded.select("NUMERO_CONTRAT", "RESEAU_SAS", "LIBELLE_COMMERCIAL_SAS"), ["NUMERO_CONTRAT"], [
        "RESEAU_SAS", "LIBELLE_COMMERCIAL_SAS"])


def wealth_clients(table: DataFrame) -> DataFrame:
    shown = table.select(pad_code("NUMERO_CLIENT", 10).alias("NUMERO_CLIENT_2"), "LIBELLE_COMMERCIAL_GP", "SEGMENTATION_GP", "APPORTEUR_GP")
    return one_per_key(shown, ["NUMERO_CLIENT_2"], ["LIBELLE_COMMERCIAL_GP", "SEGMENTATION_GP", "APPORTEUR_GP"])


def partner_portfolios(table: DataFrame) -> DataFrame:
    shown = table.select(pad_code("CODE_PORTEFEUILLE", 10).alias("CODE_PORTEFEUILLE"), "LIBELLE_COMMERCIAL_PF", "SEGMENTATION_PF", "APPORTEUR_PF")
    return one_per_key(shown, ["CODE_PORTEFEUILLE"], ["LIBELLE_COMMERCIAL_PF", "SEGMENTATION_PF", "APPORTEUR_PF"])


def legal_persons(table: DataFrame) -> DataFrame:
    shown = table.select(pad_code("NMCNT", 16).alias("NUMERO_CONTRAT"), "NATURE_PMO")
    return one_per_key(shown, ["NUMERO_CONTRAT"], ["NATURE_PMO"])


def product_tags(table: DataFrame) -> DataFrame:
    return one_per_key(table.select("CLE", "TMGA"), ["CLE"], ["TMGA"])


def monthly_base(
    systems: Sequence[DataFrame],
    dims: Mapping[str, DataFrame],
    period: Period,
    names: rb.Names = rb.DEFAULT_NAMES,
    flagged_portfolio: str | None = None,
    activity: str = "signed",
) -> DataFrame:
    """One row per contract x support x description with all measures.

    ``systems``: canonical frames.  ``dims``: network, clients, contract_file,
    product_tags, wealth_clients, legal_persons, partner_portfolios, each with one row
    per key (see the functions above and in ``dimensions``).

    Rows are summed over the canonical descriptions before anything is looked up: every
    later column depends on those, so the wide row never passes an aggregate.  The systems' rows are grouped by their
    own keys already, so few are equal in all descriptions, and only those are summed again.  Inactive contracts go
    before the lookups, and what they drop is not looked up.  A contract's signed total is the same before and after the
    sums, so its test and its counted row come from one aggregate of the summed rows; the absolute test looks at each row
    and goes before the sums.  Data of a client, of the contract file and of legal persons are attached to the
    contracts, so that the facts are dealt by contract, once, and by client never.
    """
    rows = stack(systems, COLUMNS)
    if activity != "signed":
        rows = drop_inactive(rows, ["NUMERO_CONTRAT"], ACTIVITY, activity)
    single = summed_repeats(rows, DESCRIPTORS, SUMMED)
    channels = inline_lookup(
        single.sparkSession, rb.channel_rows(names), ["CANAL_RDU_PRINCIPAL", "LIBNAME_RESEAU", "LIBNAME_CANAL"])
    network = dims["network"].select(
        "CODE_PORTEFEUILLE", "LIBELLE_COMMERCIAL", "CODE_DELEGATION", "DELEGATION", "CODE_REGION", "REGION", "CODE_GESTIONNAIRE",
        "CANAL_RDU_PRINCIPAL")
    clients = lookup(
        dims["clients"].drop("CANAL_DISTRIBUTION", "ITFAMPRO", "ITFAMRIS", "CDCATPR"), dims["wealth_clients"], ["NUMERO_CLIENT_2"], unique=True)
    # What is known of a contract is found once per contract, not once per row, and stored.
    active = activity_total(ACTIVITY, activity) if activity == "signed" else None
    first = first_per_key(single, ["NUMERO_CONTRAT"], COUNT_ORDER, active).withColumn("__first", F.struct(*[f"__first.{c}" for c in ROW]))
    contracts = computed_once(lookup_chain(first, [
        Lookup(clients, ["NUMERO_CONTRAT"], unique=True, null_safe=True),
        Lookup(dims["contract_file"], ["NUMERO_CONTRAT"], unique=True, null_safe=True),
        Lookup(dims["legal_persons"], ["NUMERO_CONTRAT"], unique=True, null_safe=True),
    ]), "base-contracts")
    facts = single.select("NUMERO_CONTRAT", F.struct(*ROW).alias("__row"), F.struct(*SUMMED).alias("__measures"))
    stacked = null_safe_join(facts, contracts, ["NUMERO_CONTRAT"], "inner").withColumns({
        **{c: F.col(f"__row.{c}") for c in LABELLED}, "CNT": F.col("__row").eqNullSafe(F.col("__first")).cast("int"),
    }).drop("__first")
    keyed = stacked.withColumn("CLE", composite_key("CODE_PRODUIT", "CODE_UT")).withColumnRenamed("NUMERO_CLIENT", "NUMERO_CLIENT_1")
    described = lookup_chain(keyed, [
        Lookup(network, ["CODE_PORTEFEUILLE"], unique=True),
        Lookup(dims["partner_portfolios"], ["CODE_PORTEFEUILLE"], unique=True),
        Lookup(channels, ["CANAL_RDU_PRINCIPAL"], unique=True),
        Lookup(dims["product_tags"], ["CLE"], unique=True),
    ])
    labelled = relabel(code_cut(relabel(described, rb.network_stages(names))), [
        ("TYPE_UC", rb.FUND_SUBTYPE),
        ("TOP_ONE", rb.wealth_flag(names)),
        ("TOP_TMGA", rb.TAGGED_PRODUCT),
        ("TOP_PORTEFEUILLE", rb.portfolio_flag(flagged_portfolio)),
        *rb.person_type_base(names),
        ("LIBELLE_COMMERCIAL_CRM", rb.crm_column("LIBELLE_COMMERCIAL_GP", "LIBELLE_COMMERCIAL_PF", rb.FromColumn("LIBELLE_COMMERCIAL"))),
        ("SEGMENTATION", rb.crm_column("SEGMENTATION_GP", "SEGMENTATION_PF", " ")),
        ("APPORTEUR", rb.crm_column("APPORTEUR_GP", "APPORTEUR_PF", " ")),
    ])
    carried = [F.col(f"__row.{c}").alias(c) for c in ROW if c not in LABELLED]
    measured = labelled.select(*[c for c in labelled.columns if c not in ("__row", "__measures")], *carried, "__measures.*").withColumns({
        "NUMERO_CLIENT": F.coalesce("NUMERO_CLIENT_2", "NUMERO_CLIENT_1"),
        **split_by_label("Arbitrage_Entrant", "TYPE_SUPPORT", SPLIT_TYPES),
        **split_by_label("Arbitrage_Sortant", "TYPE_SUPPORT", SPLIT_TYPES),
    })
    return measured.withColumn("Affaire_Nouvelle", new_business("DATE_EFFET", period.year, "Collecte_Brute_TOTALE")).select(
        *KEYS, "CNT", "Affaire_Nouvelle", *MEASURES)


def store(base: DataFrame, root: str, period: Period) -> None:
    """Store the month, replacing an earlier run of it.

    Files are in the order of contracts that the null-safe lookups by contract leave (a missing contract stands with an
    empty one), so the wide rows are not sorted again where no later lookup deals them anew.
    """
    write_month(base, root, period, within=null_safe_order(["NUMERO_CONTRAT"]))
