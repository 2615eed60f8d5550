"""System 3: transaction families, signed switches, valuations with ties."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import Period, cutoff_date, working_day_before, year_end_before
from ..functions.codes import filled, pad_code
from ..operators.dedupe import one_per_key
from ..operators.joins import Lookup, header_driven, lookup, lookup_chain
from ..operators.positions import drop_inactive, ledger_of_groups, live_only, newest_pair, summed
from ..session import computed_once
from . import rulebook as rb
from .canonical import ACTIVITY, canonical

KEYS = ("NUMERO_CONTRAT", "CODE_ISIN", "CODE_SUPPORT", "CODE_UT", "CODE_UV", "TYPE_SUPPORT")
FEES = ("Frais_Rachat", "Frais_Arbitrage", "Frais_Versement")
UNKNOWN = "ND"
VALUED_TYPE = "Montant de l'épargne gérée"


def flow_window(period: Period):
    """First and last booking date of the year, as columns.

    The window opens on the fourth working day before 31 December and closes at the cut-off.
    """
    end = F.lit(period.end)
    return working_day_before(year_end_before(end), 4), cutoff_date(end)


def valuations(table: DataFrame, contracts: DataFrame, period: Period) -> DataFrame:
    """All amounts of the newest valuation date of each contract x unit, at the opening and at the closing, live contracts only.

    Equal amounts of one support and date are one position.
    """
    rows = table.filter(F.col("LIBELLE_TYPE_MONTANT") == VALUED_TYPE).select(
        pad_code("NUMERO_CONTRAT", 16).alias("NUMERO_CONTRAT"),
        filled("CODE_ISIN", UNKNOWN).alias("CODE_ISIN"),
        "CODE_SUPPORT", "CODE_UT", "LIBELLE_SUPPORT", "CODE_TYPE_CONTRAT", "MONTANT", "DATE_VALORISATION",
    )
    newest = newest_pair(rows, ["NUMERO_CONTRAT", "CODE_UT"], "DATE_VALORISATION", period.previous_year_end, period.end)
    status = contracts.select(pad_code("NUMERO_CONTRAT", 16).alias("NUMERO_CONTRAT"), "STATUT")
    return live_only(newest.distinct(), status, ["NUMERO_CONTRAT"], F.col("STATUT") == "En cours")


def positions(tables: Mapping[str, DataFrame], period: Period) -> DataFrame:
    """Opening and closing position per key.

    The unit code of a support comes from the catalogue; the same lookup serves both
    dates, so a key does not split over a code known on one side only.
    """
    catalogue_keys = ["CODE_SUPPORT", "CODE_TYPE_CONTRAT", "CODE_UT", "CODE_ISIN"]
    catalogue = one_per_key(
        tables["catalogue_products"].select(
            "CODE_SUPPORT", "CODE_TYPE_CONTRAT", "CODE_UT", filled("CODE_ISIN", UNKNOWN).alias("CODE_ISIN"), "CODE_UV"),
        catalogue_keys, ["CODE_UV"],
    )
    types = one_per_key(
        tables["catalogue_supports"].select("CODE_SUPPORT", rb.SUPPORT_TYPE_3.column().alias("TYPE_SUPPORT")),
        ["CODE_SUPPORT"], ["TYPE_SUPPORT"],
    )
    described = lookup_chain(valuations(tables["valuations"], tables["contracts"], period), [
        Lookup(catalogue, catalogue_keys, unique=True), Lookup(types, ["CODE_SUPPORT"], unique=True),
    ])
    closing = F.col("is_closing")
    return summed(
        described.withColumns({
            "PM_DEBUT": F.when(F.col("is_opening"), F.col("MONTANT")), "PM_FIN": F.when(closing, F.col("MONTANT")),
            "DT_VL_FIN": F.when(closing, F.col("DATE_VALORISATION")), "LIBELLE_SUPPORT": F.when(closing, F.col("LIBELLE_SUPPORT")),
        }), KEYS, ("PM_DEBUT", "PM_FIN"), {"DT_VL_FIN": "max", "LIBELLE_SUPPORT": "max"},
    )


def movements(tables: Mapping[str, DataFrame], period: Period) -> DataFrame:
    """Classified movements: every header of the window with its detail rows.

    Both sides pad the contract number, and both filter before they project.
    """
    start, end = flow_window(period)
    operation = ["NUMERO_CONTRAT", "NUMERO_OPERATION", "NUMERO_ADHESION"]
    unique = ["NUMERO_ADHESION", "NUMERO_OPERATION", "CODE_ISIN", "LIBELLE_SUPPORT", "CATEGORIE_TYPE_MONTANT"]
    # The window's headers cut the detail and drive the join, so they are stored once.
    header = computed_once(
        tables["operations"]
        .filter(F.col("LIBELLE_TYPE_TRANSACTION").isin(*rb.SYSTEM3_FAMILIES) & F.col("DATE_JOURNALIER").between(start, end))
        .select(pad_code("NUMERO_CONTRAT", 16).alias("NUMERO_CONTRAT"), "NUMERO_OPERATION", "NUMERO_ADHESION", "CODE_UV", "LIBELLE_PAIEMENT")
        .distinct(), "headers3",
    )
    # Detail of other years goes before it is ranked; repeats share operation and adhesion number, so the cut takes whole groups.
    wanted = ["NUMERO_ADHESION", "NUMERO_OPERATION"]
    detail = one_per_key(
        tables["operation_detail"].filter(F.col("LIBELLE_TYPE_TRANSACTION").isin(*rb.SYSTEM3_FAMILIES)).join(header.select(*wanted), wanted, "left_semi"),
        unique, ["NUMERO_CONTRAT", "CODE_SUPPORT", "CODE_UT", "DETAIL_TRANSACTION", "MONTANT", "CODE_CONVENTION_GESTION"],
    ).withColumn("NUMERO_CONTRAT", pad_code("NUMERO_CONTRAT", 16))
    rows = header_driven(detail, header, operation)
    return rows.withColumns({
        "TYPE_SUPPORT": rb.SUPPORT_TYPE_3.column(),
        "CODE_ISIN": filled("CODE_ISIN", UNKNOWN),
        "Type_Transaction": rb.SYSTEM3_TYPES.column(),
    }).withColumn("MONTANT_TRANSACTION", rb.SYSTEM3_AMOUNT.column())


def flows(tables: Mapping[str, DataFrame], period: Period, activity: str = "signed") -> DataFrame:
    summed = movements(tables, period).groupBy(*KEYS).agg(
        *rb.SYSTEM3_BUCKETS.sums(), *rb.SYSTEM3_FEES.sums(), F.max("LIBELLE_SUPPORT").alias("LIBELLE_SUPPORT"))
    derived = rb.SYSTEM3_BUCKETS.derive(summed)
    measures = ("Collecte_Brute_TOTALE", "Prestation_TOTALE", "Arbitrage_Entrant", "Arbitrage_Sortant", *FEES)
    return drop_inactive(computed_once(derived, "flows3"), ["NUMERO_CONTRAT"], measures, activity)


def base_ledger(tables: Mapping[str, DataFrame], period: Period, activity: str = "signed") -> DataFrame:
    combined = ledger_of_groups(
        flows(tables, period, activity), positions(tables, period), KEYS,
        (*rb.SYSTEM3_BUCKETS.names, *rb.SYSTEM3_FEES.names, "PM_DEBUT", "PM_FIN"),
        attributes={"DT_VL_FIN": "max", "LIBELLE_SUPPORT": "max"},
    )
    return drop_inactive(computed_once(combined, "ledger3"), ["NUMERO_CONTRAT"], (*ACTIVITY, *FEES), activity)


def contracts(table: DataFrame, persons: DataFrame, conventions: DataFrame, names: rb.Names) -> DataFrame:
    """One row per contract with its management convention and holder."""
    convention = one_per_key(
        conventions.select("CODE_CONVENTION_GESTION", F.col("LIBELLE_PROFIL_FORMULE_GESTION").alias("PROFIL_GESTION")),
        ["CODE_CONVENTION_GESTION"], ["PROFIL_GESTION"],
    )
    # Few conventions, found in a large table: stored, so that Spark knows their size and contracts are not dealt by convention.
    described = lookup(table, computed_once(convention, "conventions3"), ["CODE_CONVENTION_GESTION"], unique=True).select(
        pad_code("NUMERO_CONTRAT", 16).alias("NUMERO_CONTRAT"),
        pad_code("CODE_PORTEFEUILLE", 10).alias("CODE_PORTEFEUILLE"),
        F.col("DATE_DEBUT_EFFET_CONTRAT").alias("DATE_EFFET"),
        F.col("DATE_ANNULATION").alias("DATE_TERME"),
        F.col("STATUT").alias("SITUATION_CLOTURE"),
        F.col("LIBELLE_PRODUIT").alias("NOM_PRODUIT"),
        rb.legal_entity_3(names).column().alias("UJ"),
        F.col("LIBELLE_CONVENTION_GESTION").alias("TYPE_GESTION"),
        F.col("CANAL_PORTEFEUILLE").alias("LB_CANAL"),
        rb.RETIREMENT_3.column().alias("TOP_RETRAITE"),
        "PROFIL_GESTION",
    )
    single = one_per_key(described, ["NUMERO_CONTRAT"], [F.col("DATE_EFFET").desc_nulls_last(), "NOM_PRODUIT", "SITUATION_CLOTURE"])
    holders = one_per_key(
        persons.select(
            pad_code("NUMERO_CONTRAT", 16).alias("NUMERO_CONTRAT"),
            F.col("NUMERO_PERSONNE").alias("NUMERO_CLIENT"), rb.PERSON_TYPE_3.column().alias("TYPE_PRSN")),
        ["NUMERO_CONTRAT"], ["NUMERO_CLIENT", "TYPE_PRSN"],
    )
    # Contract data are attached to holders: without a holder a contract stays undescribed.
    return lookup(holders, single, ["NUMERO_CONTRAT"], unique=True)


def system3(
    tables: Mapping[str, DataFrame],
    period: Period,
    names: rb.Names = rb.DEFAULT_NAMES,
    activity: str = "signed",
    segment: str | None = None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Canonical rows of system 3.

    ``tables``: valuations, contracts, catalogue_products, catalogue_supports (history),
    operation_detail, operations, persons (history), conventions.
    """
    described = lookup(
        base_ledger(tables, period, activity),
        contracts(tables["contracts"], tables["persons"], tables["conventions"], names),
        ["NUMERO_CONTRAT"], unique=True,
    )
    return canonical(described.withColumns({
        "SUPPORT_SPECIFIQUE": rb.specific_support("CODE_ISIN", rb.SPECIFIC_SYSTEM3).column(),
        "CODE_UT": pad_code("CODE_UT", 5, numeric_only=True),
        "CODE_PRODUIT": pad_code("CODE_UV", 5, numeric_only=True),
        "NOM_SUPPORT": F.col("LIBELLE_SUPPORT"),
        "SEGMENT": F.lit(segment or names.system3),
        "SYSTEME": F.lit(names.system3),
        "TOP_RETRAITE": filled("TOP_RETRAITE", "EPARGNE"),
        "UJ": filled("UJ", "SA"),
        "LB_CANAL": filled("LB_CANAL", UNKNOWN),
        "DT_VL_FIN": F.coalesce("DT_VL_FIN", F.lit(period.end)),
    }), extra)
