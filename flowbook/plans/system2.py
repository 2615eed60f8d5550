"""System 2: act codes with reversals, pro-rata amounts, transfer flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import Period, last_weekday_before_year
from ..functions.codes import blank_to, filled, pad_code, split_item
from ..operators.dedupe import group_totals, one_per_key
from ..operators.flows import motive_flags, units_times_price
from ..operators.joins import Lookup, lookup, lookup_chain, unique_dimension
from ..operators.positions import as_of_snapshot, drop_empty_rows, drop_inactive, ledger_of_groups, open_close
from ..session import computed_once
from . import rulebook as rb
from .canonical import ACTIVITY, canonical

KEYS = ("NUMERO_CONTRAT", "CODE_UT", "CODE_UC", "CODE_ISIN", "TYPE_SUPPORT", "CODE_PROFIL", "SUPPORT_SPECIFIQUE")
ACT = ("NUMERO_CONTRAT", "NUMERO_ACTE", "SENS_ACTE", "CODE_ACTE_COURT")
FEES = ("Frais_de_gestion", "Participation_aux_benefices")
# What is read of a movement on a support, besides the act.
MOVED = (
    *ACT, "CODE_UT", "CODE_UC", "CODE_ISIN", "CODE_PROFIL", "TOP_EUROCROISSANCE", "LIBELLE_TYPE_SUPPORT", "SUPPORT_CONVENTION", "NB_PART_SUPPORT_MVT", "VL_SUPPORT",
)
VERSION = "DATE_VERSION"
TRANSFER_MOTIVES = ("A", "F", "S")
ROLES = ("Souscripteur", "Assuré", "modalité à traduire", "Autre")


def act_labels(table: DataFrame) -> DataFrame:
    """One long label per act: that of its greatest short code."""
    named = table.select(
        F.col("HDL_ACT_ID").alias("CODE_ACTE"), F.col("HDL_ACT_FULL_NAME").alias("LIBELLE_ACTE_LONG"),
        F.col("HDL_ACT_ABS_NAME").alias("__short"),
    )
    return one_per_key(named, ["CODE_ACTE"], [F.col("__short").desc_nulls_last(), "LIBELLE_ACTE_LONG"]).drop("__short")


def profiles(table: DataFrame) -> DataFrame:
    """Current management profiles, one row per profile code."""
    current = table.filter(F.col("EFF_D_OFF").isNull() & (F.col("PROF_SHORT_NAME") != "SU")).select(
        F.col("PROF_ID").alias("CODE_PROFIL"),
        F.initcap("PROF_FULL_NAME").alias("PROFIL_GESTION"),
        F.col("CVN_GES").alias("CONVENTION_GESTION"),
    )
    single = one_per_key(current, ["CODE_PROFIL"], ["CONVENTION_GESTION", "PROFIL_GESTION"])
    return single.select("CODE_PROFIL", "PROFIL_GESTION", rb.CONVENTION.column().alias("TYPE_GESTION"))


def _support_keys() -> dict:
    """The part of the key that is derived; one rule for flows and positions alike."""
    return {
        "CODE_PROFIL": blank_to("CODE_PROFIL", "01"),
        "TYPE_SUPPORT": rb.SUPPORT_TYPE_2.column(),
        "SUPPORT_SPECIFIQUE": rb.specific_unless_convention("CODE_ISIN", rb.SPECIFIC_SYSTEM2).column(),
    }


def transfer_flags(contracts: DataFrame) -> DataFrame:
    """Entry and exit by transfer, one row per contract over its whole history."""
    return motive_flags(contracts, ["NUMERO_CONTRAT"], {
        "TOP_TE": ("MOTIF_ENTREE", TRANSFER_MOTIVES), "TOP_TS": ("MOTIF_SORTIE", TRANSFER_MOTIVES),
    })


def movements(supports: DataFrame, acts: DataFrame, contracts: DataFrame, period: Period) -> DataFrame:
    """Created movements with their share of the client's amount and their transfer flags.

    The net total of an act covers both directions, so it is taken before the direction filter.
    """
    # The period's rows are needed for the totals, for the rows they are joined to and for two cuts, so they are stored once.
    dated = computed_once(
        supports.filter(F.col("DATE_CREATION_ACTE").between(F.lit(period.start), F.lit(period.end))).select(*MOVED), "dated2")
    priced = dated.withColumns({
        "MONTANT_NET": units_times_price("NB_PART_SUPPORT_MVT", "VL_SUPPORT").cast("decimal(18,2)"), **_support_keys(),
    })
    totalled = group_totals(priced, ["NUMERO_CONTRAT", "NUMERO_ACTE", "CODE_ACTE_COURT"], {"CUMUL": F.sum("MONTANT_NET")})
    created = totalled.filter(F.col("SENS_ACTE") == "Création")
    # Acts and contract history are cut to the period's movements before they are grouped; acts are stored, as their check reads them too.
    mine = computed_once(
        acts.select(*ACT, "LIBELLE_MOTIF_ACTE", "LIBELLE_ACTE_COMPLEMENT", "MONTANT_CLIENT").join(dated.select(*ACT), list(ACT), "left_semi"), "acts2")
    act = unique_dimension(mine, ACT)
    history = contracts.join(dated.select("NUMERO_CONTRAT"), ["NUMERO_CONTRAT"], "left_semi")
    share = F.try_divide(F.col("MONTANT_NET") * F.col("MONTANT_CLIENT"), F.col("CUMUL"))
    return lookup_chain(created, [
        Lookup(act, ACT, unique=True), Lookup(transfer_flags(history), ["NUMERO_CONTRAT"], unique=True),
    ]).withColumn("MONTANT_BRUT", filled(share, 0))


def flows(supports: DataFrame, acts: DataFrame, contracts: DataFrame, period: Period, legacy_switches: bool = False) -> DataFrame:
    """Bucket sums per key, rounded to cents."""
    buckets = rb.system2_buckets(legacy_switches)
    sums = movements(supports, acts, contracts, period).groupBy(*KEYS).agg(*buckets.sums())
    rounded = sums.withColumns({b: F.round(b, 2).cast("decimal(28,2)") for b in buckets.buckets})
    return buckets.derive(rounded).withColumn("Arbitrage_Net", F.col("Arbitrage_Entrant") - F.col("Arbitrage_Sortant"))


def valued(table: DataFrame) -> DataFrame:
    return table.withColumns(_support_keys())


def snapshots(tables: Mapping[str, DataFrame], period: Period) -> tuple[DataFrame, DataFrame]:
    """The positions at the opening and at the closing of the period.

    ``positions`` is the versioned table, whole snapshots under ``DATE_VERSION``: the newest version on or before the
    last weekday of the previous year, and the newest on or before the period's end.  Each version is found by a scalar
    subquery on the partition column, so two partitions are read.  Two ready frames, ``positions_opening`` and
    ``positions_closing``, are taken instead where there is no such table.
    """
    if "positions" not in tables:
        return tables["positions_opening"], tables["positions_closing"]
    versions = tables["positions"]
    return as_of_snapshot(versions, VERSION, opening_date(period)), as_of_snapshot(versions, VERSION, period.end)


def base_ledger(tables: Mapping[str, DataFrame], period: Period, activity: str = "signed", legacy_switches: bool = False) -> DataFrame:
    opening, closing = snapshots(tables, period)
    held = open_close(
        valued(opening),
        valued(closing).withColumnsRenamed({"DATE_VALEUR_UC": "DT_VL_FIN", "LIBELLE_SUPPORT": "NOM_SUPPORT"}),
        KEYS, "PM_SUPPORT", attributes={"DT_VL_FIN": "max", "NOM_SUPPORT": "max"},
    )
    moved = flows(tables["support_flows"], tables["act_flows"], tables["contracts"], period, legacy_switches)
    buckets = rb.system2_buckets(legacy_switches)
    combined = ledger_of_groups(
        moved, held, KEYS, (*buckets.names, "Arbitrage_Net", "PM_DEBUT", "PM_FIN"), attributes={"DT_VL_FIN": "max", "NOM_SUPPORT": "max"})
    return drop_inactive(computed_once(combined, "ledger2"), ["NUMERO_CONTRAT"], (*ACTIVITY, *FEES), activity)


def contracts(table: DataFrame, persons: DataFrame) -> DataFrame:
    """The newest row of each contract with its newest holder."""
    newest = one_per_key(table, ["NUMERO_CONTRAT"], [F.col("DATE_SYSTEME").desc_nulls_last(), "NOM_PRODUIT", "CODE_UV"])
    described = newest.select(
        "NUMERO_CONTRAT",
        F.col("LIBELLE_ETAT_CONTRAT").alias("SITUATION_CLOTURE"),
        split_item("NOM_PRODUIT", " - ", 2).alias("NOM_PRODUIT"),
        pad_code("CODE_UV", 5, numeric_only=True).alias("CODE_PRODUIT"),
        F.col("DATE_DEBUT_EFFET_CONTRAT").alias("DATE_EFFET"),
        F.col("DATE_FIN_EFFET_CONTRAT").alias("DATE_TERME"),
        pad_code(pad_code("IDENTIFIANT_PORTEFEUILLE", 10, only_short=True), 10).alias("CODE_PORTEFEUILLE"),
        rb.LEGAL_ENTITY_2.column().alias("UJ"),
        F.coalesce("CANAL_PORTEFEUILLE", "RESEAU").alias("LB_CANAL"),
        rb.RETIREMENT_2.column().alias("TOP_RETRAITE"),
    )
    holders = one_per_key(
        persons.filter(F.col("ROLE_PERSONNE").isin(*ROLES)), ["NUMERO_CONTRAT"],
        [F.col("DATE_SYSTEME").desc_nulls_last(), "IDENTIFIANT_PERSONNE"],
    ).select("NUMERO_CONTRAT", rb.PERSON_TYPE_2.column().alias("TYPE_PRSN"), pad_code("IDENTIFIANT_PERSONNE", 10).alias("NUMERO_CLIENT"))
    return lookup(described, holders, ["NUMERO_CONTRAT"], unique=True)


def opening_date(period: Period):
    """Last weekday of the previous year, as a column (the snapshot date of the opening position)."""
    return last_weekday_before_year(F.lit(period.end))


def system2(
    tables: Mapping[str, DataFrame],
    period: Period,
    segments: DataFrame,
    names: rb.Names = rb.DEFAULT_NAMES,
    activity: str = "signed",
    legacy_switches: bool = False,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Canonical rows of system 2.

    ``tables``: positions (versioned; or positions_opening and positions_closing), support_flows, act_flows, contracts
    (history), persons (history), profiles.  Contracts drive: one without facts stays only
    if it has a label, as empty rows without support or person type are dropped.
    """
    facts = lookup(base_ledger(tables, period, activity, legacy_switches), profiles(tables["profiles"]), ["CODE_PROFIL"], unique=True)
    joined = contracts(tables["contracts"], tables["persons"]).join(facts, ["NUMERO_CONTRAT"], "left")
    kept = drop_empty_rows(drop_empty_rows(joined, "TYPE_SUPPORT", ACTIVITY), "TYPE_PRSN", ACTIVITY)
    coded = kept.withColumn("CODE_UT", pad_code("CODE_UT", 5, numeric_only=True))
    segmented = lookup(coded, segments, ["CODE_PRODUIT", "CODE_UT"], ["SEGMENT"], {"SEGMENT": "Inconnu"}, unique=True)
    return canonical(segmented.withColumns({
        "NUMERO_CONTRAT": pad_code("NUMERO_CONTRAT", 16), "SYSTEME": F.lit(names.system2),
    }), extra)
