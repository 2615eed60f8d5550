"""System 1: labelled movements, option packs, current and archived contracts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import Period
from ..functions.codes import filled, pad_code
from ..operators.dedupe import current_else_archive, one_per_key
from ..operators.joins import Lookup, lookup, lookup_chain, settled, unique_dimension
from ..operators.positions import drop_inactive, ledger_of_groups, snapshot_pair
from ..session import computed_once
from . import rulebook as rb
from .canonical import ACTIVITY, canonical

KEYS = ("ID_CONTRAT", "CD_FUND", "CD_SUPPORT", "CD_PACK", "CD_OG")
FEES = ("Frais_Mandat", "Frais_Acquisition", "Frais_Gestion", "Frais_Rachat")
FREE = "libre"


def positions(table: DataFrame, period: Period) -> DataFrame:
    """Opening and closing valuation of each contract x support x option from one scan.

    The newest date of each key counts; several rows of that date are one position and are added up.
    """
    known = table.withColumn("CD_OG", filled("CD_OG", FREE))
    return snapshot_pair(
        known, KEYS, "DT_POSITION", period.previous_year_end, period.end,
        opening_cols={"PM_DEBUT": "PM", "NB_UC_DEBUT": "NMBR_UC", "VL_DEBUT": "VL_RACHAT"},
        closing_cols={
            "PM_FIN": "PM", "NB_UC_FIN": "NMBR_UC", "VL_FIN": "VL_RACHAT",
            "MT_NON_INVESTI": "MT_NON_INVESTI", "DT_VL_FIN": "DT_POSITION",
        },
        added=["PM", "NMBR_UC", "MT_NON_INVESTI"],
    )


def movements(detail: DataFrame, header: DataFrame) -> DataFrame:
    """Settled movements: detail rows whose header says so, one header per movement.

    Headers are cut to the movements at hand before they are checked for repeats.
    """
    closed = header.filter(F.col("LB_STATUT") == "Soldé").select("ID_CONTRAT", "ID_MVT", "LB_TYPE_MVT").join(
        detail.select("ID_CONTRAT", "ID_MVT"), ["ID_CONTRAT", "ID_MVT"], "left_semi")
    heads = unique_dimension(closed, ["ID_CONTRAT", "ID_MVT"])
    rows = settled(detail, heads, ["ID_CONTRAT", "ID_MVT"], F.lit(True))
    return rows.withColumn("CD_OG", filled("CD_OG", FREE))


def flows(detail: DataFrame, header: DataFrame, period: Period) -> DataFrame:
    """Bucket sums per ledger key for the year to the reporting month."""
    dated = detail.filter(F.col("DT_INVEST").between(F.lit(period.start), F.lit(period.end)))
    return rb.SYSTEM1_BUCKETS.aggregate(movements(dated, header), KEYS)


def base_ledger(tables: Mapping[str, DataFrame], period: Period, activity: str = "signed") -> DataFrame:
    """Flows and positions per key, without inactive contracts."""
    combined = ledger_of_groups(
        flows(tables["movement_detail"], tables["movement_header"], period),
        positions(tables["positions"], period),
        KEYS,
        (*rb.SYSTEM1_BUCKETS.names, "MT_NON_INVESTI", "PM_DEBUT", "PM_FIN"),
        attributes={c: "max" for c in ("DT_VL_FIN", "VL_DEBUT", "NB_UC_DEBUT", "VL_FIN", "NB_UC_FIN")},
    )
    return drop_inactive(computed_once(combined, "ledger1"), ["ID_CONTRAT"], (*ACTIVITY, *FEES), activity)


def options(products: DataFrame, packs: DataFrame) -> DataFrame:
    """Labels of a management option: its own, and those of its pack; one row per option."""
    own = one_per_key(
        products.select(filled("CD_OG", FREE).alias("CD_OG"), "LB_OG_AIA", "LB_SOC_GESTION"), ["CD_OG"], ["LB_OG_AIA", "LB_SOC_GESTION"])
    pack = one_per_key(packs.select(filled("CD_OG", FREE).alias("CD_OG"), "LB_PACK"), ["CD_OG"], ["LB_PACK"])
    return lookup(own, pack, ["CD_OG"], unique=True)


def supports(table: DataFrame) -> DataFrame:
    """The newest description of each fund."""
    newest = one_per_key(table, ["CD_FUND"], [F.col("DT_SITUATION").desc_nulls_last(), "NOM", "CD_INTERNE"])
    return newest.select(
        "CD_FUND",
        F.col("NOM").alias("NOM_SUPPORT"),
        F.col("CD_INTERNE").alias("CODE_UT"),
        rb.SUPPORT_TYPE_1.column().alias("TYPE_SUPPORT"),
        rb.specific_support("CD_FUND", rb.SPECIFIC_SYSTEM1).column().alias("SUPPORT_SPECIFIQUE"),
    )


def contracts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every contract once: its current row, else its archived one, with product and subscriber.

    A current contract takes its subscriber from the current persons, an archived one from
    the archive, so persons are kept per source.
    """
    picked = current_else_archive(
        tables["contracts"], tables["contracts_archive"], ["ID_CONTRAT"],
        [F.col("DT_SOUSCRIPTION").desc_nulls_last(), "CD_PROD", "LB_STATUS"], "LB_STATUS", "En erreur", source_col="source",
    )
    named = lookup(picked, tables["products"].select("CD_PROD", F.col("LB_PROD").alias("NOM_PRODUIT")), ["CD_PROD"])
    described = named.select(
        "ID_CONTRAT", "source", "CD_PROD", "NOM_PRODUIT",
        F.col("LB_STATUS").alias("SITUATION_CLOTURE"),
        F.col("DT_SOUSCRIPTION").alias("DATE_EFFET"),
        F.col("DT_CLOTURE").alias("DATE_TERME"),
        pad_code("CD_PTF_RDU", 10).alias("CODE_PORTEFEUILLE"),
        F.col("CD_UJ").alias("UJ"),
        rb.RETIREMENT_1.column().alias("TOP_RETRAITE"),
    )
    persons = tables["persons"].withColumn("source", F.lit(0)).unionByName(tables["persons_archive"].withColumn("source", F.lit(1)))
    subscribers = one_per_key(
        persons.filter(F.col("LB_ROLE") == "Souscripteur").select("ID_CONTRAT", "source", "REFERENCE_CLIENT", "TYPE_PRSN"),
        ["ID_CONTRAT", "source"], ["REFERENCE_CLIENT", "TYPE_PRSN"],
    )
    return lookup(described, subscribers, ["ID_CONTRAT", "source"], unique=True).drop("source")


def system1(
    tables: Mapping[str, DataFrame],
    period: Period,
    segments: DataFrame,
    names: rb.Names = rb.DEFAULT_NAMES,
    activity: str = "signed",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Canonical rows of system 1.

    ``tables``: positions, movement_detail, movement_header, option_products, option_packs,
    supports, persons, persons_archive, contracts, contracts_archive, products, distributors.
    ``extra`` adds measures that the canonical row leaves out (fees, MT_NON_INVESTI).
    """
    distributors = one_per_key(
        tables["distributors"].select(pad_code("CD_DISTRIBUTEUR", 10).alias("CODE_PORTEFEUILLE"), F.col("LB_RESEAU").alias("LB_CANAL")),
        ["CODE_PORTEFEUILLE"], ["LB_CANAL"],
    )
    # Few options, found in large tables: stored, so that Spark knows their size and the facts are not dealt by option.
    option_labels = computed_once(options(tables["option_products"], tables["option_packs"]), "options1")
    described = lookup_chain(base_ledger(tables, period, activity), [
        Lookup(option_labels, ["CD_OG"], unique=True),
        Lookup(supports(tables["supports"]), ["CD_FUND"], unique=True),
        Lookup(contracts(tables), ["ID_CONTRAT"], unique=True, spread_nulls=True),
        Lookup(distributors, ["CODE_PORTEFEUILLE"], unique=True),
    ])
    coded = described.withColumns({
        "CODE_UT": pad_code("CODE_UT", 5, numeric_only=True),
        "CODE_PRODUIT": pad_code("CD_PROD", 5, numeric_only=True),
    })
    segmented = lookup(coded, segments, ["CODE_PRODUIT", "CODE_UT"], ["SEGMENT"], {"SEGMENT": "Inconnu"}, unique=True)
    return canonical(segmented.withColumns({
        "NUMERO_CONTRAT": pad_code("ID_CONTRAT", 16),
        "CODE_ISIN": F.col("CD_FUND"),
        "PROFIL_GESTION": filled("LB_OG_AIA", "Gestion Libre"),
        "TYPE_GESTION": rb.MANDATE.column(),
        "NUMERO_CLIENT": pad_code(filled("REFERENCE_CLIENT", ""), 10),
        "SYSTEME": F.lit(names.system1),
    }), extra)
