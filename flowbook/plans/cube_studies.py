"""Studies on the management-accounting cube."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import week_of_quarter, week_of_quarter_iso
from ..operators.cube import CubeSpec, run_levels
from ..operators.flows import period_columns
from ..operators.rules import RuleSet, relabel
from . import rulebook as rb

# Standard filters and indicator members.
SOURCE_CODE = "VIE_SOC"
SAVINGS = "Total Epargne Individuelle"
PROTECTION = "Total Prévoyance"
SAVINGS_SUPPORT = "Support Epargne"
SURRENDER_AMOUNTS = (
    "Rachat total", "Rachats OD", "Rachats acceptations", "Rachat partiel", "Rachat fourgous", "Rachat programmé",
)
SURRENDER_COUNTS = ("Nombre de rachats totaux", "Nombre de rachats partiels")
BUDGET_INDICATORS = (
    "Emissions PP (yc OD)", "Emissions Vie PUVL Total", "Prestations y compris acceptations", "Emissions Totales", "Apport Net",
)
BUDGET_KEYS = (
    "UJ", "TOP_EPAR_RET_PREV", "VISION_LUX", "SYSTEME", "MOIS", "ANNEE", "RESEAU", "REGION", "NATURE", "NATURE2",
    "DETAILS_EMISSIONSVIE",
)


def standard_filters(cube: CubeSpec, names: rb.Names = rb.DEFAULT_NAMES, market: bool = True) -> CubeSpec:
    """Source, network, legal entity and, optionally, market of the standard view."""
    house = names.house.capitalize()
    spec = (
        cube.where("source", "L6_OBJ_COD", [SOURCE_CODE])
        .where("reseau", "Res_Com_Niv_6", [f"Réseau {house} France"])
        .where("uj", "L6_UJ_PRISM_LBR", [f"Total UJ {names.house} France"])
    )
    return spec.where("marche", "L4_OBJ_LBR", [f"Total Marché {names.house} France"]) if market else spec


def surrender_study(cube: CubeSpec, months: Sequence, names: rb.Names = rb.DEFAULT_NAMES) -> DataFrame:
    """Surrender amounts by network and surrender counts, by effect date, with the week of the quarter."""
    common = (
        standard_filters(cube, names)
        .show("maille_fine", "DATE_COMPTABLE", "DATE_EFFET", "func_month")
        .months(months)
        .show("source", "L2_OBJ_COD")
        .show("reseau", "Res_Com_Niv_4", "Res_Com_Niv_3", "Region_Com_Niv_2_Detail_Cube")
        .show("produits", "L5_SUPPORT_LBR")
        .where("produits", "L7_PRODUIT_LBR", [SAVINGS])
    )
    keys = ["maille_fine_DATE_COMPTABLE", "maille_fine_DATE_EFFET", "maille_fine_func_month", "source_L2_OBJ_COD"]
    savings = F.col("produits_L5_SUPPORT_LBR") == SAVINGS_SUPPORT

    levels = {
        "amounts": common.show("indicateurs", "L5_LBR_DESC", "L8_LBR_DESC").where("indicateurs", "L5_LBR_DESC", SURRENDER_AMOUNTS),
        "counts": common.show("indicateurs", "L6_LBR_DESC", "L8_LBR_DESC").where("indicateurs", "L6_LBR_DESC", SURRENDER_COUNTS),
    }
    rows = run_levels(levels).filter(savings)
    # Counts are not told apart by network.
    network = F.when(F.col("level") == "amounts", rb.cube_network(names).column())
    studied = rows.withColumn("RESEAU", network).groupBy(
        "level", *keys, "indicateurs_L5_LBR_DESC", "indicateurs_L6_LBR_DESC", "indicateurs_L8_LBR_DESC", "RESEAU",
    ).agg(F.sum("Value").alias("MONTANT")).drop("level")
    date = F.col("maille_fine_DATE_EFFET")
    return studied.withColumns({
        "mois": F.month(date),
        "annee": F.year(date),
        "trimestre": F.quarter(date),
        "semaine_annee": F.weekofyear(date),
        "semaine_trimestre_iso": week_of_quarter_iso(date),
        "semaine_trimestre": week_of_quarter(date),
    })


def budget_rows(cube: CubeSpec, months: Sequence, ape: RuleSet, names: rb.Names = rb.DEFAULT_NAMES) -> DataFrame:
    """Labelled rows of the budget study: standard indicators stacked with the derived APE.

    ``ape`` is the rule table of the derived indicator (its formula belongs to the cube).
    """
    shared = (
        standard_filters(cube, names, market=False)
        .show("maille_fine", "DATE_COMPTABLE", "CTA_NUMERO", "tech_filename", "func_month")
        .months(months)
        .show("source", "L4_OBJ_LBR", "L2_OBJ_LBR")
        .show("reseau", "Res_Com_Niv_3", "Res_Com_Niv_4", "Res_Com_Niv_6", "Res_Com_Niv_2_Detail_Cube", "Region_Com_Niv_2_Detail_Cube")
        .show("region", "OBJ_LBR")
        .show("uj", "L3_UJ_PRISM_LBR")
        .show("produits", "L5_PRISM_LBR", "L2_PRODUIT_LBR", "L3_SUPPORT_LBR", "L4_SUPPORT_LBR", "L7_PRODUIT_LBR", "L4_PILOTECO_AGA_LBR")
        .where("produits", "L7_PRODUIT_LBR", [SAVINGS, PROTECTION])
    )
    standard = (
        shared.where("marche", "L4_OBJ_LBR", [f"Total Marché {names.house} France"])
        .show("pyramide", "port_cod", "Portefeuille", "PP_1_Delegation", "PP_2_Circonsription")
        .show("indicateurs", "L2_LBR_DESC", "L4_LBR_DESC", "L6_LBR_DESC", "L7_LBR_DESC", "L9_LBR_DESC")
        .where("indicateurs", "L7_LBR_DESC", BUDGET_INDICATORS)
    )
    derived = shared.show("pyramide", "port_cod", "Portefeuille", "PP_1_Delegation").indicator("APE", ape)
    both = run_levels({"standard": standard, "derived": derived})
    family = F.when(F.col("level") == "derived", rb.APE_ROLL_UP.column()).otherwise(F.col("indicateurs_L7_LBR_DESC"))
    stacked = both.withColumn("indicateurs_L7_LBR_DESC", family).drop("level", "indicateur_APE")
    dated = stacked.withColumn("maille_fine_func_month", F.col("maille_fine_func_month").cast("date"))
    labelled = relabel(
        dated.withColumns({"MOIS": F.month("maille_fine_func_month"), "ANNEE": F.year("maille_fine_func_month")}), [
            ("RESEAU", rb.cube_network(names)),
            ("REGION", rb.cube_region(names)),
            ("TOP_EPAR_RET_PREV", rb.RETIREMENT_CUBE),
            ("UJ", rb.legal_entity_cube(names)),
            ("produits_L4_SUPPORT_LBR", rb.EUROCROISSANCE_SUPPORT),
            ("SUPPORT", rb.SUPPORT_TYPE_CUBE),
            ("VISION_LUX", rb.foreign_view(names)),
            ("SYSTEME", rb.CUBE_SYSTEM),
            ("NATURE", rb.MOVEMENT_NATURE),
            ("NATURE2", rb.NATURE_ROLL_UP),
            ("DETAILS_EMISSIONSVIE", rb.ISSUE_DETAIL),
        ])
    return labelled.filter(F.col("TOP_EPAR_RET_PREV").isin("RETRAITE", "EPARGNE") & (F.col("NATURE") != "ND"))


def budget_study(cube: CubeSpec, months: Sequence, year: int, month: int, ape: RuleSet, names: rb.Names = rb.DEFAULT_NAMES) -> DataFrame:
    """Amounts by entity, network, region and nature, with the comparative periods."""
    rows = budget_rows(cube, months, ape, names)
    compared = period_columns("ANNEE", "MOIS", "Value", year, month)
    return rows.groupBy(*BUDGET_KEYS).agg(F.sum("Value").alias("MONTANT"), *[F.sum(c).alias(n) for n, c in compared.items()])


def contract_lookup(
    cube: CubeSpec,
    date: dt.date,
    contracts: Sequence[str],
    level: str,
    members: Sequence[str],
    families: Sequence[str],
    names: rb.Names = rb.DEFAULT_NAMES,
) -> DataFrame:
    """Year-to-date indicators of given contracts.

    The contract filter is part of the specification, so it reaches the fact scan
    instead of running on the aggregated cube.
    """
    spec = (
        standard_filters(cube, names)
        .ytd(date)
        .show("maille_fine", "CTA_NUMERO")
        .where("maille_fine", "CTA_NUMERO", contracts)
        .where("produits", "L7_PRODUIT_LBR", [SAVINGS])
        .show("indicateurs", "L4_LBR_DESC", "L6_LBR_DESC", "L7_LBR_DESC", "L9_LBR_DESC")
        .where("indicateurs", level, members)
    )
    return spec.run(having=F.col("indicateurs_L9_LBR_DESC").isin(*families)).drop("indicateurs_L9_LBR_DESC")


def contract_levels(
    cube: CubeSpec,
    date: dt.date,
    contracts: Sequence[str],
    levels: Mapping[str, Sequence[str]],
    names: rb.Names = rb.DEFAULT_NAMES,
) -> DataFrame:
    """Year-to-date values of given contracts at several levels of the indicators, one scan for all.

    ``levels``: level column -> members wanted at that level.  Each result row has its level's name in ``level`` and its
    member in that level's column.
    """
    common = (
        standard_filters(cube, names)
        .ytd(date)
        .show("maille_fine", "CTA_NUMERO")
        .where("maille_fine", "CTA_NUMERO", contracts)
        .where("produits", "L7_PRODUIT_LBR", [SAVINGS])
    )
    return run_levels({column: common.show("indicateurs", column).where("indicateurs", column, members) for column, members in levels.items()})
