"""System 4: monthly CSV files to a reporting table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import pad_code, parse_number, parsed_date, truncated
from ..operators.flows import scaled, sign_normalised, switch_nature
from ..operators.joins import lookup
from ..sources.files import RowRules
from . import rulebook as rb

AMOUNTS = ("MONTANT_BRUT", "MONTANT_NET", "PM_FIN")
INTERNATIONAL_RANGE = (9990000, 9999999)


def row_rules(columns: Sequence[str]) -> RowRules:
    """What a monthly file's lines must hold, for the columns its kind has."""
    return RowRules(
        amounts=[c for c in AMOUNTS if c in columns],
        dates={c: "dd/MM/yyyy" for c in ("DATE_EFFET_FLUX", "DATE_EFFET_CONTRAT") if c in columns},
        required=[c for c in ("NUMERO_CONTRAT", "SITUATION_CONTRAT") if c in columns],
        domains={c: values for c, values in (("TYPE_SUPPORT", ("EURO", "UC")),) if c in columns},
    )


def clean(df: DataFrame, names: rb.Names = rb.DEFAULT_NAMES) -> DataFrame:
    """Shared cleaning: sentinel rows and repeated rows out, codes padded, network named, amounts read.

    Text keys are compared through ``try_cast``: a code like ``A7`` is not a number and not 0.
    """
    contract = F.col("NUMERO_CONTRAT")
    real = contract.isNotNull() & ~F.coalesce(contract.try_cast("double") == 0, F.lit(False))
    kept = df.filter(real & (F.col("SITUATION_CONTRAT") != "0")).dropDuplicates()
    portfolio = F.col("CODE_PORTEFEUILLE").try_cast("double")
    return kept.withColumns({
        "INTERNATIONAL": F.when(portfolio.between(*INTERNATIONAL_RANGE), 1).otherwise(0),
        "NUMERO_CONTRAT": pad_code("NUMERO_CONTRAT", 16),
        "CODE_PORTEFEUILLE": pad_code("CODE_PORTEFEUILLE", 10),
        "RESEAU": rb.FILE_NETWORK.column(),
        "SYSTEME": F.lit(names.system1),
        **{a: parse_number(a) for a in AMOUNTS},
    })


def reporting(df: DataFrame, network: DataFrame, whole_units: bool = False) -> DataFrame:
    """Reporting columns in thousands, outflows positive, with the valuation month and the region.

    ``whole_units`` truncates reserves to whole units first, as the inherited report does.
    """
    reserve = truncated("PM_FIN") if whole_units else F.col("PM_FIN")
    dated = df.withColumns({
        "DATE_EFFET_FLUX": parsed_date("DATE_EFFET_FLUX"),
        "DATE_EFFET_CONTRAT": parsed_date("DATE_EFFET_CONTRAT"),
        "PM_FIN": reserve,
    }).withColumnsRenamed({
        "NUMERO_CONTRAT": "N°Contrat", "PM_FIN": "Encours", "CODE_PORTEFEUILLE": "code_apporteur", "TYPE_TRANSACTION": "groupe",
        "RESEAU": "LB_RESEAU", "DATE_EFFET_CONTRAT": "Date_de_souscription", "NOM_APPORTEUR": "apporteur", "NOM_PRODUIT": "libprod",
    })
    scaled_rows = dated.withColumns({
        "MONTANT_BRUT": scaled("MONTANT_BRUT"),
        "Encours": scaled("Encours"),
        "DATE_VALEUR": F.coalesce("DATE_EFFET_FLUX", "Date_de_souscription"),
    }).withColumn("nature", switch_nature(
        "groupe", "MONTANT_BRUT", "ACTE_GESTION", "Arbitrage", "Opération sur titres", "Arbitrage sortant", "Arbitrage entrant"))
    outflow = F.col("nature").isin("Arbitrage sortant", "Rachat partiel", "Rachat total")
    valued = scaled_rows.withColumns({
        "MONTANT_BRUT": sign_normalised("MONTANT_BRUT", outflow),
        "Annee_valeur": F.col("annee_fichier"),
        "Mois_valeur": rb.VALUATION_MONTH.column(),
    })
    regions = network.select(F.col("CODE_PORTEFEUILLE").alias("code_apporteur"), "REGION")
    return lookup(valued, regions, ["code_apporteur"], unique=True)
