"""The row every system delivers: contract x support, 16 flow measures, two positions."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Names and order of the canonical row.
DESCRIPTORS_BEFORE = (
    "NUMERO_CONTRAT", "CODE_PRODUIT", "NOM_PRODUIT", "SITUATION_CLOTURE", "DATE_EFFET", "DATE_TERME", "DT_VL_FIN",
    "CODE_ISIN", "NOM_SUPPORT", "SUPPORT_SPECIFIQUE", "CODE_UT", "TYPE_SUPPORT", "TYPE_GESTION", "PROFIL_GESTION",
)
FLOW_MEASURES = (
    "Collecte_Brute_TOTALE", "Versement_Initial", "Versement_Complementaire", "Prelevement_Automatique",
    "Transfert_Entrant", "Prestation_TOTALE", "Rachat", "Sinistre", "Echu", "Transfert_Sortant", "Arbitrage_Entrant",
    "Arbitrage_Entrant_RAG", "Arbitrage_Entrant_Client", "Arbitrage_Sortant", "Arbitrage_Sortant_RAG",
    "Arbitrage_Sortant_Client",
)
POSITION_MEASURES = ("PM_DEBUT", "PM_FIN")
DESCRIPTORS_AFTER = (
    "CODE_PORTEFEUILLE", "UJ", "NUMERO_CLIENT", "TYPE_PRSN", "SYSTEME", "SEGMENT", "TOP_RETRAITE", "LB_CANAL",
)
MEASURES = (*FLOW_MEASURES, *POSITION_MEASURES)
COLUMNS = (*DESCRIPTORS_BEFORE, *MEASURES, *DESCRIPTORS_AFTER)
DATES = ("DATE_EFFET", "DATE_TERME", "DT_VL_FIN")
ACTIVITY = ("Collecte_Brute_TOTALE", "Prestation_TOTALE", "Arbitrage_Entrant", "Arbitrage_Sortant", *POSITION_MEASURES)

AMOUNT = "decimal(28,2)"


def canonical(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The canonical columns in order and with fixed types; ``extra`` measures follow."""
    def typed(name: str) -> str:
        if name in MEASURES or name in extra:
            return f"CAST({name} AS {AMOUNT}) AS {name}"
        return f"CAST({name} AS {'DATE' if name in DATES else 'STRING'}) AS {name}"

    return df.selectExpr(*[typed(c) for c in (*COLUMNS, *extra)])
