"""Reports answered from one month of the stored base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import Period, contract_age
from ..operators.dedupe import null_safe_join, one_per_key
from ..operators.flows import net_inflow, new_contract, status_count
from ..operators.positions import stacked_sum
from ..operators.rules import relabel
from . import rulebook as rb
from .canonical import FLOW_MEASURES

MARKET_KEYS = ("CANAL", "RESEAU", "SEG", "NOM_PRODUIT", "TOP_RETRAITE", "TYPE_SUPPORT", "SYSTEME", "TYPE_SUPPORT_2")
MARKET_MEASURES = (*FLOW_MEASURES[:10], "PM_FIN", "Collecte_Nette", "TOP_AN")


def product_supports(df: DataFrame) -> DataFrame:
    """Support types sold under each product, attached to each row.

    The set is an aggregate per product joined back: a product may hold a third of all
    rows, and its set has as many members as there are support types.
    """
    sets = df.groupBy("NOM_PRODUIT").agg(F.array_sort(F.collect_set("TYPE_SUPPORT")).alias("valeurs_uniques"))
    return null_safe_join(df, sets, ["NOM_PRODUIT"], "left")


def market_rows(base: DataFrame, period: Period, names: rb.Names = rb.DEFAULT_NAMES) -> DataFrame:
    """Base rows with client segment, net inflow, ages and product kind."""
    staged = relabel(base, rb.client_segment_stages(names)).withColumns({
        "age_client": F.lit(period.year) - F.year("DATE_NAISSANCE"),
        "TOP_AN": new_contract("DATE_EFFET", period.year, "CNT"),
        "ANCIENNETE_CONTRAT": contract_age(F.col("DATE_EFFET"), F.lit(period.year)),
        "Collecte_Nette": net_inflow("Collecte_Brute_TOTALE", "Prestation_TOTALE", "Arbitrage_Entrant", "Arbitrage_Sortant"),
    })
    return product_supports(staged).withColumn("TYPE_SUPPORT_2", rb.MONO_MULTI.column())


def market_report(base: DataFrame, period: Period, names: rb.Names = rb.DEFAULT_NAMES) -> DataFrame:
    """Flows, reserves, new contracts and clients by channel, network, segment and product.

    Each client counts once, in its best segment: the counted row is chosen per client and
    its group gets the client, so no window spans the whole month.
    """
    rows = market_rows(base, period, names)
    chosen = one_per_key(
        rows.filter(F.col("NUMERO_ABONNE").isNotNull()).select("NUMERO_ABONNE", "CLIENT_ORDER", *MARKET_KEYS),
        ["NUMERO_ABONNE"], ["CLIENT_ORDER", *MARKET_KEYS],
    )
    clients = chosen.select(*MARKET_KEYS, F.lit(1).alias("NB_CLIENT"))
    return stacked_sum([rows.select(*MARKET_KEYS, *MARKET_MEASURES), clients], MARKET_KEYS, [*MARKET_MEASURES, "NB_CLIENT"])


def finance_rows(base: DataFrame, period: Period, names: rb.Names = rb.DEFAULT_NAMES, forced_portfolios: Sequence[str] = ()) -> DataFrame:
    """Base rows with the labels of the finance extracts."""
    staged = relabel(base, rb.finance_stages(names, forced_portfolios))
    return staged.withColumn("TOP_AN", new_contract("DATE_EFFET", period.year, "CNT"))


def _finance_sums(counter: Column) -> list[Column]:
    totals = {
        "CA": "Collecte_Brute_TOTALE", "Prestations": "Prestation_TOTALE", "PM_début": "PM_DEBUT", "PM_fin": "PM_FIN",
        "Arbitrages_entrée": "Arbitrage_Entrant", "Arbitrages_sortie": "Arbitrage_Sortant",
    }
    return [*[F.sum(c).alias(n) for n, c in totals.items()], counter.alias("cnt"), F.sum("TOP_AN").alias("an")]


def finance_by_channel(rows: DataFrame) -> DataFrame:
    """Extract 1: wealth and third-party channels."""
    kept = rows.filter(F.col("Canal_distrib").isin(*rb.FINANCE_CHANNELS))
    keys = ["SYSTEME", "UJ", "Canal_distrib", "reseau_rang", F.col("TYPE_SUPPORT").alias("support"), "qualite"]
    return kept.groupBy(*keys).agg(*_finance_sums(F.sum("CNT")))


def finance_by_product(rows: DataFrame, products: Sequence[str] = rb.FINANCE_PRODUCTS) -> DataFrame:
    """Extract 2: reserves of a few products."""
    return rows.filter(F.col("CODE_PRODUIT").isin(*products)).groupBy("TYPE_SUPPORT", "SYSTEME").agg(F.sum("PM_FIN").alias("PM_FIN"))


def finance_by_status(rows: DataFrame) -> DataFrame:
    """Extract 3: contracts counted only with a listed status or some inflow.

    The status stays visible: it is a grouping column.
    """
    counter = status_count("CNT", "SITUATION_CLOTURE", rb.COUNTED_STATUSES, "Collecte_Brute_TOTALE")
    return rows.groupBy("SYSTEME", "UJ", "Canal_distrib", "reseau_rang", "SITUATION_CLOTURE").agg(*_finance_sums(counter))


def portfolio_cut(base: DataFrame, portfolios: Sequence[str]) -> DataFrame:
    """Flows and reserves of the given portfolios."""
    return (
        base.filter(F.col("CODE_PORTEFEUILLE").isin(*portfolios))
        .groupBy("TOP_ONE", "CODE_PORTEFEUILLE", "TYPE_SUPPORT", "APPORTEUR", "SYSTEME")
        .agg(*[F.sum(c).alias(c) for c in ("Collecte_Brute_TOTALE", "Prestation_TOTALE", "Arbitrage_Entrant", "Arbitrage_Sortant", "PM_FIN")])
    )
