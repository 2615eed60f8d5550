"""Campaign-fund history: every reporting month of system 1 in one job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import Period
from ..functions.codes import filled
from ..operators.backfill import histories, reported_months
from ..operators.dedupe import null_safe_join
from ..operators.joins import lookup
from ..operators.positions import activity_total
from ..session import computed_once
from . import rulebook as rb
from .canonical import ACTIVITY
from .system1 import FEES, FREE, KEYS, contracts, movements


def ledger_by_month(tables: Mapping[str, DataFrame], first: Period, last: Period, activity: str = "signed") -> DataFrame:
    """The system-1 ledger of each reporting month, without contracts inactive in that month.

    Stored is one row per key with its history; the months in which a contract is active are joined to those rows, and the
    ledger's rows come from them last, so nothing stored or shuffled grows with the number of reporting months.
    """
    detail = tables["movement_detail"].filter(F.col("DT_INVEST").between(F.lit(first.start), F.lit(last.end)))
    classified = movements(detail, tables["movement_header"]).withColumns(rb.SYSTEM1_BUCKETS.columns())
    valued = tables["positions"].withColumn("CD_OG", filled("CD_OG", FREE))
    buckets = rb.SYSTEM1_BUCKETS.buckets
    history = computed_once(histories(classified, "DT_INVEST", buckets, valued, "DT_POSITION", "PM", KEYS, first, last), "ledger-keys")

    def months(rows: DataFrame, *more: str) -> DataFrame:
        return rb.SYSTEM1_BUCKETS.derive(reported_months(rows, buckets, (*KEYS, *more), first, last))

    total = F.expr(f"sum({activity_total((*ACTIVITY, *FEES), activity)}) AS __total")
    active = months(history).groupBy("period", "ID_CONTRAT").agg(total).filter("__total <> 0").groupBy("ID_CONTRAT").agg(
        F.collect_list("period").alias("__active"))
    kept = null_safe_join(history, active, ["ID_CONTRAT"], "inner")
    return months(kept, "__active").filter(F.array_contains("__active", F.col("period"))).drop("__active")


def campaign_history(
    tables: Mapping[str, DataFrame],
    network: DataFrame,
    funds: Mapping[str, str],
    first: Period,
    last: Period,
    activity: str = "signed",
) -> DataFrame:
    """Gross inflow of the campaign funds by reporting month, network and fund.

    Movements and positions are cut to contracts that ever moved or held a campaign fund before the ledger is built; all
    funds of those stay, as the activity test is per contract.  A missing contract is a contract like any other.  The ledger is cut to the campaign funds and summed
    per contract before the contract and network lookups.
    """
    names = ("movement_detail", "positions")
    moved, held = (tables[name].filter(F.col("CD_FUND").isin(*funds)).select(F.col("ID_CONTRAT").alias("_holder")) for name in names)
    holders = moved.union(held).distinct()
    cut = {name: tables[name].join(holders, F.col("ID_CONTRAT").eqNullSafe(F.col("_holder")), "left_semi") for name in names}
    months = ledger_by_month({**tables, **cut}, first, last, activity)
    inflow = (
        months.filter(F.col("CD_FUND").isin(*funds))
        .groupBy("period", "ID_CONTRAT", F.col("CD_FUND").alias("CODE_ISIN"))
        .agg(F.sum("Collecte_Brute_TOTALE").alias("Collecte_Brute_TOTALE"))
    )
    known = contracts(tables).select("ID_CONTRAT", "CODE_PORTEFEUILLE")
    channelled = lookup(
        lookup(inflow, known, ["ID_CONTRAT"], unique=True), network, ["CODE_PORTEFEUILLE"], ["CANAL_RDU_PRINCIPAL"], unique=True)
    return channelled.groupBy(
        F.year("period").alias("annee"),
        F.month("period").alias("mois"),
        rb.CAMPAIGN_NETWORK.column().alias("reseau"),
        rb.campaign_fund(funds).column().alias("fonds_campagne"),
    ).agg(F.sum("Collecte_Brute_TOTALE").alias("Collecte_Brute"))
