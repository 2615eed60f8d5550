"""Dimensions shared by the systems: segments, network, clients."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import coalesced_name, filled, pad_code, repaired_contract
from ..operators.dedupe import one_per_key
from . import rulebook as rb


def segments(table: DataFrame) -> DataFrame:
    """Segment per product x support code, one row per pair."""
    coded = table.select(
        pad_code("CODE_UV", 5, numeric_only=True).alias("CODE_PRODUIT"),
        pad_code("CODE_UT", 5, numeric_only=True).alias("CODE_UT"),
        F.initcap("SEGMENT").alias("SEGMENT"),
    )
    return one_per_key(coded, ["CODE_PRODUIT", "CODE_UT"], ["SEGMENT"])


def network(table: DataFrame, banking_partner: str | None = None, prefix: str = "") -> DataFrame:
    """Distribution network by portfolio.  ``prefix`` is stripped from the source columns.

    Codes are padded before the duplicates go, so that two spellings of one portfolio
    cannot both stay.  ``banking_partner`` is the id part of the portfolio that is always
    shown under the banking channel.
    """
    bare = table.select(*[F.col(c).alias(c.removeprefix(prefix)) for c in table.columns])
    partner = F.col("ID").contains(banking_partner) if banking_partner else F.lit(False)
    shown = bare.select(
        pad_code("ID", 10).alias("CODE_PORTEFEUILLE"),
        F.col("CD_AGENCE").alias("CODE_AGENCE"),
        F.coalesce("INTITULE", "LIB_NAT_GESTION_1").alias("LIBELLE_COMMERCIAL"),
        F.col("CD_CIRCO_PP_1").alias("CODE_CIRCONSCRIPTION"),
        F.col("CD_INSPE_PP_1").alias("CODE_DELEGATION"),
        F.col("LIB_LONG_INSP_PP_1").alias("DELEGATION"),
        F.col("CD_REGION_PP_1").alias("CODE_REGION"),
        rb.region_override("LIB_CANAL", "CD_INSPE_PP_1", "LIB_LONG_REG_PP_1").column().alias("REGION"),
        F.col("ID_DISTR_1").alias("CODE_GESTIONNAIRE"),
        F.when(partner, "033").otherwise(F.col("CANAL")).alias("CANAL_RDU_PRINCIPAL"),
        F.col("CD_RESEAU"),
        F.col("CD_REGROUP").alias("CD_REGROUPEMENT"),
        F.when(partner, "PARTENAIRE BANCAIRE").otherwise(F.col("LIB_CANAL")).alias("LIB_CANAL"),
    )
    return one_per_key(shown, ["CODE_PORTEFEUILLE"], ["CODE_AGENCE", "LIBELLE_COMMERCIAL", "CANAL_RDU_PRINCIPAL"])


REPAIRED_CHANNELS = ("010", "011", "012", "013", "014", "036")


def clients(table: DataFrame, contracts: DataFrame, repaired_channels: Sequence[str] = REPAIRED_CHANNELS) -> DataFrame:
    """Client data by contract, one row per contract."""
    client = table.select(
        pad_code("NMCLI", 10).alias("NUMERO_CLIENT_2"),
        F.col("NMPERS").alias("NUMERO_ABONNE"),
        F.col("CDQUALIT").alias("CIVILITE"),
        coalesced_name(["NOM", "PRENOM"], "RAISON_SOCIALE").alias("NOM_PRENOM_SOUSCRIPTEUR"),
        F.col("DTNAISCL").alias("DATE_NAISSANCE"),
        "ADRESSE", "CODE_POSTAL", "VILLE", "PAYS", "EMAIL",
        F.col("CSP_BRUTE").alias("CODE_CSP"),
        "SEGPAT", "SOUS_SEGPAT", "CIVILITE_PM", "TYPE",
    )
    single = one_per_key(client, ["NUMERO_CLIENT_2"], ["NUMERO_ABONNE", "NOM_PRENOM_SOUSCRIPTEUR"])
    repaired = filled(
        F.col("CANAL_DISTRIBUTION").isin(*repaired_channels) & (F.col("ITFAMPRO") == "EPA"), False)
    contract = contracts.select(
        pad_code("NMCLI", 10).alias("NUMERO_CLIENT_2"),
        repaired_contract(pad_code("NMCNT", 16), repaired).alias("NUMERO_CONTRAT"),
        "CANAL_DISTRIBUTION", "ITFAMPRO", "ITFAMRIS", "CDCATPR",
    )
    joined = single.join(contract, ["NUMERO_CLIENT_2"], "left")
    return one_per_key(joined, ["NUMERO_CONTRAT"], ["NUMERO_CLIENT_2", "CDCATPR"])


def holder_names_2(persons: DataFrame) -> DataFrame:
    """Display name of a person of system 2: name and first name, or the quality where there is no name (companies)."""
    named = F.concat_ws(" ", "NOM", "PRENOM")
    return persons.withColumn("NOM_PRENOM_SOUSCRIPTEUR", F.when(F.col("NOM").isNull(), F.col("QUALITE")).otherwise(named))


def holder_names_3(persons: DataFrame) -> DataFrame:
    """Title and display name of a person of system 3; a company has its legal form for a title."""
    return persons.withColumns({"CIVILITE": rb.TITLE_3.column(), "NOM_PRENOM_SOUSCRIPTEUR": F.concat_ws(" ", "NOM_CLIENT", "PRENOM_CLIENT")})
