"""SQL counterparts of the system plans and the monthly base, for June 1998.

Short names: vi vc pa te (inflows), rt sin ec ts (outflows), ae aer sa sar (switches in and
out, and their automatic part), pd pf (opening and closing value).
"""

from __future__ import annotations

from . import standins as st

FLOWS = ("vi", "vc", "pa", "te", "rt", "sin", "ec", "ts", "ae", "aer", "sa", "sar")
ALL = (*FLOWS, "pd", "pf")
ACTIVE = "vi + vc + pa + te + rt + sin + ec + ts + ae + sa + pd + pf"
DEC = "DECIMAL(28,2)"


def measures() -> str:
    named = {
        "Collecte_Brute_TOTALE": "vi + vc + pa + te", "Versement_Initial": "vi", "Versement_Complementaire": "vc", "Prelevement_Automatique": "pa",
        "Transfert_Entrant": "te", "Prestation_TOTALE": "rt + sin + ec + ts", "Rachat": "rt", "Sinistre": "sin", "Echu": "ec", "Transfert_Sortant": "ts",
        "Arbitrage_Entrant": "ae", "Arbitrage_Entrant_RAG": "aer", "Arbitrage_Entrant_Client": "ae - aer",
        "Arbitrage_Sortant": "sa", "Arbitrage_Sortant_RAG": "sar", "Arbitrage_Sortant_Client": "sa - sar", "PM_DEBUT": "pd", "PM_FIN": "pf",
    }
    return ", ".join(f'CAST({e} AS {DEC}) AS "{n}"' for n, e in named.items())


def padded(code: str) -> str:
    return f"CASE WHEN TRY_CAST({code} AS DOUBLE) > 0 THEN lpad({code}, 5, '0') ELSE {code} END"


def total(names, extra=()) -> str:
    return ", ".join(f"SUM(COALESCE({n}, 0)) AS {n}" for n in (*names, *extra))


SEGMENTS = f"""seg AS (SELECT {padded('CODE_UV')} AS sp, {padded('CODE_UT')} AS su, upper(SEGMENT[1]) || SEGMENT[2:] AS segment FROM ({st.SEGMENTS.sql()}))"""

K1 = "ID_CONTRAT, CD_FUND, CD_SUPPORT, CD_PACK, CD_OG"


def _label(label: str, more: str = "") -> str:
    return f"SUM(CASE WHEN LB_TYPE_FLUX = '{label}'{more} THEN MT_BRUT ELSE 0 END)"


S1 = f"""
{st.ctes(st.SYSTEM1, 's1')},
s1_mv AS (SELECT d.* REPLACE (COALESCE(CD_OG, 'libre') AS CD_OG), LB_TYPE_MVT FROM s1_movement_detail d JOIN s1_movement_header USING (ID_CONTRAT, ID_MVT)
  WHERE LB_STATUT = 'Soldé' AND DT_INVEST BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'),
s1_f AS (SELECT {K1}, {_label('Prime comptant')} AS vi, {_label('Versement libre')} AS vc, {_label('Versement libre programmé')} AS pa,
  {_label('Transfert interne entrant')} AS te, {_label('Rachat partiel')} AS rt,
  {_label('Paiement dossier sinistre', " AND LB_TYPE_MVT <> 'Désinvestissement échu'")} AS sin,
  {_label('Paiement dossier sinistre', " AND LB_TYPE_MVT = 'Désinvestissement échu'")} AS ec, {_label('Transfert interne sortant')} AS ts,
  {_label('Arbitrage achat')} AS ae, {_label('Arbitrage achat', " AND LB_TYPE_MVT = 'RAG'")} AS aer,
  {_label('Arbitrage vente')} AS sa, {_label('Arbitrage vente', " AND LB_TYPE_MVT = 'RAG'")} AS sar,
  {_label('Frais de gestion')} AS fg, {_label('Frais sur investissement')} AS fa FROM s1_mv GROUP BY {K1}),
s1_p AS (SELECT * REPLACE (COALESCE(CD_OG, 'libre') AS CD_OG) FROM s1_positions),
s1_po AS (SELECT {K1}, SUM(PM) AS pd FROM (SELECT *, MAX(DT_POSITION) OVER (PARTITION BY {K1}) AS newest FROM s1_p WHERE DT_POSITION <= DATE '1997-12-31')
  WHERE DT_POSITION = newest GROUP BY {K1}),
s1_pc AS (SELECT {K1}, SUM(PM) AS pf, MAX(DT_POSITION) AS dt FROM (SELECT *, MAX(DT_POSITION) OVER (PARTITION BY {K1}) AS newest FROM s1_p WHERE DT_POSITION <= DATE '1998-06-30')
  WHERE DT_POSITION = newest GROUP BY {K1}),
s1_g AS (SELECT {K1}, {total(ALL, ('fg', 'fa'))}, MAX(dt) AS dt FROM (SELECT * FROM s1_f UNION ALL BY NAME SELECT * FROM s1_po UNION ALL BY NAME SELECT * FROM s1_pc) GROUP BY {K1}),
s1_on AS (SELECT ID_CONTRAT FROM s1_g GROUP BY 1 HAVING SUM({ACTIVE} + fg + fa) <> 0),
s1_c AS (SELECT * FROM (SELECT *, 0 AS src FROM s1_contracts UNION ALL SELECT * REPLACE ('En erreur' AS LB_STATUS), 1 FROM s1_contracts_archive)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY ID_CONTRAT ORDER BY src) = 1),
s1_rows AS (SELECT lpad(g.ID_CONTRAT, 16, '0') AS "NUMERO_CONTRAT", {padded('c.CD_PROD')} AS "CODE_PRODUIT", pr.LB_PROD AS "NOM_PRODUIT", c.LB_STATUS AS "SITUATION_CLOTURE",
  c.DT_SOUSCRIPTION AS "DATE_EFFET", c.DT_CLOTURE AS "DATE_TERME", dt AS "DT_VL_FIN", g.CD_FUND AS "CODE_ISIN", s.NOM AS "NOM_SUPPORT",
  CASE WHEN g.CD_FUND IN ('FR0011129717', 'FR0013076031', 'FR0013466562', 'FR001400CZ43') THEN 'Oui' ELSE 'Non' END AS "SUPPORT_SPECIFIQUE",
  {padded('s.CD_INTERNE')} AS "CODE_UT", CASE s.LB_TYPE WHEN 'EUR' THEN 'EURO' WHEN 'EUC' THEN 'EUROCROISSANCE' ELSE s.LB_TYPE END AS "TYPE_SUPPORT",
  COALESCE(LB_PACK, CASE CD_PACK WHEN 'libre' THEN 'Gestion Libre' WHEN 'ucgcp' THEN 'Gestion Conseillée au Passif' WHEN 'uc' THEN 'GSM Collective' END) AS "TYPE_GESTION",
  COALESCE(LB_OG_AIA, 'Gestion Libre') AS "PROFIL_GESTION", {measures()},
  lpad(c.CD_PTF_RDU, 10, '0') AS "CODE_PORTEFEUILLE", c.CD_UJ AS "UJ", lpad(COALESCE(p.REFERENCE_CLIENT, ''), 10, '0') AS "NUMERO_CLIENT", p.TYPE_PRSN AS "TYPE_PRSN",
  'SYS1' AS "SYSTEME", COALESCE(seg.segment, 'Inconnu') AS "SEGMENT",
  CASE WHEN c.LB_CADRE_FISCAL IN ('per', 'madelin') THEN 'RETRAITE' WHEN c.ID_CONTRAT IS NOT NULL THEN 'EPARGNE' END AS "TOP_RETRAITE", LB_RESEAU AS "LB_CANAL"
  FROM s1_g g JOIN s1_on o ON o.ID_CONTRAT IS NOT DISTINCT FROM g.ID_CONTRAT LEFT JOIN s1_option_products USING (CD_OG) LEFT JOIN s1_option_packs USING (CD_OG)
  LEFT JOIN s1_supports s ON s.CD_FUND = g.CD_FUND LEFT JOIN s1_c c ON c.ID_CONTRAT = g.ID_CONTRAT LEFT JOIN s1_products pr ON pr.CD_PROD = c.CD_PROD
  LEFT JOIN (SELECT * FROM s1_persons WHERE LB_ROLE = 'Souscripteur') p ON p.ID_CONTRAT = g.ID_CONTRAT
  LEFT JOIN s1_distributors d ON lpad(d.CD_DISTRIBUTEUR, 10, '0') = lpad(c.CD_PTF_RDU, 10, '0')
  LEFT JOIN seg ON sp = {padded('c.CD_PROD')} AND su = {padded('s.CD_INTERNE')})
"""

K2 = "NUMERO_CONTRAT, CODE_UT, CODE_UC, CODE_ISIN, TYPE_SUPPORT, CODE_PROFIL, SUPPORT_SPECIFIQUE"
_S2_KEYED = """CASE WHEN TOP_EUROCROISSANCE = 'OUI' THEN 'EUROCROISSANCE' WHEN LIBELLE_TYPE_SUPPORT = 'FOND EUROS' THEN 'EURO' ELSE LIBELLE_TYPE_SUPPORT END AS TYPE_SUPPORT,
  CASE WHEN SUPPORT_CONVENTION = 'Oui' THEN 'Non' WHEN CODE_ISIN IN ('FR0011129717', 'FR0013076031', 'FR0013466562', 'FR001400CZ43') THEN 'Oui' ELSE 'Non' END AS SUPPORT_SPECIFIQUE"""


def _act(*codes: str) -> str:
    return f"CODE_ACTE_COURT IN ({', '.join(repr(c) for c in codes)})"


def _signed(plus: str, minus: str | None = None) -> str:
    second = f" WHEN {minus} THEN -x6" if minus else ""
    cents = f"SUM(CASE WHEN {plus} THEN x6{second} ELSE 0 END)"
    whole = f"(CASE WHEN {cents} < 0 THEN -1 ELSE 1 END) * ((abs({cents}) + 5000) // 10000)"
    return f"CAST(CAST({whole} AS DECIMAL(26,0)) * CAST(0.01 AS DECIMAL(4,2)) AS {DEC})"


_RAG = "COALESCE(LIBELLE_MOTIF_ACTE = 'RAG' OR LIBELLE_ACTE_COMPLEMENT = 'RAG', FALSE)"
S2 = f"""
{st.ctes(st.SYSTEM2, 's2')},
s2_pr AS (SELECT PROF_ID AS CODE_PROFIL, 'Profil ' || CVN_GES AS pg,
  CASE CVN_GES WHEN '1' THEN 'Gestion personnelle' WHEN '2' THEN 'Gestion évolutive' WHEN '3' THEN 'Gestion profilée' WHEN '4' THEN 'Gestion personnalisable' ELSE 'Non défini' END AS tg
  FROM s2_profiles),
s2_sf AS (SELECT * REPLACE (CASE WHEN CODE_PROFIL = '' THEN '01' ELSE CODE_PROFIL END AS CODE_PROFIL), {_S2_KEYED},
  CAST(round(NB_PART_SUPPORT_MVT * VL_SUPPORT, 2) AS DECIMAL(18,2)) AS net FROM s2_support_flows WHERE DATE_CREATION_ACTE BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'),
s2_tot AS (SELECT NUMERO_CONTRAT, NUMERO_ACTE, CODE_ACTE_COURT, CAST(SUM(net) * 100 AS HUGEINT) AS t FROM s2_sf GROUP BY ALL),
s2_tf AS (SELECT NUMERO_CONTRAT, MAX(CASE WHEN MOTIF_ENTREE IN ('A', 'F', 'S') THEN 1 ELSE 0 END) AS te, MAX(CASE WHEN MOTIF_SORTIE IN ('A', 'F', 'S') THEN 1 ELSE 0 END) AS ts
  FROM s2_contracts GROUP BY 1),
s2_m AS (SELECT sf.*, LIBELLE_MOTIF_ACTE, LIBELLE_ACTE_COMPLEMENT, te, ts,
    (2 * CAST(net * 100 AS HUGEINT) * CAST(MONTANT_CLIENT * 100 AS HUGEINT) * 10000 + t) // (2 * t) AS x6
  FROM s2_sf sf JOIN s2_tot USING (NUMERO_CONTRAT, NUMERO_ACTE, CODE_ACTE_COURT) JOIN s2_act_flows a USING (NUMERO_CONTRAT, NUMERO_ACTE, SENS_ACTE, CODE_ACTE_COURT)
  JOIN s2_tf USING (NUMERO_CONTRAT) WHERE sf.SENS_ACTE = 'Création'),
s2_f AS (SELECT {K2}, {_signed(_act('VI', 'CC') + ' AND te = 0', _act('RN', 'SE'))} AS vi, {_signed(_act('VC'))} AS vc,
  {_signed(_act('PA', 'QT', 'QH'), _act('AE', 'QR'))} AS pa, {_signed('(' + _act('VI', 'CC') + ' AND te = 1) OR ' + _act('TA', 'TE', 'VP', 'VT'))} AS te,
  {_signed(_act('RT', 'RP', 'RG') + ' AND ts = 0', _act('AP', 'AT', 'AX'))} AS rt, {_signed(_act('SI'))} AS sin, {_signed(_act('EX', 'RE'), _act('AH'))} AS ec,
  {_signed('(' + _act('RT', 'RP', 'RG') + ' AND ts = 1) OR ' + _act('TP', 'TT'), _act('AV', 'AQ'))} AS ts,
  {_signed(_act('EA') + ' AND ' + _RAG)} AS aer, {_signed(_act('EA') + ' AND NOT ' + _RAG)} AS aec,
  {_signed(_act('SA') + ' AND ' + _RAG)} AS sar, {_signed(_act('SA') + ' AND NOT ' + _RAG)} AS sac,
  {_signed(_act('FR'))} AS fr, {_signed(_act('PB'))} AS pb FROM s2_m GROUP BY {K2}),
s2_po AS (SELECT * REPLACE (CASE WHEN CODE_PROFIL = '' THEN '01' ELSE CODE_PROFIL END AS CODE_PROFIL), {_S2_KEYED} FROM s2_positions_opening),
s2_pc AS (SELECT * REPLACE (CASE WHEN CODE_PROFIL = '' THEN '01' ELSE CODE_PROFIL END AS CODE_PROFIL), {_S2_KEYED} FROM s2_positions_closing),
s2_g AS (SELECT {K2}, {total(ALL, ('fr', 'pb'))}, MAX(dt) AS dt, MAX(nom) AS nom FROM (
    SELECT * EXCLUDE (aec, sac), aer + aec AS ae, sar + sac AS sa FROM s2_f
    UNION ALL BY NAME SELECT {K2}, SUM(PM_SUPPORT) AS pd FROM s2_po GROUP BY {K2}
    UNION ALL BY NAME SELECT {K2}, SUM(PM_SUPPORT) AS pf, MAX(DATE_VALEUR_UC) AS dt, MAX(LIBELLE_SUPPORT) AS nom FROM s2_pc GROUP BY {K2}) GROUP BY {K2}),
s2_on AS (SELECT NUMERO_CONTRAT FROM s2_g GROUP BY 1 HAVING SUM({ACTIVE} + fr + pb) <> 0),
s2_rows AS (SELECT lpad(g.NUMERO_CONTRAT, 16, '0') AS "NUMERO_CONTRAT", {padded('c.CODE_UV')} AS "CODE_PRODUIT", split_part(c.NOM_PRODUIT, ' - ', 2) AS "NOM_PRODUIT",
  c.LIBELLE_ETAT_CONTRAT AS "SITUATION_CLOTURE", c.DATE_DEBUT_EFFET_CONTRAT AS "DATE_EFFET", c.DATE_FIN_EFFET_CONTRAT AS "DATE_TERME", dt AS "DT_VL_FIN", CODE_ISIN AS "CODE_ISIN",
  nom AS "NOM_SUPPORT", SUPPORT_SPECIFIQUE AS "SUPPORT_SPECIFIQUE", {padded('g.CODE_UT')} AS "CODE_UT", TYPE_SUPPORT AS "TYPE_SUPPORT", tg AS "TYPE_GESTION", pg AS "PROFIL_GESTION",
  {measures()}, lpad(c.IDENTIFIANT_PORTEFEUILLE, 10, '0') AS "CODE_PORTEFEUILLE", CASE WHEN contains(SOCIETE_ASSURANCE, 'MUTUELLE') THEN 'MU' ELSE 'SA' END AS "UJ",
  CASE WHEN ROLE_PERSONNE = 'Souscripteur' THEN lpad(IDENTIFIANT_PERSONNE, 10, '0') END AS "NUMERO_CLIENT",
  CASE WHEN ROLE_PERSONNE = 'Souscripteur' THEN CASE TYPE_PERSONNE WHEN 'Personne Physique' THEN 'PHY' WHEN 'modalité à traduire' THEN 'MOR' ELSE 'ND' END END AS "TYPE_PRSN",
  'SYS2' AS "SYSTEME", COALESCE(seg.segment, 'Inconnu') AS "SEGMENT", CASE WHEN FISCALITE = 'PER' THEN 'RETRAITE' ELSE 'EPARGNE' END AS "TOP_RETRAITE",
  COALESCE(CANAL_PORTEFEUILLE, RESEAU) AS "LB_CANAL"
  FROM s2_g g JOIN s2_on USING (NUMERO_CONTRAT) JOIN s2_contracts c USING (NUMERO_CONTRAT) JOIN s2_persons p USING (NUMERO_CONTRAT) LEFT JOIN s2_pr USING (CODE_PROFIL)
  LEFT JOIN seg ON sp = {padded('c.CODE_UV')} AND su = {padded('g.CODE_UT')}
  WHERE ROLE_PERSONNE = 'Souscripteur' OR NOT (vi + vc + pa + te = 0 AND rt + sin + ec + ts = 0 AND ae = 0 AND sa = 0 AND pd = 0 AND pf = 0))
"""

K3 = "NUMERO_CONTRAT, CODE_ISIN, CODE_SUPPORT, CODE_UT, CODE_UV, TYPE_SUPPORT"


def _s3_side(limit: str) -> str:
    return f"""(SELECT v.NUMERO_CONTRAT, v.CODE_ISIN, v.CODE_SUPPORT, v.CODE_UT, c.CODE_UV, k.ty AS TYPE_SUPPORT, v.MONTANT, v.DATE_VALORISATION, v.LIBELLE_SUPPORT FROM (
    SELECT *, DENSE_RANK() OVER (PARTITION BY NUMERO_CONTRAT, CODE_UT ORDER BY DATE_VALORISATION DESC) AS r FROM s3_v WHERE DATE_VALORISATION <= DATE '{limit}') v
  JOIN (SELECT NUMERO_CONTRAT FROM s3_contracts WHERE STATUT = 'En cours') USING (NUMERO_CONTRAT)
  LEFT JOIN s3_catalogue_products c ON c.CODE_SUPPORT = v.CODE_SUPPORT AND c.CODE_TYPE_CONTRAT = v.CODE_TYPE_CONTRAT AND c.CODE_UT = v.CODE_UT AND COALESCE(c.CODE_ISIN, 'ND') = v.CODE_ISIN
  LEFT JOIN s3_k k ON k.CODE_SUPPORT = v.CODE_SUPPORT WHERE r = 1)"""


_NATURE = "CASE LIBELLE_NATURE_SUPPORT WHEN 'Capitaux' THEN 'EURO' WHEN 'Part' THEN 'UC' ELSE 'EUROCROISSANCE' END"


def _typed(*types: str) -> str:
    return f"SUM(CASE WHEN ty IN ({', '.join(repr(t) for t in types)}) THEN a ELSE 0 END)"


S3 = f"""
{st.ctes(st.SYSTEM3, 's3')},
s3_k AS (SELECT CODE_SUPPORT, {_NATURE} AS ty FROM s3_catalogue_supports),
s3_v AS (SELECT DISTINCT NUMERO_CONTRAT, COALESCE(CODE_ISIN, 'ND') AS CODE_ISIN, CODE_SUPPORT, CODE_UT, LIBELLE_SUPPORT, CODE_TYPE_CONTRAT, MONTANT, DATE_VALORISATION
  FROM s3_valuations WHERE LIBELLE_TYPE_MONTANT LIKE 'Montant%'),
s3_det AS (SELECT * FROM s3_operation_detail QUALIFY ROW_NUMBER() OVER (PARTITION BY NUMERO_ADHESION, NUMERO_OPERATION, CODE_ISIN, LIBELLE_SUPPORT, CATEGORIE_TYPE_MONTANT
  ORDER BY NUMERO_CONTRAT, CODE_SUPPORT, CODE_UT, DETAIL_TRANSACTION, MONTANT, CODE_CONVENTION_GESTION) = 1),
s3_m AS (SELECT d.* REPLACE (COALESCE(d.CODE_ISIN, 'ND') AS CODE_ISIN), {_NATURE} AS TYPE_SUPPORT, o.CODE_UV, o.LIBELLE_PAIEMENT FROM s3_operations o
  LEFT JOIN s3_det d USING (NUMERO_CONTRAT, NUMERO_OPERATION, NUMERO_ADHESION) WHERE DATE_JOURNALIER BETWEEN DATE '1997-12-26' AND DATE '1998-06-25'),
s3_t AS (SELECT *, CASE WHEN LIBELLE_TYPE_TRANSACTION = 'VERSEMENT' THEN CASE WHEN DETAIL_TRANSACTION = 'Versement initial' THEN 'VI'
      WHEN DETAIL_TRANSACTION = 'Versement transfert' THEN 'TE' WHEN LIBELLE_PAIEMENT = 'PRELEVEMENT' THEN 'PA' ELSE 'VC' END
    WHEN LIBELLE_TYPE_TRANSACTION LIKE 'RACHAT%' THEN CASE WHEN DETAIL_TRANSACTION IN ('Rachat partiel', 'Rachat total') THEN 'RT' WHEN contains(DETAIL_TRANSACTION, 'décès') THEN 'SI'
      WHEN DETAIL_TRANSACTION = 'Conversion en rente' THEN 'EC' WHEN contains(DETAIL_TRANSACTION, 'Transfert') THEN 'TS' ELSE 'AR' END
    WHEN contains(DETAIL_TRANSACTION, 'Annulation :') = (MONTANT < 0) THEN 'AE' ELSE 'AS' END AS ty FROM s3_m),
s3_a AS (SELECT *, CASE WHEN ty IN ('AE', 'AS') AND CATEGORIE_TYPE_MONTANT IN ('MONTANT_NET', 'FRAIS_ARBITRAGE') THEN MONTANT
    WHEN ty NOT IN ('AE', 'AS') AND CATEGORIE_TYPE_MONTANT = 'MONTANT_BRUT' THEN MONTANT ELSE 0 END AS a FROM s3_t),
s3_f AS (SELECT {K3}, {_typed('VI')} AS vi, {_typed('VC')} AS vc, {_typed('TE')} AS te, {_typed('PA')} AS pa, {_typed('RT', 'AR')} AS rt, {_typed('SI')} AS sin,
  {_typed('EC')} AS ec, {_typed('TS')} AS ts, {_typed('AE')} AS ae, -{_typed('AS')} AS sa,
  SUM(CASE WHEN ty = 'AE' AND (DETAIL_TRANSACTION = 'Ajustement annuel gratuit' AND a >= 0 OR DETAIL_TRANSACTION = 'Annulation : Ajustement annuel gratuit' AND a < 0) THEN a ELSE 0 END) AS aer,
  -SUM(CASE WHEN ty = 'AS' AND CATEGORIE_TYPE_MONTANT IN ('MONTANT_NET', 'FRAIS_ARBITRAGE') AND (DETAIL_TRANSACTION = 'Ajustement annuel gratuit' AND a < 0
     OR DETAIL_TRANSACTION = 'Annulation : Ajustement annuel gratuit' AND a >= 0) THEN a ELSE 0 END) AS sar,
  SUM(CASE WHEN MONTANT > 0 AND (LIBELLE_TYPE_TRANSACTION = 'VERSEMENT' AND CATEGORIE_TYPE_MONTANT = 'FRAIS_FIXES'
     OR LIBELLE_TYPE_TRANSACTION LIKE 'RACHAT%' AND CATEGORIE_TYPE_MONTANT = 'FRAIS_GESTION'
     OR LIBELLE_TYPE_TRANSACTION LIKE 'REORIENTATION%' AND CATEGORIE_TYPE_MONTANT = 'FRAIS_ARBITRAGE') THEN MONTANT ELSE 0 END) AS fees,
  MAX(LIBELLE_SUPPORT) AS nom FROM s3_a GROUP BY {K3}),
s3_fon AS (SELECT NUMERO_CONTRAT FROM s3_f GROUP BY 1 HAVING SUM(vi + vc + pa + te + rt + sin + ec + ts + ae + sa + fees) <> 0),
s3_g AS (SELECT {K3}, {total(ALL, ('fees',))}, MAX(dt) AS dt, MAX(nom) AS nom FROM (
    SELECT * FROM s3_f WHERE NUMERO_CONTRAT IN (SELECT NUMERO_CONTRAT FROM s3_fon)
    UNION ALL BY NAME SELECT {K3}, SUM(MONTANT) AS pd FROM {_s3_side('1997-12-31')} GROUP BY {K3}
    UNION ALL BY NAME SELECT {K3}, SUM(MONTANT) AS pf, MAX(DATE_VALORISATION) AS dt, MAX(LIBELLE_SUPPORT) AS nom FROM {_s3_side('1998-06-30')} GROUP BY {K3}) GROUP BY {K3}),
s3_on AS (SELECT NUMERO_CONTRAT FROM s3_g GROUP BY 1 HAVING SUM({ACTIVE} + fees) <> 0),
s3_rows AS (SELECT lpad(g.NUMERO_CONTRAT, 16, '0') AS "NUMERO_CONTRAT", {padded('g.CODE_UV')} AS "CODE_PRODUIT", c.LIBELLE_PRODUIT AS "NOM_PRODUIT", STATUT AS "SITUATION_CLOTURE",
  DATE_DEBUT_EFFET_CONTRAT AS "DATE_EFFET", DATE_ANNULATION AS "DATE_TERME", COALESCE(dt, DATE '1998-06-30') AS "DT_VL_FIN", CODE_ISIN AS "CODE_ISIN", nom AS "NOM_SUPPORT",
  CASE WHEN CODE_ISIN IN ('FR0011129717', 'FR0013076031', 'FR0013466562') THEN 'Oui' ELSE 'Non' END AS "SUPPORT_SPECIFIQUE", {padded('g.CODE_UT')} AS "CODE_UT",
  TYPE_SUPPORT AS "TYPE_SUPPORT", LIBELLE_CONVENTION_GESTION AS "TYPE_GESTION", LIBELLE_PROFIL_FORMULE_GESTION AS "PROFIL_GESTION", {measures()},
  lpad(CODE_PORTEFEUILLE, 10, '0') AS "CODE_PORTEFEUILLE",
  CASE LIBELLE_ENTITE_JURIDIQUE WHEN 'HOUSE France Vie' THEN 'SA' WHEN 'HOUSE Assurances Vie Mutuelle' THEN 'MU' ELSE 'ND' END AS "UJ", NUMERO_PERSONNE AS "NUMERO_CLIENT",
  CASE WHEN LIBELLE_TYPE_PERSONNE = 'Personne physique' THEN 'PHY' ELSE 'MOR' END AS "TYPE_PRSN", 'SYS3' AS "SYSTEME", 'SYS3' AS "SEGMENT",
  CASE WHEN LIBELLE_TYPE_CONTRAT = 'FAR' THEN 'RETRAITE' ELSE 'EPARGNE' END AS "TOP_RETRAITE", COALESCE(CANAL_PORTEFEUILLE, 'ND') AS "LB_CANAL"
  FROM s3_g g JOIN s3_on USING (NUMERO_CONTRAT) JOIN s3_contracts c USING (NUMERO_CONTRAT) JOIN s3_persons USING (NUMERO_CONTRAT)
  LEFT JOIN s3_conventions v ON v.CODE_CONVENTION_GESTION = c.CODE_CONVENTION_GESTION)
"""

CANONICAL_MEASURES = (
    "Collecte_Brute_TOTALE", "Versement_Initial", "Versement_Complementaire", "Prelevement_Automatique", "Transfert_Entrant", "Prestation_TOTALE", "Rachat",
    "Sinistre", "Echu", "Transfert_Sortant", "Arbitrage_Entrant", "Arbitrage_Entrant_RAG", "Arbitrage_Entrant_Client", "Arbitrage_Sortant",
    "Arbitrage_Sortant_RAG", "Arbitrage_Sortant_Client", "PM_DEBUT", "PM_FIN",
)


def as_double(names) -> str:
    return ", ".join(f'CAST("{n}" AS DOUBLE) AS "{n}"' for n in names)


def system_sql(number: int, body: str) -> str:
    return f"WITH {SEGMENTS}, {body} SELECT * REPLACE ({as_double(CANONICAL_MEASURES)}) FROM s{number}_rows"


NETWORK_ROWS = f"""
nw AS (SELECT lpad(ID, 10, '0') AS "CODE_PORTEFEUILLE", CD_AGENCE AS "CODE_AGENCE", COALESCE(INTITULE, LIB_NAT_GESTION_1) AS "LIBELLE_COMMERCIAL", CD_CIRCO_PP_1 AS "CODE_CIRCONSCRIPTION",
  CD_INSPE_PP_1 AS "CODE_DELEGATION", LIB_LONG_INSP_PP_1 AS "DELEGATION", CD_REGION_PP_1 AS "CODE_REGION",
  CASE WHEN LIB_CANAL = 'A2P' THEN CASE CD_INSPE_PP_1 WHEN '15299' THEN 'ILE DE FRANCE' WHEN '46361' THEN 'OUEST' WHEN '15500' THEN 'NORD-EST' ELSE LIB_LONG_REG_PP_1 END
    ELSE LIB_LONG_REG_PP_1 END AS "REGION", ID_DISTR_1 AS "CODE_GESTIONNAIRE", CASE WHEN contains(ID, '17') THEN '033' ELSE CANAL END AS "CANAL_RDU_PRINCIPAL",
  CD_RESEAU AS "CD_RESEAU", CD_REGROUP AS "CD_REGROUPEMENT", CASE WHEN contains(ID, '17') THEN 'PARTENAIRE BANCAIRE' ELSE LIB_CANAL END AS "LIB_CANAL" FROM ({st.NETWORK.sql()}))
"""
CLIENT_ROWS = f"""
cl AS (SELECT lpad(c.NMCLI, 10, '0') AS "NUMERO_CLIENT_2", NMPERS AS "NUMERO_ABONNE", CDQUALIT AS "CIVILITE", COALESCE(NOM, RAISON_SOCIALE) AS "NOM_PRENOM_SOUSCRIPTEUR",
  DTNAISCL AS "DATE_NAISSANCE", ADRESSE AS "ADRESSE", CODE_POSTAL AS "CODE_POSTAL", VILLE AS "VILLE", PAYS AS "PAYS", EMAIL AS "EMAIL", CSP_BRUTE AS "CODE_CSP", SEGPAT AS "SEGPAT",
  SOUS_SEGPAT AS "SOUS_SEGPAT", CIVILITE_PM AS "CIVILITE_PM", TYPE AS "TYPE",
  CASE WHEN substr(lpad(NMCNT, 16, '0'), 15, 2) = '92' THEN lpad(substr(lpad(NMCNT, 16, '0'), 1, 14), 16, '0') ELSE lpad(NMCNT, 16, '0') END AS "NUMERO_CONTRAT",
  CANAL_DISTRIBUTION AS "CANAL_DISTRIBUTION", ITFAMPRO AS "ITFAMPRO", ITFAMRIS AS "ITFAMRIS", CDCATPR AS "CDCATPR"
  FROM ({st.CLIENTS.sql()}) c LEFT JOIN ({st.CLIENT_CONTRACTS.sql()}) k ON k.NMCLI = c.NMCLI
  QUALIFY ROW_NUMBER() OVER (PARTITION BY "NUMERO_CONTRAT" ORDER BY "NUMERO_CLIENT_2") = 1)
"""

CHANNELS = ("PHONE ASSUR", "AGA", "A2P", "A2P", "AEP", "AEP", "PROTECTION JURIDIQUE", "COURTIER MSC", "DELEGUE MSC", "COURTIER A", "COURTIER B", "COURTIER C", "ASTRAL", "CII2",
            "COURTIERS GENERALISTES", "HOUSE PARTENAIRE", "HOUSE PARTENAIRE", "HOUSE PARTENAIRE", "DIVERS HOUSE", "COURTIERS GENERALISTES", "PTF DE FORMATION",
            "COURTIERS GENERALISTES", "COURTIERS GENERALISTES", "COURTIERS GENERALISTES", "PARTENAIRE BANCAIRE")
_CHANNEL_VALUES = ", ".join(f"('{n:03d}', '{name}')" for n, name in enumerate(CHANNELS, 9))

BASE_KEYS = (
    "NUMERO_CONTRAT", "CODE_PRODUIT", "NOM_PRODUIT", "SITUATION_CLOTURE", "DATE_EFFET", "DATE_TERME", "DT_VL_FIN", "CODE_ISIN", "NOM_SUPPORT", "SUPPORT_SPECIFIQUE", "CODE_UT",
    "TYPE_SUPPORT", "TYPE_GESTION", "PROFIL_GESTION", "TYPE_UC", "CODE_PORTEFEUILLE", "NUMERO_CLIENT", "NUMERO_ABONNE", "UJ", "TYPE_PRSN", "CIVILITE",
    "NOM_PRENOM_SOUSCRIPTEUR", "DATE_NAISSANCE", "CODE_CSP", "ADRESSE", "CODE_POSTAL", "VILLE", "PAYS", "EMAIL", "LIBELLE_COMMERCIAL", "LIBELLE_COMMERCIAL_CRM", "APPORTEUR",
    "CODE_DELEGATION", "DELEGATION", "CODE_REGION", "REGION", "CODE_GESTIONNAIRE", "CANAL_RDU_PRINCIPAL", "CANAL", "RESEAU", "SEGPAT", "SOUS_SEGPAT", "CIVILITE_PM", "NATURE_PMO",
    "TOP_ONE", "SEGMENT", "SEGMENTATION", "TOP_TMGA", "TOP_PORTEFEUILLE", "TOP_RETRAITE", "SYSTEME",
)
_ORDER = (
    "CODE_ISIN", "CODE_UT", "SYSTEME", "CODE_PRODUIT", "NOM_PRODUIT", "SITUATION_CLOTURE", "DATE_EFFET", "DATE_TERME", "DT_VL_FIN", "NOM_SUPPORT", "SUPPORT_SPECIFIQUE",
    "TYPE_SUPPORT", "TYPE_GESTION", "PROFIL_GESTION", "CODE_PORTEFEUILLE", "UJ",
)
_SPLITS = {f"Arbitrage_{d}_{t}": (f"Arbitrage_{d}", t) for d in ("Entrant", "Sortant") for t in ("UC", "EURO", "EUROCROISSANCE")}
BASE_MEASURES = (*CANONICAL_MEASURES, *_SPLITS)
_OWN = "net IN ('A2P', 'AGA', 'GESTION PRIVEE DIRECTE') AND one = 1"
_PARTNER = "net IN ('COURTIERS GENERALISTES', 'CGPI', 'PARTENAIRE BANCAIRE', 'PARTENAIRE DISTRIBUTION') AND one = 1"
_Q = ", ".join(f'"{k}"' for k in BASE_KEYS)

BASE = f"""
{SEGMENTS}, {S1}, {S2}, {S3}, {NETWORK_ROWS}, {CLIENT_ROWS},
b0 AS (SELECT * FROM s1_rows UNION ALL BY NAME SELECT * FROM s2_rows UNION ALL BY NAME SELECT * FROM s3_rows),
b1 AS (SELECT b0.* FROM b0 JOIN (SELECT NUMERO_CONTRAT AS live FROM b0 GROUP BY 1
  HAVING SUM(Collecte_Brute_TOTALE + Prestation_TOTALE + Arbitrage_Entrant + Arbitrage_Sortant + PM_DEBUT + PM_FIN) <> 0) ON live IS NOT DISTINCT FROM NUMERO_CONTRAT),
ch(code, network) AS (VALUES {_CHANNEL_VALUES}),
b2 AS (SELECT b.* EXCLUDE (NUMERO_CLIENT, TYPE_PRSN), b.NUMERO_CLIENT AS client1, b.TYPE_PRSN AS type1, nw.LIBELLE_COMMERCIAL AS lc0, nw.CODE_DELEGATION, nw.DELEGATION, nw.CODE_REGION, nw.REGION,
    nw.CODE_GESTIONNAIRE, nw.CANAL_RDU_PRINCIPAL, ch.network AS raw, tg.TMGA, cl.* EXCLUDE (NUMERO_CONTRAT, CANAL_DISTRIBUTION, ITFAMPRO, ITFAMRIS, CDCATPR),
    cf.RESEAU_SAS, cf.LIBELLE_COMMERCIAL_SAS, lp.NATURE_PMO, wc.LIBELLE_COMMERCIAL_GP, wc.SEGMENTATION_GP, wc.APPORTEUR_GP, pp.LIBELLE_COMMERCIAL_PF, pp.SEGMENTATION_PF, pp.APPORTEUR_PF
  FROM b1 b LEFT JOIN nw ON nw.CODE_PORTEFEUILLE = b.CODE_PORTEFEUILLE LEFT JOIN ch ON ch.code = nw.CANAL_RDU_PRINCIPAL
  LEFT JOIN ({st.PRODUCT_TAGS.sql()}) tg ON tg.CLE = concat(b.CODE_PRODUIT, b.CODE_UT)
  LEFT JOIN ({st.PARTNER_PORTFOLIOS.sql()}) pp ON lpad(pp.CODE_PORTEFEUILLE, 10, '0') = b.CODE_PORTEFEUILLE
  LEFT JOIN cl ON cl.NUMERO_CONTRAT = b.NUMERO_CONTRAT
  LEFT JOIN ({st.CONTRACT_FILE.sql()}) cf ON lpad(cf.NUMERO_CONTRAT, 16, '0') = b.NUMERO_CONTRAT
  LEFT JOIN ({st.LEGAL_PERSONS.sql()}) lp ON lpad(lp.NMCNT, 16, '0') = b.NUMERO_CONTRAT
  LEFT JOIN ({st.WEALTH_CLIENTS.sql()}) wc ON lpad(wc.NUMERO_CLIENT, 10, '0') = cl.NUMERO_CLIENT_2),
b3 AS (SELECT *, COALESCE(raw, LB_CANAL) AS n0 FROM b2),
b4 AS (SELECT *, CASE WHEN n0 = 'AGENTS GENERAUX' THEN 'AGA' WHEN n0 = 'Courtiers Généralistes' THEN 'COURTIERS GENERALISTES' ELSE n0 END AS n1 FROM b3),
b5 AS (SELECT *, CASE WHEN n1 = 'ND' AND SYSTEME = 'SYS3' THEN RESEAU_SAS ELSE n1 END AS net, CASE WHEN lc0 IS NULL AND SYSTEME = 'SYS3' THEN LIBELLE_COMMERCIAL_SAS ELSE lc0 END AS lc FROM b4),
b6 AS (SELECT *, CASE WHEN net IN ('A2P', 'AEP', 'AGA') THEN 'RESEAU PROPRIETAIRE'
    WHEN net IN ('COURTIER MSC','DELEGUE MSC','COURTIER A','COURTIER B','COURTIER C','ASTRAL','CII2','COURTIERS GENERALISTES','PARTENAIRE BANCAIRE','PARTENAIRE DISTRIBUTION','CGPI') THEN 'RESEAU TIERS'
    WHEN net = 'GESTION PRIVEE DIRECTE' THEN 'GESTION PRIVEE' ELSE 'AUTRES' END AS c0 FROM b5),
b7 AS (SELECT *, CASE WHEN c0 = 'RESEAU PROPRIETAIRE' AND (SOUS_SEGPAT = 'GP' OR SYSTEME = 'SYS1') THEN 'GESTION PRIVEE' ELSE c0 END AS c1 FROM b6),
b8 AS (SELECT *, CASE WHEN SYSTEME = 'SYS1' OR c1 IN ('RESEAU TIERS', 'GESTION PRIVEE') THEN 1 ELSE 0 END AS one FROM b7),
b9 AS (SELECT * EXCLUDE (net, c1, lc), net AS "RESEAU", c1 AS "CANAL", lc AS "LIBELLE_COMMERCIAL", CAST(one AS BIGINT) AS "TOP_ONE", COALESCE(NUMERO_CLIENT_2, client1) AS "NUMERO_CLIENT",
    CASE CODE_ISIN WHEN 'FR0011129717' THEN 'ASI' WHEN 'FR0013076031' THEN 'ASIS' ELSE '' END AS "TYPE_UC", CASE WHEN TMGA = 'O' THEN 'O' ELSE 'N' END AS "TOP_TMGA",
    CASE WHEN contains(CODE_PORTEFEUILLE, '0000000012') THEN 'Oui' ELSE 'Non' END AS "TOP_PORTEFEUILLE",
    COALESCE(CASE WHEN SYSTEME = 'SYS2' AND TYPE = 'DOUBLE PROFIL' AND CIVILITE_PM = 'SARL' THEN 'MOR' WHEN SYSTEME = 'SYS2' AND TYPE = 'FICHE PM' THEN 'MOR'
      WHEN SYSTEME = 'SYS2' AND TYPE = 'DOUBLE PROFIL' AND CIVILITE_PM <> 'SARL' THEN 'PHY' WHEN SYSTEME = 'SYS2' AND TYPE = 'FICHE PP' THEN 'PHY'
      WHEN SYSTEME = 'SYS2' AND TYPE NOT IN ('DOUBLE PROFIL', 'FICHE PM', 'FICHE PP') THEN 'ND' ELSE type1 END, 'PHY') AS "TYPE_PRSN",
    CASE WHEN {_OWN} THEN LIBELLE_COMMERCIAL_GP WHEN {_PARTNER} THEN LIBELLE_COMMERCIAL_PF ELSE lc END AS "LIBELLE_COMMERCIAL_CRM",
    CASE WHEN {_OWN} THEN SEGMENTATION_GP WHEN {_PARTNER} THEN SEGMENTATION_PF ELSE ' ' END AS "SEGMENTATION",
    CASE WHEN {_OWN} THEN APPORTEUR_GP WHEN {_PARTNER} THEN APPORTEUR_PF ELSE ' ' END AS "APPORTEUR" FROM b8),
g0 AS (SELECT {_Q}, {', '.join(f'SUM("{m}") AS "{m}"' for m in CANONICAL_MEASURES)},
    {', '.join(f"""SUM(CASE WHEN TYPE_SUPPORT = '{t}' THEN "{m}" ELSE 0 END) AS "{n}" """ for n, (m, t) in _SPLITS.items())} FROM b9 GROUP BY {_Q}),
base AS (SELECT *, CAST(CASE WHEN ROW_NUMBER() OVER (PARTITION BY NUMERO_CONTRAT ORDER BY {', '.join(f'"{c}" ASC NULLS LAST' for c in _ORDER)}) = 1 THEN 1 ELSE 0 END AS BIGINT) AS "CNT",
    CASE WHEN year(DATE_EFFET) = 1998 THEN Collecte_Brute_TOTALE ELSE 0 END AS "Affaire_Nouvelle" FROM g0)
"""
