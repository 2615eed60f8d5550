import datetime as dt
import re
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from flowbook.functions.calendar import Period
from flowbook.operators.dedupe import null_safe_join, null_safe_order
from flowbook.operators.rules import relabel
from flowbook.plans import base, csv_system, dimensions, reports, system1, system2, system3
from flowbook.plans import rulebook as rb
from flowbook.plans.canonical import COLUMNS, MEASURES
from flowbook.queries.cube_queries import APE, cube, month_list
from flowbook.plans.cube_studies import budget_study
from flowbook.session import working_folder
from flowbook.sources import files, tables


def test_month_is_replaced_not_doubled_and_read_pruned(spark, rows, tmp_path, values):
    root = str(tmp_path / "store")
    tables.write_month(rows("k int, v int", (1, 1), (2, 2)), root, Period(2024, 1), within=["k"])
    tables.write_month(rows("k int, v int", (9, 9)), root, Period(2024, 2))
    tables.write_month(rows("k int, v int", (1, 5)), root, Period(2024, 1))
    month = tables.read_month(spark, root, Period(2024, 1))
    assert values(month) == [(1, 5, "202401")]
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(func_month" in plan
    assert values(tables.read_month(spark, root, Period(2024, 2)).select("k")) == [(9,)]
    others = {f: f.stat().st_mtime_ns for f in (tmp_path / "store" / "func_month=202402").iterdir()}
    assert tables.drop_month(spark, root, Period(2024, 1)) and not tables.drop_month(spark, root, Period(2024, 1))
    assert spark.read.parquet(root).count() == 1
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "store" / "func_month=202402").iterdir()} == others
    assert sorted(f.name for f in (tmp_path / "store").iterdir() if "SUCCESS" not in f.name) == ["func_month=202402"]


def test_a_report_is_replaced_as_a_whole(spark, rows, tmp_path, values):
    path = str(tmp_path / "report")
    tables.overwrite_report(rows("k int, v int", (2, 1), (1, 2)), path, order_by=["k"])
    tables.overwrite_report(rows("name string", ("new",)), path)
    assert values(spark.read.parquet(path)) == [("new",)]
    broken = rows("k int", (1,), (0,)).select(F.when(F.col("k") == 0, F.raise_error("broken")).otherwise("x").alias("name"))
    with pytest.raises(Exception, match="broken"):
        tables.overwrite_report(broken, path)
    assert values(spark.read.parquet(path)) == [("new",)]
    assert not [f.name for f in tmp_path.iterdir() if "retired" in f.name]


def test_lines_are_good_or_rejected_with_reasons(spark, tmp_path, values):
    folder = tmp_path / "FLUX_1_2024.csv"
    folder.mkdir()
    (folder / "part-1.csv").write_text("NUMERO_CONTRAT;MONTANT_BRUT;DATE_EFFET_FLUX;TYPE_SUPPORT\nC1;1 234,50;31/01/2024;UC\nC2;;;\nC3;1;2;3;4\nC4\n;12,x;31/02/2024;ACTIONS\n")
    (folder / "part-2.csv").write_text("NUMERO_CONTRAT;MONTANT_BRUT;DATE_EFFET_FLUX;TYPE_SUPPORT\nC9;-5;01/02/2024;EURO\n")
    names = ["NUMERO_CONTRAT", "MONTANT_BRUT", "DATE_EFFET_FLUX", "TYPE_SUPPORT"]
    lines = files.read_csv_lines(spark, str(folder), tables.declared({n: "string" for n in names}))
    good, rejected = files.split_lines(lines, csv_system.row_rules(names), str(tmp_path / "split"))
    assert good.columns == names
    assert values(good.select("NUMERO_CONTRAT", "MONTANT_BRUT")) == [("C1", "1 234,50"), ("C2", None), ("C9", "-5")]
    assert values(rejected.select("line", "reasons")) == [
        ("C3;1;2;3;4", ["field_count"]), ("C4", ["field_count"]),
        (";12,x;31/02/2024;ACTIONS", ["missing:NUMERO_CONTRAT", "unreadable:MONTANT_BRUT", "unreadable:DATE_EFFET_FLUX", "outside:TYPE_SUPPORT"]),
    ][2:] + [("C3;1;2;3;4", ["field_count"]), ("C4", ["field_count"])]
    assert values(rejected.select("file_name").distinct()) == [("part-1.csv",)]
    assert dict((r["reason"], r["rows"]) for r in files.reject_counts(rejected).collect())["field_count"] == 2
    other = tmp_path / "other.csv"
    other.write_text("A;B\n1;2\n")
    with pytest.raises(Exception, match="header|Header"):
        files.read_csv_lines(spark, str(other), "x string, y string").collect()
    assert "Filter" in plan_of(good) and len(re.findall("FileScan", plan_of(good))) == 1


def test_controls_are_observed_in_the_writing_job(spark, rows, tmp_path):
    from flowbook.operators import checks

    df = rows("y string, c string, v double, f string", ("1998", "a", 1.5, "one"), ("1999", "b", 2.0, "two"), (None, "c", 3.0, "two"), ("2005", None, 1.0, "one"), ("1998", "", 4.0, "one"))
    controls = checks.Controls("v", "y", ["1998", "1999", "2000"], {"c": ["a"]}, "f")
    stored, before, after = checks.written_with_controls(df, lambda d: d.filter("v <> 2"), str(tmp_path / "out"), controls)
    assert stored.count() == 4 and sorted(before[1].get["files"]) == ["one", "two"]
    assert before[0].totals(before[1]) == {"1998": (Decimal("5.50"), 2), "1999": (Decimal("2.00"), 1), None: (Decimal("4.00"), 2)}
    assert sorted(before[0].violations(before[1]), key=repr) == [("c", "", 1), ("c", "b", 1), ("c", "c", 1), ("c", None, 1)]
    report = {r["y"]: (r["rows_before"], r["rows_after"], r["total_change"]) for r in checks.observed_totals(spark, "y", before, after).collect()}
    assert report == {"1998": (2, 2, 0), "1999": (1, 0, -2), None: (2, 2, 0)}
    same = {r["y"]: (r["rows_before"], r["rows_after"], r["total_change"]) for r in checks.control_totals(df.filter("y < '2000'"), df.filter("v <> 2 AND y < '2000'"), ["y"], "v").collect()}
    assert same == {k: v for k, v in report.items() if k}
    _, before, after = checks.written_with_controls(df.filter("false"), lambda d: d, str(tmp_path / "none"), controls)
    assert checks.observed_totals(spark, "y", before, after).count() == 0 and before[0].violations(before[1]) == []


def test_daily_partition_and_snapshots(spark, rows, tmp_path, values):
    df = rows("v int, func_partitioning_year string, func_partitioning_month string, func_partitioning_day string",
              (1, "2024", "2024-01", "2024-01-08"), (2, "2024", "2024-01", "2024-01-09"))
    root = str(tmp_path / "daily")
    tables.write_partitions(df, root, df.columns[1:])
    assert values(tables.read_day(spark, root, dt.date(2024, 1, 8))) == [(1,)]
    snaps = rows("k int, s date", (1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1)), (3, dt.date(2024, 3, 1)))
    path = str(tmp_path / "snaps")
    tables.overwrite_report(snaps, path)
    read = lambda **how: values(tables.read_table(spark, path, snapshot_col="s", **how).select("k"))
    assert read() == [(3,)] and read(limit=dt.date(2024, 2, 15)) == [(2,)] and read(archive=True) == [(1,), (2,), (3,)]


def test_csv_export(spark, rows, tmp_path):
    out = str(tmp_path / "csv")
    tables.export_csv(rows("d date, v int", (dt.date(2024, 1, 31), 5)), out)
    read = files.read_csv(spark, out, tables.declared({"d": "string", "v": "int"}))
    assert [tuple(r) for r in read.collect()] == [("31/01/2024", 5)]


PM = tables.declared({"NUMERO_CONTRAT": "string", "PM_FIN": "string"})
FLUX = tables.declared({"NUMERO_CONTRAT": "string", "MONTANT_BRUT": "string"})


def monthly(folder):
    folder.mkdir()
    for kind, month, year in (("PM", 12, 2021), ("PM", 12, 2022), ("PM", 3, 2022), ("PM", 5, 2023), ("PM", 6, 2023), ("FLUX", 6, 2023), ("FLUX", 12, 2022)):
        header = "NUMERO_CONTRAT;" + ("PM_FIN" if kind == "PM" else "MONTANT_BRUT")
        (folder / f"{kind}_{month}_{year}.csv").write_text(f"{header}\n{kind}{month}{year};1 234,50\n")
    (folder / "notes.csv").write_text("x\n1\n")
    return str(folder)


def test_files_are_chosen_by_name_and_tagged_with_their_own_year(spark, tmp_path):
    root = monthly(tmp_path / "in")
    read = files.read_monthly_files(spark, root, {"PM": PM, "FLUX": FLUX}, Period(2023, 8))
    found = sorted((r.periode, r.mois_fichier, r.annee_fichier, r.mois_actuel) for r in read.collect())
    assert found == [("FLUX_12_2022.csv", 12, 2022, 8), ("FLUX_6_2023.csv", 6, 2023, 8), ("PM_12_2021.csv", 12, 2021, 8),
                     ("PM_12_2022.csv", 12, 2022, 8), ("PM_6_2023.csv", 6, 2023, 8)]
    january = files.chosen_files(files.file_names(spark, root), Period(2023, 1))
    assert sorted(r.year for r in january.collect()) == [2021, 2022, 2022]
    assert read.filter("periode = 'FLUX_6_2023.csv'").first()["PM_FIN"] is None
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        files.read_monthly_files(spark, str(tmp_path / "empty"), {"PM": PM}, Period(2023, 8))


def test_cleaning_survives_text_keys(rows):
    schema = "NUMERO_CONTRAT string, SITUATION_CONTRAT string, CODE_PORTEFEUILLE string, RESEAU string, MONTANT_BRUT string, MONTANT_NET string, PM_FIN string"
    df = rows(schema, ("A7", "x", "9990001", "#NA", "1 000,5", "2", "12,5"), ("A7", "x", "9990001", "#NA", "1 000,5", "2", "12,5"),
              ("0", "x", "1", "AEP", "1", "1", "1"), ("5", "0", "1", "AEP", "1", "1", "1"), ("6", "x", "P1", None, "bad", None, None), (None, "x", "1", "AEP", "1", "1", "1"))
    out = sorted(csv_system.clean(df).collect(), key=lambda r: r.NUMERO_CONTRAT)
    assert [(r.NUMERO_CONTRAT, r.CODE_PORTEFEUILLE, r.INTERNATIONAL, r.RESEAU, r.MONTANT_BRUT, r.PM_FIN) for r in out] == [
        ("0000000000000006", "00000000P1", 0, "AGA", None, None),
        ("00000000000000A7", "0009990001", 1, "PARTENAIRE BANCAIRE", Decimal("1000.50"), Decimal("12.50")),
    ]


def test_truncation_is_an_option(rows):
    schema = ("NUMERO_CONTRAT string, CODE_PORTEFEUILLE string, RESEAU string, PM_FIN decimal(18,2), MONTANT_BRUT decimal(18,2), TYPE_TRANSACTION string, ACTE_GESTION string, "
              "DATE_EFFET_FLUX string, DATE_EFFET_CONTRAT string, NOM_APPORTEUR string, NOM_PRODUIT string, annee_fichier int, annee_actuelle int, mois_actuel int")
    df = rows(schema, ("1", "p", "AGA", Decimal("1012.50"), Decimal("-4"), "Arbitrage", "Libre", None, "05/03/2024", "a", "b", 2023, 2024, 7))
    network = rows("CODE_PORTEFEUILLE string, REGION string", ("p", "OUEST"))
    exact = csv_system.reporting(df, network).first()
    whole = csv_system.reporting(df, network, whole_units=True).first()
    assert float(exact.Encours) == 1.0125 and float(whole.Encours) == 1.012
    assert exact.nature == "Arbitrage sortant" and float(exact.MONTANT_BRUT) == 0.004
    assert (exact.REGION, exact.Mois_valeur, exact.DATE_VALEUR) == ("OUEST", 3, dt.date(2024, 3, 5))


def test_network_pads_before_it_removes_duplicates(rows):
    names = ("ID", "CD_AGENCE", "INTITULE", "LIB_NAT_GESTION_1", "CD_CIRCO_PP_1", "CD_INSPE_PP_1", "LIB_LONG_INSP_PP_1", "CD_REGION_PP_1",
             "LIB_LONG_REG_PP_1", "ID_DISTR_1", "CANAL", "CD_RESEAU", "CD_REGROUP", "LIB_CANAL")
    schema = ", ".join(f"X_{n} string" for n in names)
    row = lambda id_, title, code: (id_, "a", title, "nat", "c", code, "d", "r", "REG", "g", "010", "n", "u", "A2P SUD")
    df = rows(schema, row("77", None, "15100"), row("0000000077", "zz", "15100"), row("88", "t", "x"))
    out = {r.CODE_PORTEFEUILLE: r for r in dimensions.network(df, banking_partner="88", prefix="X_").collect()}
    assert len(out) == 2 and out["0000000077"].REGION == "SUD-OUEST" and out["0000000077"].LIBELLE_COMMERCIAL == "nat"
    assert (out["0000000088"].CANAL_RDU_PRINCIPAL, out["0000000088"].LIB_CANAL, out["0000000088"].REGION) == ("033", "PARTENAIRE BANCAIRE", "REG")


def test_filters_run_before_projection_and_headers_drive(spark, rows):
    """A filter on a column that is projected away must not lose rows."""
    detail = rows("NUMERO_CONTRAT string, NUMERO_ADHESION string, NUMERO_OPERATION string, CODE_ISIN string, CODE_SUPPORT string, CODE_UT string, LIBELLE_SUPPORT string, "
                  "LIBELLE_NATURE_SUPPORT string, LIBELLE_TYPE_TRANSACTION string, DETAIL_TRANSACTION string, MONTANT decimal(18,2), CODE_CONVENTION_GESTION string, CATEGORIE_TYPE_MONTANT string",
                  ("1", "a", "o1", None, "s", "u", "l", "Part", "VERSEMENT", "Versement initial", Decimal(5), "c", "MONTANT_BRUT"),
                  ("1", "a", "o1", None, "s", "u", "l", "Part", "VERSEMENT", "Versement initial", Decimal(5), "c", "MONTANT_BRUT"))
    header = rows("NUMERO_CONTRAT string, NUMERO_OPERATION string, NUMERO_ADHESION string, DATE_JOURNALIER date, CODE_UV string, LIBELLE_PAIEMENT string, LIBELLE_TYPE_TRANSACTION string",
                  ("1", "o1", "a", dt.date(2024, 3, 1), "v", "CHEQUE", "VERSEMENT"), ("1", "o1", "a", dt.date(2024, 3, 1), "v", "CHEQUE", "AUTRE"),
                  ("2", "o2", "b", dt.date(2024, 3, 1), "v", "CHEQUE", "VERSEMENT"), ("3", "o3", "c", dt.date(2025, 3, 1), "v", "CHEQUE", "VERSEMENT"))
    moved = system3.movements({"operation_detail": detail, "operations": header}, Period(2024, 6)).collect()
    assert sorted((r.NUMERO_CONTRAT, r.Type_Transaction, r.MONTANT_TRANSACTION) for r in moved) == [
        ("0000000000000001", "VI", Decimal(5)), ("0000000000000002", None, Decimal(0))]


def test_profiles_have_one_row_per_code(rows):
    df = rows("PROF_ID string, PROF_FULL_NAME string, PROF_SHORT_NAME string, CVN_GES string, EFF_D_OFF date",
              ("01", "prudent fund", "X", "2", None), ("01", "other", "X", "3", None), ("02", "old", "X", "1", dt.date(2020, 1, 1)), ("03", "su", "SU", "1", None))
    assert [tuple(r) for r in system2.profiles(df).collect()] == [("01", "Prudent Fund", "Gestion évolutive")]


def test_act_label_prefers_the_greatest_short_code(rows, values):
    df = rows("HDL_ACT_ID string, HDL_ACT_FULL_NAME string, HDL_ACT_ABS_NAME string", ("1", "first", "A"), ("1", "second", "B"), ("2", "only", None))
    assert values(system2.act_labels(df)) == [("1", "second"), ("2", "only")]


def test_person_type_and_network_stages(rows):
    df = rows("SYSTEME string, TYPE string, CIVILITE_PM string, TYPE_PRSN string",
              ("SYS2", "DOUBLE PROFIL", "SARL", "PHY"), ("SYS2", "DOUBLE PROFIL", None, "MOR"), ("SYS2", "FICHE PP", None, None), ("SYS1", "FICHE PM", None, None), ("SYS2", "zz", None, "PHY"))
    assert [r.TYPE_PRSN for r in relabel(df, rb.person_type_base(rb.DEFAULT_NAMES)).collect()] == ["MOR", "MOR", "PHY", "PHY", "ND"]


def test_finance_names_do_not_collide(rows):
    df = rows("TYPE_PRSN string, RESEAU string, CANAL string, SYSTEME string, UJ string, CODE_PORTEFEUILLE string, CNT int, DATE_EFFET date",
              ("PHY", "CGPI", "RESEAU TIERS", "SYS2", "MU", "1", 1, dt.date(2024, 2, 1)), ("MOR", "DOM-TOM", "AUTRES", "SYS1", "MU", "2", 0, None), ("PHY", "AGA", "GESTION PRIVEE", "SYS2", "MU", "3", 1, dt.date(2023, 2, 1)))
    out = reports.finance_rows(df, Period(2024, 6), forced_portfolios=["2"]).collect()
    assert [(r.RESEAU, r.reseau_rang, r.Canal_distrib, r.SYSTEME, r.UJ, r.TOP_AN) for r in out] == [
        ("CGPI", " ", "CGP", "SYS2F", "SA", 1), ("DOM-TOM", " ", "DOM-TOM", "SYS1", "SA", 0), ("AGA", "1 : AGA", "Gestion Privée Réseau", "SYS2F", "MU", 0)]


def test_base_keys_are_complete():
    assert len(COLUMNS) == 40 and len(MEASURES) == 18
    assert len(base.KEYS) == 51 and len(base.MEASURES) == 24 and len(set(base.KEYS)) == 51
    assert set(base.DESCRIPTORS) == set(base.COUNT_ORDER) | {"NUMERO_CONTRAT"}


def test_budget_conserves_value(spark):
    """What the comparative columns hold agrees with the amount of the same months."""
    out = budget_study(cube(spark, "/root/testdata/sf0.001"), month_list(1997, 1999), 1999, 12, APE)
    total = out.agg(F.sum("MONTANT"), F.sum("MT_REEL_MOIS_N") + F.sum("MT_REEL_ANNEE_N_1") + F.sum("MT_REEL_ANNEE_N_2")).first()
    assert total[0] == total[1] and total[0] > 0


def test_working_folder_follows_the_session(spark):
    assert working_folder(spark, "x") != working_folder(spark, "x")
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: "/shared/folder/"), sparkContext=SimpleNamespace(master="yarn", applicationId="app-1"))
    assert working_folder(cluster, "x").startswith("/shared/folder/app-1/x-")
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        working_folder(unset, "x")


def test_campaign_keeps_contracts_that_hold_without_moving(rows, values):
    from flowbook.plans.campaign import campaign_history

    day = dt.date(2024, 1, 15)
    key = "ID_CONTRAT string, CD_FUND string, CD_SUPPORT string, CD_PACK string, CD_OG string"
    contract = "ID_CONTRAT string, CD_PROD string, LB_CADRE_FISCAL string, LB_STATUS string, DT_SOUSCRIPTION date, DT_CLOTURE date, CD_PTF_RDU string, CD_UJ string"
    person = "ID_CONTRAT string, LB_ROLE string, REFERENCE_CLIENT string, TYPE_PRSN string"
    known = [(c, "P", "vie", "En cours", day, None, p, "SA") for c, p in (("moves", "1"), ("holds", "2"), ("other", "3"))]
    tables = {
        "movement_detail": rows(f"{key}, ID_MVT string, DT_INVEST date, MT_BRUT decimal(18,2), LB_TYPE_FLUX string",
                                ("moves", "F", "s", "uc", None, "m1", day, Decimal("7.00"), "Versement libre")),
        "movement_header": rows("ID_CONTRAT string, ID_MVT string, LB_STATUT string, LB_TYPE_MVT string", ("moves", "m1", "Soldé", "Standard")),
        "positions": rows(f"{key}, PM decimal(18,2), DT_POSITION date", *[
            (c, f, "s", "uc", None, Decimal("5.00"), day) for c, f in (("moves", "F"), ("holds", "F"), (None, "G"), ("other", "X"))]),
        "contracts": rows(contract, *known), "contracts_archive": rows(contract, *known),
        "products": rows("CD_PROD string, LB_PROD string", ("P", "Product")),
        "persons": rows(person, ("moves", "Souscripteur", "1", "PHY")), "persons_archive": rows(person, ("moves", "Souscripteur", "1", "PHY")),
    }
    network = rows("CODE_PORTEFEUILLE string, CANAL_RDU_PRINCIPAL string", *[(p.zfill(10), c) for p, c in (("1", "010"), ("2", "013"), ("3", "011"))])
    found = campaign_history(tables, network, {"F": "Fund F", "G": "Fund G"}, Period(2024, 1), Period(2024, 1))
    assert values(found.select("annee", "mois", "reseau", "fonds_campagne", F.col("Collecte_Brute").cast("double"))) == [
        (2024, 1, "1 : AGA", "Fund F", 7.0), (2024, 1, "3 : Salarié", "Fund F", 0.0), (2024, 1, "Autre", "Fund G", 0.0)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["surrender_study", "cube_budget", "cube_two_levels"])
def test_cube_levels_scan_the_fact_once_and_sort_nothing(spark, name):
    from flowbook.queries import QUERIES

    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_extendedprice", plan)) == 1 and plan.count("lineitem.parquet") == 1
    assert "SortAggregate" not in plan


def test_lookups_check_keys_without_sorting(spark):
    from flowbook.queries import QUERIES

    for name in ("lookup_chain", "lookup_null_keys", "composite_lookup"):
        assert "SortAggregate" not in plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_system2_reads_two_versions_of_its_positions(spark, rows, tmp_path, values):
    versions = rows("NUMERO_CONTRAT string, PM_SUPPORT int, DATE_VERSION date", *[
        ("c", n, dt.date(2023, month, 28)) for n, month in enumerate((6, 9, 12), 1)], ("c", 9, dt.date(2024, 6, 28)), ("d", 9, dt.date(2024, 6, 28)), ("c", 99, dt.date(2024, 7, 31)))
    root = str(tmp_path / "versions")
    tables.write_partitions(versions, root, ["DATE_VERSION"])
    stored = spark.read.parquet(root)
    opening, closing = system2.snapshots({"positions": stored}, Period(2024, 6))
    assert values(opening.select("PM_SUPPORT")) == [(3,)] and values(closing.select("NUMERO_CONTRAT", "PM_SUPPORT")) == [("c", 9), ("d", 9)]
    for frame in (opening, closing):
        assert "PartitionFilters: [isnotnull(DATE_VERSION" in plan_of(frame) and frame.select(F.col("_metadata.file_path")).distinct().count() == len(frame.inputFiles()[:1])
    ready = {"positions_opening": closing, "positions_closing": opening}
    assert system2.snapshots(ready, Period(2024, 6)) == (closing, opening)


def test_newest_rows_at_two_dates_with_ties(spark, rows, values):
    from flowbook.operators.positions import newest_pair

    d = dt.date
    df = rows("k string, u int, v int, d date", ("a", 1, 1, d(2023, 5, 1)), ("a", 1, 2, d(2023, 12, 1)), ("a", 1, 3, d(2023, 12, 1)), ("a", 1, 4, d(2024, 3, 1)), ("a", 1, 9, d(2024, 9, 1)),
              ("b", None, 5, d(2023, 1, 1)), ("b", None, 5, d(2023, 1, 1)), (None, 1, 6, d(2024, 1, 1)), ("c", 1, 7, d(2024, 9, 1)), ("e", 1, 8, None))
    out = newest_pair(df, ["k", "u"], "d", d(2023, 12, 31), d(2024, 6, 30))
    assert values(out.select("v", "is_opening", "is_closing")) == sorted(
        [(2, True, False), (3, True, False), (4, False, True), (5, True, True), (5, True, True), (6, False, True)], key=repr)
    assert "Window" not in plan_of(out)
    assert newest_pair(df.filter("false"), ["k", "u"], "d", d(2023, 12, 31), d(2024, 6, 30)).count() == 0


def test_system3_scans_its_valuations_once(spark):
    from flowbook.queries import standins as st

    frames = st.frames(spark, "/root/testdata/sf0.001", st.SYSTEM3)
    plan = plan_of(system3.positions(frames, Period(1998, 6)))
    assert plan.count("valued-rows") == 2 and "l_extendedprice" not in plan  # the stored rows twice, their source not at all


def test_system1_does_not_deal_facts_by_option(spark, monkeypatch):
    """Options are few but come from large tables; contracts without a number are spread."""
    many = spark.range(3000)
    names = [*rb.SYSTEM1_BUCKETS.names, "MT_NON_INVESTI", "PM_DEBUT", "PM_FIN"]
    own = many.selectExpr(
        "if(id % 3 = 0, null, concat('c', id)) ID_CONTRAT", "concat('f', id % 5) CD_FUND", "'s' CD_SUPPORT", "'p' CD_PACK", "concat('o', id % 3) CD_OG",
        "date'2024-05-01' DT_VL_FIN", *[f"cast({1 if n == 'PM_FIN' else 0} as decimal(28,2)) {n}" for n in names])
    monkeypatch.setattr(system1, "base_ledger", lambda *_: own)
    persons = many.selectExpr("concat('c', id) ID_CONTRAT", "'Souscripteur' LB_ROLE", "cast(id as string) REFERENCE_CLIENT", "'PHY' TYPE_PRSN")
    held = many.selectExpr(
        "concat('c', id) ID_CONTRAT", "'1' CD_PROD", "'vie' LB_CADRE_FISCAL", "'En cours' LB_STATUS", "date'2020-01-01' DT_SOUSCRIPTION", "cast(null as date) DT_CLOTURE",
        "'7' CD_PTF_RDU", "'SA' CD_UJ")
    given = {
        "option_products": many.selectExpr("concat('o', id % 2) CD_OG", "'Profil' LB_OG_AIA", "'SG' LB_SOC_GESTION"),
        "option_packs": many.selectExpr("concat('o', id % 2) CD_OG", "'Pack' LB_PACK"),
        "supports": many.selectExpr("concat('f', id) CD_FUND", "'n' NOM", "'UC' LB_TYPE", "'1' CD_INTERNE", "date'2000-01-01' DT_SITUATION"),
        "persons": persons, "persons_archive": persons, "contracts": held, "contracts_archive": held,
        "products": spark.range(1).selectExpr("'1' CD_PROD", "'P' LB_PROD"),
        "distributors": spark.range(1).selectExpr("'7' CD_DISTRIBUTEUR", "'L' LB_RESEAU"),
    }
    segments = spark.range(1).selectExpr("'00001' CODE_PRODUIT", "'00001' CODE_UT", "'S' SEGMENT")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        out = system1.system1(given, Period(2024, 6), segments)
        plan = out._jdf.queryExecution().executedPlan().toString()
        found = {tuple(r) for r in out.groupBy("PROFIL_GESTION", "TYPE_PRSN").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "hashpartitioning(CD_OG" not in plan
    assert "__deal" in plan
    assert sum(n for *_, n in found) == 3000 and {(p, t) for p, t, _ in found} == {("Profil", "PHY"), ("Profil", None), ("Gestion Libre", "PHY")}


def test_monthly_files_deal_lines_once_before_their_texts(spark, rows, tmp_path, monkeypatch):
    from flowbook.queries import files_and_backfill as fb

    t = dt.datetime
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    lines = [(1, 4, 3, 1, 1234.5, "A", "O", t(1999, 12, 3)), (1, 4, 3, 1, 1234.5, "A", "O", t(1999, 12, 3)), (2, 5, None, 3, None, "R", "F", t(2000, 9, 1)), (3, 6, 7, 2, 2.0, "N", "O", None)]
    rows(schema, *lines).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    dealt = []
    monkeypatch.setattr(fb, "write_partitions", lambda df, folder, columns: (dealt.append((df.columns, columns, folder)), tables.write_partitions(df, folder, columns)))
    folder = fb.monthly_files(spark, str(tmp_path))
    assert len(dealt) == 1 and dealt[0][1] == ["month"] and not set(dealt[0][0]) & set(fb.FLOW_COLUMNS)
    assert not tables.exists(spark, dealt[0][2])
    for kind, amount in (("PM", "PM_FIN"), ("FLUX", "MONTANT_NET")):
        found = spark.read.option("header", True).option("sep", ";").csv(f"{folder}/{kind}")
        assert sorted((r.file, r.NUMERO_CONTRAT, r[amount]) for r in found.filter("file is not null").collect()) == [
            (f"{kind}_12_1999.csv", "C1", "1 234,50"), (f"{kind}_12_1999.csv", "C1", "1 234,50"), (f"{kind}_9_2000.csv", "C2", None)]
        assert found.count() == 4


def test_month_is_stored_in_the_order_that_the_joins_by_contract_leave(spark, rows, tmp_path):
    left = rows("NUMERO_CONTRAT string, v int", ("b", 1), (None, 2), ("a", 3), ("", 4), ("b", 5))
    right = rows("NUMERO_CONTRAT string, w int", ("b", 7), (None, 8))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = null_safe_join(left, right, ["NUMERO_CONTRAT"], "left").coalesce(1)
        by_name = joined.sortWithinPartitions("NUMERO_CONTRAT")
        ordered = null_safe_join(left, right, ["NUMERO_CONTRAT"], "left").sortWithinPartitions(*null_safe_order(["NUMERO_CONTRAT"]))
        sorts = [df._jdf.queryExecution().executedPlan().toString().count("Sort [") for df in (by_name, ordered)]
        assert sorts == [3, 2]
        base.store(joined, f"{tmp_path}/base", Period(2024, 6))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    stored = tables.read_month(spark, f"{tmp_path}/base", Period(2024, 6)).coalesce(1)
    assert [(r.NUMERO_CONTRAT, r.w) for r in stored.collect()] == [("", None), (None, 8), ("a", None), ("b", 7), ("b", 7)]


def test_files_by_name_are_written_without_a_sort(spark, rows, tmp_path, monkeypatch):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    write = DataFrameWriter.csv
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, path: (seen.append(spark.conf.get(name)), write(self, path))[1])
    monkeypatch.setattr(files, "OPEN_FILES", 2)
    given = [("PM_1_2024.csv", str(k), None) if k % 4 else (f"PM_{k % 3 + 2}_2024.csv", str(k), "x;y") for k in range(12)]
    before = spark.conf.get(name)
    files.write_by_file(rows("file string, a string, b string", *given).coalesce(1), f"{tmp_path}/files")
    assert seen == ["2"] and spark.conf.get(name) == before
    read = files.read_csv(spark, f"{tmp_path}/files/*", "a string, b string").select(F.regexp_extract(F.col("_metadata.file_path"), r"file=([^/]+)/", 1), "a", "b")
    assert sorted(map(tuple, read.collect()), key=repr) == sorted(given, key=repr)
