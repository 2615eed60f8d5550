from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowbook.functions import codes
from flowbook.operators.rules import BucketSet, FromColumn, RuleSet, both, either, has_text, literals, none_of, one_of, relabel, rule_hits, with_each_literal
from flowbook.plans import rulebook as rb


def test_pad_code_keeps_text_codes_under_ansi(rows):
    df = rows("c string", ("12",), ("A7",), (None,), ("",), ("0",), ("1234567",))
    out = df.select(codes.pad_code("c", 5, numeric_only=True), codes.pad_code("c", 5), codes.pad_code("c", 5, only_short=True))
    assert [tuple(r) for r in out.collect()] == [
        ("00012", "00012", "00012"), ("A7", "000A7", "000A7"), (None, None, None), ("", "00000", "00000"),
        ("0", "00000", "00000"), ("12345", "12345", "1234567"),
    ]


def test_parse_number_reads_localized_text(rows):
    df = rows("c string", ("1 234,50",), ("-3,1",), ("1 000",), ("1 000,05",), ("n/a",), ("",), (None,))
    out = [r[0] for r in df.select(codes.parse_number("c")).collect()]
    assert out == [Decimal("1234.50"), Decimal("-3.10"), Decimal("1000.00"), Decimal("1000.05"), None, None, None]
    assert df.select(codes.truncated(codes.parse_number("c"))).first()[0] == 1234


def test_name_fallback_sees_empty_parts(rows):
    df = rows("a string, b string, c string", ("X", "Y", "Z"), (None, None, "Z"), ("", None, "Z"))
    assert [r[0] for r in df.select(codes.coalesced_name(["a", "b"], "c")).collect()] == ["X Y", "Z", "Z"]


def test_contract_repair_and_missing_part(rows):
    df = rows("c string", ("1234567890123492",), ("1234567890123401",))
    out = [r[0] for r in df.select(codes.repaired_contract("c", F.lit(True))).collect()]
    assert out == ["0012345678901234", "1234567890123401"]
    assert rows("c string", ("A - B",), ("A",)).select(codes.split_item("c", " - ", 2)).collect()[1][0] is None


def test_dates_that_cannot_be_read_are_null(rows):
    out = [r[0] for r in rows("c string", ("31/12/2023",), ("2023-12-31",), ("31/02/2023",)).select(codes.parsed_date("c")).collect()]
    assert str(out[0]) == "2023-12-31" and out[1:] == [None, None]


def test_first_match_wins_nested_and_without_default(rows):
    nested = RuleSet([("a > 1", RuleSet([("b = 'x'", "inner")], FromColumn("b"))), ("a > 0", "low")])
    df = rows("a int, b string", (2, "x"), (2, "it's"), (1, "x"), (0, "x"), (None, "x"))
    assert [r[0] for r in df.select(nested.column()).collect()] == ["inner", "it's", "low", None, None]


def test_rule_values_are_quoted_and_trimmed(rows):
    df = rows("c string", ("REORIENTATION D'EPARGNE",), ("LU1",), ("back\\slash",))
    rules = RuleSet([(one_of("c", ["REORIENTATION D'EPARGNE", " LU1", "back\\slash"]), "in")], "out")
    assert [r[0] for r in df.select(rules.column()).collect()] == ["in", "in", "in"]


def test_not_in_ignores_null(rows):
    df = rows("c string", ("a",), (None,), ("z",))
    assert [r[0] for r in df.select(RuleSet([(none_of("c", ["a"]), "out")], "else").column()).collect()] == ["else", "else", "out"]


def test_cascade_sees_earlier_stages(rows):
    df = rows("r string", ("a",), ("b",))
    staged = relabel(df, [("r", RuleSet([("r = 'a'", "b")], FromColumn("r"))), ("c", RuleSet([("r = 'b'", "yes")], "no"))])
    assert [tuple(r) for r in staged.collect()] == [("b", "yes"), ("b", "yes")]


def test_buckets_conserve_the_classified_total(rows, values):
    buckets = BucketSet(
        [("plus", "k = 'in'", 1), ("plus", "k = 'undo'", -1), ("other", "k = 'fee'", 1)], "m",
        totals={"total": ("plus", "other")}, differences={"rest": ("plus", "other")})
    df = rows("g string, k string, m decimal(18,2)", ("a", "in", Decimal(10)), ("a", "undo", Decimal(4)), ("a", "fee", Decimal(1)),
              ("a", "zzz", Decimal(99)), (None, "in", Decimal(5)), ("b", "in", None))
    out = {r["g"]: (r["plus"], r["other"], r["rest"], r["total"]) for r in buckets.aggregate(df, ["g"]).collect()}
    assert out == {"a": (6, 1, 5, 7), None: (5, 0, 5, 5), "b": (0, 0, 0, 0)}
    classified = buckets.classify(df).filter("g = 'a'").agg(F.sum("total")).first()[0]
    assert classified == 7


@pytest.mark.parametrize("motive,extra,client,legacy_client", [
    ("RAG", "RAG", 0, 0), ("RAG", "x", 0, 10), ("x", "RAG", 0, 10), (None, "RAG", 0, 0), ("x", "y", 10, 10), (None, None, 10, 0),
])
def test_switches_count_once_unless_legacy(rows, motive, extra, client, legacy_client):
    df = rows("g int, CODE_ACTE_COURT string, LIBELLE_MOTIF_ACTE string, LIBELLE_ACTE_COMPLEMENT string, TOP_TE int, TOP_TS int, MONTANT_BRUT decimal(18,2)",
              (1, "EA", motive, extra, 0, 0, Decimal(10)))
    fixed = rb.system2_buckets().aggregate(df, ["g"]).first()
    legacy = rb.system2_buckets(legacy_switches=True).aggregate(df, ["g"]).first()
    assert fixed["Arbitrage_Entrant_Client"] == client and fixed["Arbitrage_Entrant"] == 10
    assert legacy["Arbitrage_Entrant_Client"] == legacy_client


def test_system1_bucket_table(rows):
    labels = ["Prime comptant", "Transfert externe entrant", "Versement libre", "Versement libre programmé", "Transfert interne entrant", "Arbitrage achat",
              "Arbitrage vente", "Rachat total", "rachat programmé", "Transfert externe sortant", "Paiement dossier sinistre", "Transfert interne sortant",
              "Frais de mandat", "Frais sur investissement", "Frais de gestion", "xx Frais Rachat", "inconnu"]
    df = rows("LB_TYPE_FLUX string, LB_TYPE_MVT string, MT_BRUT int", *[(text, "RAG", 1) for text in labels])
    out = rb.SYSTEM1_BUCKETS.aggregate(df.withColumn("g", F.lit(1)), ["g"]).first().asDict()
    assert out["Versement_Initial"] == 2 and out["Collecte_Brute_TOTALE"] == 5 and out["Rachat"] == 3 and out["Prestation_TOTALE"] == 5
    assert out["Arbitrage_Entrant_RAG"] == 1 and out["Arbitrage_Entrant_Client"] == 0
    assert [out[f] for f in ("Frais_Mandat", "Frais_Acquisition", "Frais_Gestion", "Frais_Rachat")] == [1, 1, 1, 1]


def test_channel_table_and_lists():
    channels = rb.channel_rows(rb.Names(house="ACME"))
    assert len(channels) == 39 and channels[0][0] == "001" and channels[38] == ("039", "ACME PJ", "")
    assert channels[34] == ("035", "CGPI", "RESEAU TIERS") and channels[23][1] == "ACME PARTENAIRE"
    assert len(rb.SPECIFIC_SYSTEM1) == 19 and len(rb.SPECIFIC_SYSTEM2) == 26 and len(rb.SPECIFIC_SYSTEM3) == 10


def test_text_label_and_default_do_not_mix_types(rows):
    df = rows("indicateurs_L4_LBR_DESC string", ("Emissions Vie VLP",), ("x",), (None,))
    assert [r[0] for r in df.select(rb.ISSUE_DETAIL.column()).collect()] == ["Emissions Vie VLP", "0", "0"]


def test_literals_of_predicates():
    text = both(one_of("c", ["a (b)", "it's"]), either("d = 'x'", has_text("e", "y)")), "n > 3")
    assert [(x.column, x.value) for x in literals(text)] == [("c", "a (b)"), ("c", "it's"), ("d", "x"), ("e", "y)")]
    assert literals("n > 3") == [] and [x.value for x in literals(none_of("c", ["z"]))] == ["z"]


def test_rule_hits_tell_dead_rules_and_unseen_values(rows):
    inner = RuleSet([("v > 1", "big"), (one_of("c", ["b", "q"]), "other")], "small")
    rules = RuleSet([(one_of("c", ["a", "b"]), inner), ("c = 'b'", "behind"), ("c = 'z'", "nothing"), ("c IS NULL", "none")], "rest")
    df = rows("c string, v int", ("a", 1), ("a", 2), ("b", 1), ("b", None), (None, 1), ("w", 9))
    found = {r["rule"]: (r["label"], r["matched"], r["won"], r["unseen"]) for r in rule_hits(df, rules).collect()}
    assert found == {
        "1": ("", 4, 4, []), "1.1": ("big", 1, 1, []), "1.2": ("other", 2, 2, ["q"]), "2": ("behind", 2, 0, []), "3": ("nothing", 0, 0, ["z"]), "4": ("none", 1, 1, []),
    }
    buckets = BucketSet([("A", "c = 'a'", 1), ("A", "v = 2", -1), ("B", "c = 'a'", 1)], "v")
    assert [(r["rule"], r["label"], r["matched"], r["won"]) for r in rule_hits(df, buckets).collect()] == [("1", "A", 2, 2), ("2", "-A", 1, 0), ("3", "B", 2, 2)]
    assert [r["matched"] for r in rule_hits(df.filter("false"), buckets).collect()] == [0, 0, 0]


def test_every_rule_of_the_rulebook_can_be_hit(spark):
    """Stand-in rows made from the tables themselves: each value occurs and each rule of these tables decides a row."""
    numbers = spark.range(4000)
    sets = {"segments": rb.SEGMENT_PRIORITY, "mandate": rb.MANDATE, "convention": rb.CONVENTION, "file": rb.FILE_NETWORK, "campaign": rb.CAMPAIGN_NETWORK, "title": rb.TITLE_3,
            "network": rb.canonical_network(rb.DEFAULT_NAMES), "system1": rb.SYSTEM1_BUCKETS}
    fixed = {"mandate": {"LB_PACK": F.lit(None).cast("string")}, "file": {"RESEAU": F.element_at(F.array(*[F.lit(x) for x in (
        "AEP", "AGA", "Agents LU", "A2P", "CGP", "Direct", "#NA", "xPart.")]), (F.col("id") % 8 + 1).cast("int"))},
        "system1": {"LB_TYPE_MVT": F.element_at(F.array(F.lit("RAG"), F.lit("RAGALD"), F.lit("Désinvestissement échu"), F.lit("x")), (F.expr("id div 40") % 4 + 1).cast("int"))}}
    for name, rules in sets.items():
        hits = rule_hits(with_each_literal(numbers, rules, F.col("id"), fixed.get(name, {})), rules).collect()
        assert all(r["won"] > 0 and r["unseen"] == [] for r in hits), name
