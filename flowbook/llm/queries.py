"""The operators over the test tables; result digests are derived here from the operators' own outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import working_folder
from . import bwt_merge, chosen_path, entropy_balancing, host_reputation, mixture_packing, ngram_quality, piece_table, pivot_distance, recompression, spill_counts, stable_projection_nn, trie_counts, wavelet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_wavelet_shards")
def op1_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = working_folder(spark, "wavelet-shards")
    wavelet.write_shards(table(spark, sf_dir, "documents"), folder)
    return wavelet.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op3_mixture_packing")
def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = mixture_packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source",
    )


RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def _op4_sql() -> str:
    fits = " ".join(
        f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
        for r, _ in sorted(RULES, key=lambda r: -len(r[0]))
    )
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES)

    def strength(table: str) -> str:
        return f"""(SELECT CASE WHEN m < 2 OR total IS NULL THEN 1e6 WHEN room <= 0 OR excess / room <= 1e-6 THEN 1e6
            ELSE greatest(1 / greatest(excess / room, 1e-12) - 1, 1.0) END AS k FROM (
            SELECT *, parts - good * good / total - noise * (m - 1) AS excess, noise * (total - squares / total - (m - 1)) AS room
            FROM (SELECT *, good / total * (1 - good / total) AS noise FROM (
            SELECT count(*)::DOUBLE AS m, sum(n)::DOUBLE AS total, sum(n::DOUBLE * n) AS squares, sum(good)::DOUBLE AS good,
            sum(good::DOUBLE * good / n) AS parts FROM {table} WHERE n > 0))))"""

    return f"""
    WITH seen AS (
      SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?:.|\\n)*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '^(?:.|\\n)*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
    ruled AS (SELECT *, CASE {fits} END AS rule FROM seen),
    hosts AS (
      SELECT host, CASE WHEN address OR NOT contains(site, '.') THEN site ELSE split_part(site, '.', -2) || '.' || split_part(site, '.', -1) END AS domain,
             CASE WHEN address THEN site ELSE split_part(site, '.', -1) END AS suffix, count(quality) AS n, coalesce(sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END), 0) AS good
      FROM (SELECT *, regexp_matches(site, '^[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}$') OR starts_with(site, '[') AS address FROM (
        SELECT *, regexp_replace(regexp_replace(host, '^(?:.|\\n)*@', ''), ':[0-9]*$', '') AS site FROM seen))
      LEFT JOIN (SELECT * FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL) ON page_id = doc_id GROUP BY host, site, address),
    domains AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY ALL),
    suffixes AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM domains GROUP BY ALL),
    corpus AS (SELECT CASE WHEN sum(n) > 0 THEN sum(good)::DOUBLE / sum(n) ELSE 0.5 END AS corpus FROM suffixes),
    s AS (SELECT suffix, good AS sg, n AS sn, k AS sk, corpus FROM suffixes, {strength("suffixes")}, corpus),
    d AS (SELECT domain, good AS dg, n AS dn, k AS dk, (sg - good + sk * corpus) / (sn - n + sk) AS sm FROM domains JOIN s USING (suffix), {strength("domains")}),
    h AS (SELECT host, (good + k * (dg - good + dk * sm) / (dn - n + dk)) / (n + k) AS host_mean, n + k AS weight FROM hosts JOIN d USING (domain), {strength("hosts")})
    SELECT page_id, host, path, rule,
      coalesce(CASE rule {verdicts} END, CASE WHEN host_mean + 1.645 * sqrt(host_mean * (1 - host_mean) / (weight + 1)) < corpus THEN 'block' ELSE 'allow' END) AS verdict,
      host_mean, host_mean + 1.645 * sqrt(host_mean * (1 - host_mean) / (weight + 1)) AS host_upper
    FROM ruled JOIN h USING (host), corpus"""


@query("op4_host_reputation", _op4_sql())
def op4_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")
    outcomes = table(spark, sf_dir, "labels").where("quality IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").alias("page_id"), good)
    return host_reputation.judge(table(spark, sf_dir, "pages"), outcomes, RULES)


@query("op9_entropy_balancing")
def op9_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy_balancing.mix(table(spark, sf_dir, "documents"), keep=["doc_id", "source"])


@query("op2_ngram_quality")
def op2_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = ngram_quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score", "threshold",
    )


@query("op6_trie_token_counts")
def op6_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_counts.token_counts(table(spark, sf_dir, "documents"))


@query("op7_stable_projection_nn")
def op7_stable_projection_nn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable_projection_nn.search(table(spark, sf_dir, "embeddings"))


@query("op5_chosen_path_join")
def op5_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_texts")


@query("op8_recompression_dedup")
def op8_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompression.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op10_bwt_merge_dedup")
def op10_bwt_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bwt_merge.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_pivot_distance")
def op11_pivot_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_distance.search(table(spark, sf_dir, "embeddings"))


@query("op12_spill_alignment")
def op12_spill_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spill_counts.align(table(spark, sf_dir, "documents"))


def _op13_sql() -> str:
    plain = " OR ".join(["t = ''", *[f"contains(t, '{s}')" for s in piece_table.SENTINELS], "h3 % 100 >= 100"])
    return f"""
    WITH drawn AS (
      SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS s, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units FROM documents),
    numbers AS (
      SELECT doc_id, t, units, len(units) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2, ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM drawn),
    formed AS (
      SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, CASE WHEN {plain} THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
    parts AS (
      SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM formed)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
      sha256(t) AS restored_sha256
    FROM parts"""


@query("op13_piece_table", _op13_sql())
def op13_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = piece_table.transform(table(spark, sf_dir, "documents")).drop("pieces")
    return piece_table.restore(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
