"""The corpus pipeline: quality rules, near duplicates, repeated passages, mixing, packing.

``STAGES`` are applied in order to ``documents``; each writes its rows as Parquet, which the next one reads.

All stages take any documents: null and empty texts, texts of any length (whole ones are worked on, a slice or one
text at a time), repeated rows and rows with one or no ``doc_id`` (told apart by their text), further columns under
any name (they travel in one struct and come back unchanged), and no rows at all (they give none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowbook.llm import chosen_path, entropy_balancing, mixture_packing, ngram_quality, recompression
from flowbook.session import remove_folder, working_folder

# Spark's least id stands for a null one in keys; ids of documents are not negative.
_NO_ID = -(1 << 63)


def _keys(docs: DataFrame, text_hash: str | None = None) -> DataFrame:
    """``row`` (all columns as one struct) with ``_k1, _k2``: the id and a hash of the text, never null."""
    digest = F.xxhash64("text") if text_hash is None else F.col(text_hash)
    return docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_k1"), digest.alias("_k2"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or score below the threshold go.

    A null or empty text has no words, so it goes.  A score at the threshold stays.  Repeated rows share their verdict.
    Without labels of both kinds only the base rules drop documents.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    kept = _keys(ngram_quality.judge(docs, labels).where("kept"), "_h").select("_k1", "_k2")
    return _keys(docs).join(kept, ["_k1", "_k2"], "left_semi").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents the one with the smallest id stays; documents without words stay.

    A null id comes after all others.  Of several texts with the class's smallest id the one with the least hash stays,
    and of repeated rows one.
    """
    found = _keys(chosen_path.join(docs).where("keeps"), "th")
    chosen = found.where("row.tid IS NOT NULL").groupBy("row.tid").agg(F.min("_k1").alias("_k1"), F.min("_k2").alias("_k2")).select("_k1", "_k2", F.lit(True).alias("_one"))
    wordless = found.where("row.tid IS NULL").select("_k1", "_k2", F.lit(False).alias("_one")).distinct()
    joined = _keys(docs).join(chosen.unionByName(wordless), ["_k1", "_k2"])
    number = F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy(F.lit(1)))  # repeated rows are equal
    return joined.withColumn("_number", number).where("_number = 1 OR NOT _one").select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated windows go; a document of which nothing is left goes, others without repeats stay as they are.

    The document with the smallest id keeps a window; a document without an id loses nothing, and rows with one id take
    nothing from each other.  A cut text is its kept words joined by one space, and ``n_chars`` follows it.
    """
    found = recompression.remove_repeats(docs, carry=docs.columns).where("n_removed = 0 OR n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("c_text")).alias("text")
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("c_n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    own = {"text": text, "n_chars": n_chars}
    return found.select(*[own[c] if c in own else F.col(f"`c_{c}`").alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target rate gives it copies.

    A null source is a source of its own; a document without words takes no words, and copies by the rate of its source
    like any other (none where the source has no words).  Repeated rows get copies each.
    """
    mixed = entropy_balancing.mix(docs.select("doc_id", "text", "source", "lang", F.struct("*").alias("row")), keep=["row"])
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 4096 tokens; a document without words is its end id alone."""
    return mixture_packing.pack(docs)


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mixing", mixing), ("packing", packing),
]
ORACLE_SQL = None  # hashed scores, sampled paths and rounding are not SQL; the tests compare each stage with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; a stage's table is deleted once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        made, folder = stage(spark, docs, sf_dir), working_folder(spark, name)
        made.write.mode("overwrite").parquet(folder)
        docs = spark.read.schema(made.schema).parquet(folder)
        if before is not None:
            remove_folder(spark, before)
        before = folder
    return docs
