"""CSV files, and the choice of monthly files by their names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import Period
from ..functions.codes import parse_number, parsed_date

# Fixed pattern of a monthly file name: kind, month, year.  The name may be a file, or a folder
# of part files as Spark writes them.
MONTHLY_NAME = r"([A-Za-z]+)_(\d{1,2})_(\d{4})\.csv(?:/|$)"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, sep: str = ";") -> DataFrame:
    """CSV with a header and a declared schema: no inference pass, and no type that varies by file.

    The header of every file is checked against the schema.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return (
        spark.read.schema(schema)
        .option("header", True).option("sep", sep).option("enforceSchema", False)
        .csv(paths)
    )


# A writing task keeps so many files open.
OPEN_FILES = 128


def write_by_file(df: DataFrame, root: str, column: str = "file", sep: str = ";") -> None:
    """CSV with a header, one folder for each value of ``column``.

    Rows are not sorted by ``column`` for it: a task has a writer for each file it meets, so its memory does not grow with
    its rows and it does not spill.  Only the rows of files beyond ``OPEN_FILES`` in one task are sorted, by Spark.
    """
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, str(OPEN_FILES))
    try:
        df.write.partitionBy(column).mode("overwrite").option("header", True).option("sep", sep).csv(root)
    finally:
        conf.set(name, before)


CORRUPT, REASONS = "_corrupt_line", "_reasons"


@dataclass(frozen=True)
class RowRules:
    """What a line must hold: readable amounts and dates, filled columns, values of a list.

    An empty or null amount or date is missing, not unreadable; name it in ``required`` if it must be there.
    """

    amounts: Sequence[str] = ()
    dates: Mapping[str, str] = field(default_factory=dict)
    required: Sequence[str] = ()
    domains: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def reasons(self) -> Column:
        """The reason codes of a row in a fixed order; empty for a good one.

        A line with a wrong number of fields has that one reason: its columns are not where they belong.
        """
        def said(column: str) -> Column:
            return F.coalesce(F.trim(column) != "", F.lit(False))

        found = [F.when(~said(c), F.lit(f"missing:{c}")) for c in self.required]
        found += [F.when(said(c) & parse_number(c).isNull(), F.lit(f"unreadable:{c}")) for c in self.amounts]
        found += [F.when(said(c) & parsed_date(c, pattern).isNull(), F.lit(f"unreadable:{c}")) for c, pattern in self.dates.items()]
        found += [F.when(said(c) & ~F.col(c).isin(*values), F.lit(f"outside:{c}")) for c, values in self.domains.items()]
        own = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
        return F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit("field_count"))).otherwise(own)


def read_csv_lines(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, sep: str = ";", header: bool = True) -> DataFrame:
    """CSV as ``read_csv`` gives it, with the whole line in ``_corrupt_line`` where its number of fields is not the schema's."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.schema(T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())]))
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("sep", sep)
    return (reader.option("header", True).option("enforceSchema", False) if header else reader.option("header", False)).csv(paths)


def split_lines(lines: DataFrame, rules: RowRules, folder: str) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejected rows of ``read_csv_lines``, from one scan of the files.

    Both are written to ``folder`` in one job, parted by whether a row has a reason, and read back from there.
    Good rows have the file's columns; rejected ones ``file_name, line, reasons`` too (``line`` is the text itself where
    its number of fields is wrong, else the row written out again).
    """
    columns = [c for c in lines.columns if c != CORRUPT]
    judged = lines.select("*", F.col("_metadata.file_name").alias("_file"), rules.reasons().alias(REASONS)).withColumn("_rejected", F.size(REASONS) > 0)
    judged.write.mode("overwrite").partitionBy("_rejected").parquet(folder)
    stored = lines.sparkSession.read.schema(judged.schema).parquet(folder)
    again = F.to_csv(F.struct(*columns), {"sep": ";"})
    good = stored.filter(~F.col("_rejected")).select(*columns)
    rejected = stored.filter("_rejected").select(
        F.col("_file").alias("file_name"), F.coalesce(CORRUPT, again).alias("line"), F.col(REASONS).alias("reasons"), *columns,
    )
    return good, rejected


def reject_counts(rejected: DataFrame, *keys: str) -> DataFrame:
    """Rows per reason (a row with two reasons counts under both)."""
    return rejected.select(*keys, F.explode("reasons").alias("reason")).groupBy(*keys, "reason").agg(F.count(F.lit(1)).alias("rows"))


def file_names(spark: SparkSession, root: str) -> DataFrame:
    """The monthly files under a folder, with kind, month and year.

    Only the listing is read: the content column of the binary source is not selected.
    """
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(root).select("path")
    )
    return listing.select(
        F.regexp_extract("path", f"^(.*?{MONTHLY_NAME})", 1).alias("path"),
        F.regexp_extract("path", MONTHLY_NAME, 1).alias("kind"),
        F.regexp_extract("path", MONTHLY_NAME, 2).try_cast("int").alias("month"),
        F.regexp_extract("path", MONTHLY_NAME, 3).try_cast("int").alias("year"),
    ).filter(F.col("month").isNotNull()).distinct()


def chosen_files(names: DataFrame, today: Period, legacy: bool = False) -> DataFrame:
    """Every December of past years; and, unless it is January, the newest month of this year of each kind.

    ``legacy`` takes the newest month over all kinds together: a kind that is a month behind is then left out.
    """
    current = names.filter(F.col("year") == today.year)
    december = (F.col("year") < today.year) & (F.col("month") == 12)
    if today.month == 1:
        return names.filter(december)
    if legacy:
        newest = current.agg(F.max("month")).scalar()
        return names.filter(december | ((F.col("year") == today.year) & (F.col("month") == newest)))
    newest = current.groupBy(F.col("kind").alias("__kind")).agg(F.max("month").alias("__newest"))
    known = names.join(newest, F.col("kind") == F.col("__kind"), "left")
    return known.filter(december | ((F.col("year") == today.year) & (F.col("month") == F.col("__newest")))).drop("__kind", "__newest")


def read_monthly_files(spark: SparkSession, root: str, schemas: dict[str, T.StructType | str], today: Period) -> DataFrame:
    """The chosen files of every kind, stacked by name, with provenance columns.

    The list of paths is as long as the number of chosen files (one per kind and year), so
    it goes to the reader as any file listing does.  Month and year come from each
    file's own name.
    """
    chosen = chosen_files(file_names(spark, root), today)
    paths: dict[str, list[str]] = {}
    for row in chosen.select("kind", "path").collect():
        paths.setdefault(row.kind, []).append(row.path)
    frames = [with_provenance(read_csv(spark, sorted(found), schemas[kind]), today) for kind, found in sorted(paths.items())]
    if not frames:
        raise FileNotFoundError(f"no monthly file to read under {root}")
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def with_provenance(df: DataFrame, today: Period) -> DataFrame:
    path = F.col("_metadata.file_path")
    part = [F.regexp_extract(path, MONTHLY_NAME, i) for i in (1, 2, 3)]
    return df.select(
        "*",
        F.concat(F.concat_ws("_", *part), F.lit(".csv")).alias("periode"),
        part[1].cast("int").alias("mois_fichier"),
        part[2].cast("int").alias("annee_fichier"),
        F.lit(today.month).alias("mois_actuel"),
        F.lit(today.year).alias("annee_actuelle"),
    )
