"""Reading and writing tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import Period
from ..operators.positions import as_of_snapshot


def read_table(
    spark: SparkSession,
    name: str,
    *,
    snapshot_col: str | None = None,
    limit: dt.date | str | None = None,
    archive: bool = False,
) -> DataFrame:
    """A table by path or catalog name.

    With a snapshot column: ``archive`` reads every version, ``limit`` the newest snapshot
    on or before that date, and neither the newest of all.
    """
    table = spark.read.parquet(name) if "/" in name else spark.table(name)
    if snapshot_col is None or archive:
        return table
    return as_of_snapshot(table, snapshot_col, limit or dt.date(9999, 12, 31))


def read_day(spark: SparkSession, root: str, day: dt.date, columns: Sequence[str] = (
    "func_partitioning_year", "func_partitioning_month", "func_partitioning_day",
)) -> DataFrame:
    """One daily partition of a table laid out as year / year-month / date.

    The root is read and the partition columns are filtered, so other days are pruned.
    Partition values come back with inferred types, hence the casts to text.
    """
    wanted = (f"{day:%Y}", f"{day:%Y-%m}", f"{day:%Y-%m-%d}")
    table = spark.read.parquet(root)
    for column, value in zip(columns, wanted):
        table = table.filter(F.col(column) == F.lit(value).cast(table.schema[column].dataType))
    return table.drop(*columns)


def read_month(spark: SparkSession, root: str, period: Period, column: str = "func_month") -> DataFrame:
    """One month of a monthly store; the key is text whatever the directory name looks like."""
    table = spark.read.parquet(root)
    typed = F.lit(period.key).cast(table.schema[column].dataType)
    return table.filter(F.col(column) == typed).withColumn(column, F.lit(period.key))


def write_table(df: DataFrame, name: str) -> None:
    """Replace an intermediate table."""
    df.write.format("parquet").mode("overwrite").saveAsTable(name)


def write_month(df: DataFrame, root: str, period: Period, column: str = "func_month", within: Sequence[Column | str] = ()) -> None:
    """Store a month; a second run replaces that month and no other.

    Rows are sorted inside each written file by ``within``, which keeps later reads on
    those columns cheap without a global sort.
    """
    tagged = df.withColumn(column, F.lit(period.key))
    if within:
        tagged = tagged.sortWithinPartitions(*within)
    _replace_partitions(tagged, root, [column])


def write_partitions(df: DataFrame, root: str, columns: Sequence[str], spread: Sequence[str] = ()) -> None:
    """Write partitions, replacing exactly those that the frame has.

    Rows are rebalanced by partition first: small partitions get one file, and a partition
    that holds most of the rows is split over several tasks.  It is split between the tasks that made its rows; what
    one of them made stays together.  For a few large partitions, ``spread`` names columns by which the rows of a
    partition are dealt too, so that no task sorts all that one task made; each task may then write every partition.
    """
    _replace_partitions(df.hint("rebalance", *columns, *spread), root, columns)


def _replace_partitions(df: DataFrame, root: str, columns: Sequence[str]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(root)
    )


def overwrite_report(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """Replace a reporting table together with its schema; ``order_by`` sorts the whole table for presentation.

    The new files are written beside the table and take its place by two renames, so a reader lists either the old table
    or the new one, and a job that fails leaves the old one as it was.
    """
    staged, retired = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}", f"{path.rstrip('/')}.retired-{uuid.uuid4().hex}"
    (df.orderBy(*order_by) if order_by else df).write.parquet(staged)
    if _moved(df.sparkSession, path, retired):
        try:
            _moved(df.sparkSession, staged, path, needed=True)
        except Exception:
            _moved(df.sparkSession, retired, path)
            raise
        _removed(df.sparkSession, retired)
    else:
        _moved(df.sparkSession, staged, path, needed=True)


def drop_month(spark: SparkSession, root: str, period: Period, column: str = "func_month") -> bool:
    """Remove one month of a store; whether it was there.  No file of another month is read or written.

    The month's folder first gets a hidden name, which readers skip, so no reader lists half of it.
    """
    hidden = f"{root.rstrip('/')}/_removed-{uuid.uuid4().hex}"
    if not _moved(spark, f"{root.rstrip('/')}/{column}={period.key}", hidden):
        return False
    _removed(spark, hidden)
    return True


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _file_system(spark, path)
    return files.exists(at)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _moved(spark: SparkSession, source: str, target: str, needed: bool = False) -> bool:
    """Rename a folder; whether it was there."""
    at, files = _file_system(spark, source)
    if not files.exists(at):
        if needed:
            raise FileNotFoundError(source)
        return False
    if not files.rename(at, _file_system(spark, target)[0]):
        raise OSError(f"could not rename {source} to {target}")
    return True


def _removed(spark: SparkSession, path: str) -> None:
    at, files = _file_system(spark, path)
    files.delete(at, True)


def export_csv(df: DataFrame, path: str, sep: str = ";", order_by: Sequence[str] = ()) -> None:
    """Export a result as CSV files, dates as dd/MM/yyyy; with ``order_by`` the files follow that order."""
    if order_by:
        df = df.orderBy(*order_by)
    dates = {f.name: F.date_format(f.name, "dd/MM/yyyy") for f in df.schema.fields if isinstance(f.dataType, T.DateType)}
    (df.withColumns(dates) if dates else df).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def declared(columns: Mapping[str, str]) -> str:
    """A schema, as DDL text, from name -> type."""
    return ", ".join(f"`{name}` {type_}" for name, type_ in columns.items())
