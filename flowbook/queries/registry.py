"""Where queries register themselves, and small helpers they share."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query, with the SQL that must give the same rows."""
    def register(function: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


@lru_cache(maxsize=None)
def _read(application: str, spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table.  The reader is kept per application: its schema is read once, its data every time."""
    return _read(spark.sparkContext.applicationId, spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def shown(df: DataFrame) -> DataFrame:
    """Decimals as double and integers as bigint, the types results are compared in."""
    def typed(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.DecimalType):
            return f"CAST({name} AS DOUBLE) AS {name}"
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return f"CAST({name} AS BIGINT) AS {name}"
        return name

    return df.selectExpr(*[typed(f) for f in df.schema.fields])
