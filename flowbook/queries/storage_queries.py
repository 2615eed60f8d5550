"""Saving, replacing, removing and exporting tables, each read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import Period
from ..session import working_folder
from ..sources.tables import drop_month, export_csv, overwrite_report, read_table, write_month, write_table
from .registry import query, shown, table


@query("saved_table", "SELECT o_orderstatus, COUNT(*) AS orders FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1")
def saved_table(spark, sf_dir):
    """An intermediate table saved under a catalog name, replaced, and read by that name."""
    schema = "flowbook_" + spark.sparkContext.applicationId.replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{working_folder(spark, 'catalog')}'")
    counted = table(spark, sf_dir, "orders").groupBy("o_orderstatus")
    write_table(counted.agg(F.lit(0).alias("orders")), f"{schema}.order_counts")
    kept = table(spark, sf_dir, "orders").filter("o_orderpriority <> '5-LOW'").groupBy("o_orderstatus").agg(F.count("*").alias("orders"))
    write_table(kept, f"{schema}.order_counts")
    return shown(read_table(spark, f"{schema}.order_counts"))


@query("archived_versions", "SELECT c_mktsegment AS segment, COUNT(*) AS versions FROM customer GROUP BY 1")
def archived_versions(spark, sf_dir):
    """A snapshot table read with every version of its rows."""
    folder = working_folder(spark, "versions")
    table(spark, sf_dir, "customer").withColumn("version", F.make_date(F.lit(2000), F.col("c_nationkey") % 12 + 1, F.lit(1))).write.parquet(folder)
    rows = read_table(spark, folder, snapshot_col="version", archive=True)
    return shown(rows.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("versions")))


@query("replaced_report", "SELECT s_nationkey AS nation, COUNT(*) AS suppliers, CAST(MAX(s_acctbal) AS DOUBLE) AS best FROM supplier GROUP BY 1")
def replaced_report(spark, sf_dir):
    """A reporting table replaced together with its schema, sorted for presentation."""
    folder = working_folder(spark, "report")
    grouped = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation"))
    overwrite_report(grouped.agg(F.count("*").alias("old_count")), folder)
    overwrite_report(grouped.agg(F.count("*").alias("suppliers"), F.max("s_acctbal").alias("best")), folder, order_by=["nation"])
    return shown(spark.read.parquet(folder))


@query("removed_month", """
SELECT CAST(strftime(date_trunc('month', o_orderdate), '%Y%m') AS VARCHAR) AS month, COUNT(*) AS orders FROM orders
WHERE date_trunc('month', o_orderdate) IN (DATE '1997-01-01', DATE '1997-03-01') GROUP BY 1
""")
def removed_month(spark, sf_dir):
    """Three months stored, the second removed in place."""
    root = working_folder(spark, "months")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    for month in (1, 2, 3):
        period = Period(1997, month)
        write_month(orders.filter(F.trunc("day", "month") == F.make_date(F.lit(1997), F.lit(month), F.lit(1))), root, period)
    drop_month(spark, root, Period(1997, 2))
    kept = spark.read.parquet(root)
    return shown(kept.groupBy(F.regexp_replace(F.col("func_month").cast("string"), "-", "").alias("month")).agg(F.count("*").alias("orders")))


@query("exported_csv", """
SELECT n_name AS nation, strftime(MIN(o_orderdate), '%d/%m/%Y') AS first_day, COUNT(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1
""")
def exported_csv(spark, sf_dir):
    """A sorted result exported as CSV, read back as written."""
    folder = working_folder(spark, "export")
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    named = orders.join(customers, orders.o_custkey == customers.c_custkey).join(nations, F.col("n_nationkey") == F.col("c_nationkey"))
    result = named.groupBy(F.col("n_name").alias("nation")).agg(F.min(F.col("o_orderdate").cast("date")).alias("first_day"), F.count("*").alias("orders"))
    export_csv(result, folder, order_by=["nation"])
    return shown(spark.read.option("header", True).option("sep", ";").schema("nation string, first_day string, orders long").csv(folder))
