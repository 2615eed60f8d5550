"""Run registered queries beside their SQL in DuckDB and compare the rows.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")


def connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return names, sorted(found, key=repr)


def compare(spark, con, name: str, sf_dir: str, query, sql: str) -> tuple[bool, str, float, float]:
    start = time.time()
    df = query(spark, sf_dir)
    spark_rows = df.collect()
    spark_seconds = time.time() - start
    start = time.time()
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    sql_types = [str(d[1]) for d in result.description]
    sql_rows = result.fetchall()
    sql_seconds = time.time() - start
    n1, r1 = sorted_rows(df.columns, spark_rows)
    n2, r2 = sorted_rows(sql_columns, sql_rows)
    if n1 != n2:
        return False, f"columns {set(n1) ^ set(n2)}", spark_seconds, sql_seconds
    integral = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    odd = [f"{c}: {integral[c]} / {t}" for c, t in zip(sql_columns, sql_types)
           if (integral[c] in ("int", "bigint")) != (t in ("BIGINT", "INTEGER", "NUMBER") ) and "INT" in t + integral[c].upper()]
    if "HUGEINT" in sql_types:
        odd.append("HUGEINT")
    if len(r1) != len(r2):
        return False, f"rows {len(r1)} / {len(r2)} {odd}", spark_seconds, sql_seconds
    for a, b in zip(r1, r2):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(n1, a, b) if x != y]
            return False, f"{diff[:6]} {odd}", spark_seconds, sql_seconds
    return True, f"{len(r1)} rows {odd or ''}", spark_seconds, sql_seconds


def main(argv):
    from flowbook.queries import ORACLES, QUERIES
    from flowbook.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(QUERIES)
    spark = build_session("oracle", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
                          spark_driver_memory="8g", spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(sf_dir)
    bad = 0
    for name in wanted:
        try:
            if name in ORACLES:
                ok, text, a, b = compare(spark, con, name, sf_dir, QUERIES[name], ORACLES[name])
            else:
                start = time.time()
                ok, text, a, b = True, f"{len(QUERIES[name](spark, sf_dir).collect())} rows, no oracle", time.time() - start, 0
        except Exception as error:  # report and go on with the next query
            ok, text, a, b = False, f"{type(error).__name__}: {str(error)[:700]}", 0, 0
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} spark {a:6.2f}s sql {b:6.2f}s  {text}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
