"""Headline queries, timed on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

The first execution of each query is timed from building the plan to having computed every
row (the noop sink), so plan building and code generation are in the numbers.
"""

from __future__ import annotations

import json
import os
import re
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# monthly_base runs before the reports: they answer from the stored base, as in the monthly workflow.
HEADLINE = (
    "flow_buckets", "flow_two_stage", "settled_flows", "gross_up", "movement_dedupe", "current_else_archive", "open_close_history", "positions_flows",
    "drop_inactive", "lookup_chain", "cube_basic", "surrender_study", "cube_budget", "backfill_ytd", "backfill_ledger", "csv_report",
    "system1_base", "system2_base", "system3_base", "monthly_base", "market_report", "finance_extract_1",
)


def main() -> None:
    from flowbook.queries import QUERIES
    from flowbook.session import build_session, clear_working_folder

    spark = build_session(
        "bench", f"local[{CPUS}]", spark_sql_shuffle_partitions=CPUS, spark_ui_enabled="false", spark_driver_memory="12g",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    sf = re.search(r"sf([\d.]+)", SF_DIR)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(sf.group(1)) if sf else None,
    }))
    clear_working_folder(spark)
    spark.stop()


if __name__ == "__main__":
    main()
