"""Compare registered queries with their SQL counterparts: python scripts/compare.py FOLDER [NAME ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from slumptrace.session import build_session  # noqa: E402
from scripts.differences import differences, open_oracle  # noqa: E402
from slumptrace.workload.oracles import ORACLES  # noqa: E402
from slumptrace.workload.queries import QUERIES  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = build_session(**{
        "spark.master": "local[8]", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    oracle: duckdb.DuckDBPyConnection = open_oracle(folder)
    failed = 0
    for name in names or QUERIES:
        began = time.time()
        try:
            df = QUERIES[name](spark, folder)
            rows = df.collect()
        except Exception as error:
            print(f"{name:24} ERROR {str(error)[:1500]}")
            failed += 1
            continue
        took = time.time() - began
        began = time.time()
        found = differences(df.dtypes, rows, oracle, ORACLES[name]) if name in ORACLES else ["no SQL"]
        failed += bool(found)
        print(f"{name:24} {len(rows):7} rows {took:6.2f}s sql {time.time() - began:6.2f}s  {'ok' if not found else found}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
