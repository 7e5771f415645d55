"""Time the headline queries: one warm-up run, then the median of three; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from slumptrace.session import build_session
from slumptrace.workload.queries import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINES = (
    "scan_swap_logs", "latest_swaps_topn", "swaps_in_window", "decode_amounts_abi", "crisis_buys", "stage_buys",
    "peak_after_buy", "estimated_pnl", "wallet_leaderboard", "leaderboard_trades", "build_pools", "pool_activity",
    "crisis_move_check", "crisis_phase", "detect_crises", "validate_buys", "word_topk", "wallet_labels",
)


def main() -> None:
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINES)
    spark = build_session(**{
        "spark.master": f"local[{CPUS}]",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "sum over queries of the median warm wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
