"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion into Spark's ``noop`` sink (full execution, no
collect).  One warm-up pass, then the best of $BENCH_REPS timed runs per
query.  Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "match_features", "league_table", "form_prev5", "odds_last_prematch", "elo_delta", "h2h_last5",
    "available_players", "dq_no_injury_report", "join_role_in", "asof_backward", "asof_nokey",
    "win_rank_dense", "win_ntile", "global_row_number", "win_running_total", "revenue_month_category",
    "unpaid_orders", "retention", "agg_percentiles", "gaps_islands", "pivot_fill_total", "dq_time_order",
    "word_count", "email_scan", "brackets_unbalanced",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "2"))
    from quarry.catalog import load_all
    from quarry.session import Tables, build_session
    reg = load_all()
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k in reg]

    def run(k):
        t0 = time.perf_counter()
        reg[k].fn(Tables(spark, sf_dir)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for k in keys:  # warm-up: JIT, file listing, metadata caches
        run(k)
    times = {k: round(min(run(k) for _ in range(reps)), 3) for k in keys}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
