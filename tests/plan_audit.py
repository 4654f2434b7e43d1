"""Physical-plan audit of every catalogue query (script).

Flags nested-loop / cartesian joins, Python evaluation, and single-partition
exchanges, which should only appear over calendar-bounded or one-row data."""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BAD = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def main(argv):
    from quarry.catalog import load_all
    from quarry.session import Tables, build_session
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan, every exchange visible
    for k, e in sorted(load_all().items()):
        try:
            p = plan_text(e.fn(Tables(spark, sf)))
        except Exception as exc:  # noqa: BLE001
            print(f"{k}: ERROR {str(exc)[:200]}")
            continue
        flags = [b for b in BAD if b in p]
        single = p.count("SinglePartition")
        ex = p.count("Exchange")
        print(f"{k}: exchanges={ex} single_partition={single} {' '.join(flags)}")


if __name__ == "__main__":
    main(sys.argv)
