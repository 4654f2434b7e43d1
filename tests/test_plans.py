"""Plan assertions: pushdown, pruning, and no nested-loop / cartesian /
Python evaluation in any catalogue query."""
import pytest

from quarry.catalog import load_all
from quarry.session import Tables

REG = load_all()
BAD = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")
SKIP = {k for k in REG if k.startswith("stream_") or k.startswith("scan_csv") or k in (
    "sink_csv", "sink_parquet", "scan_json", "sink_json", "dq_compare_frames")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(REG) - SKIP))
def test_no_bad_operators(spark, key):
    p = plan(REG[key].fn(Tables(spark, "/root/testdata/sf0.001")))
    assert not [b for b in BAD if b in p], p


def test_sargable_range_pushed(spark):
    p = plan(REG["filter_sargable_range"].fn(Tables(spark, "/root/testdata/sf0.001")))
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_projection_pruned(spark):
    p = plan(REG["select_cols"].fn(Tables(spark, "/root/testdata/sf0.001")))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p


def test_hot_key_windows_partition_by_bucket(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(REG["form_prev5"].fn(Tables(spark, "/root/testdata/sf0.001")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "hashpartitioning(team_id" in p and "__b" in p


def test_global_rank_has_no_unbounded_single_partition_window(spark):
    # the only single-partition windows run over the per-bucket count table
    from quarry.operators.windows import global_rank
    df = spark.range(10000).selectExpr("id", "id % 13 as v")
    p = plan(global_rank(df, [("v", True), ("id", True)], "row_number", "rn"))
    lines = p.splitlines()
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert singles
    # every single-partition exchange sits on an aggregate (one row per
    # range bucket, or one row in all), never on the rows themselves
    for i in singles:
        assert "Aggregate" in lines[i + 1], lines[i:i + 2]


def test_sketches_are_kept_per_status_only(spark):
    # beside countDistinct the plan had a sketch of 13 KB for every (status, customer)
    p = plan(REG["agg_count_distinct_error"].fn(Tables(spark, "/root/testdata/sf0.001")))
    sketches = [line for line in p.splitlines() if "approx_count_distinct" in line or "hyperloglog" in line.lower()]
    assert sketches and not [line for line in sketches if "keys=[o_orderstatus" in line and "o_custkey" in line.split("functions=")[0]]


def test_rows_are_not_gathered_by_category(spark):
    # three flags in all: a join on the flag gave a task a third of the rows
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # nothing is taken for small by its size
    try:
        plans = {c: plan(REG[k].fn(Tables(spark, "/root/testdata/sf0.001")))
                 for k, c in (("downcast_numeric", "l_returnflag"), ("category_codes", "o_orderpriority"))}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for col, p in plans.items():
        assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and f"hashpartitioning({col}" not in p, p
