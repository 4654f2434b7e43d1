"""Range-based operators: ranks, fills, zips, hot buckets and quantiles, against plain windows, numpy and pandas."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import ranges as R
from quarry.operators.asof import asof_join
from quarry.operators.joins import merge_ordered_ffill
from quarry.operators.stats import quantiles, ranged_quantiles
from quarry.operators.windows import global_ffill, global_ranks, running_sum, trailing, zip_rows

KINDS = {"rn": "row_number", "rk": "rank", "dr": "dense_rank", "pr": "percent_rank", "nt": "ntile"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def uneven(spark):
    """30,000 rows: a third share one leading value, a sixth one whole key (v, w), some NULLs and NaNs."""
    df = spark.range(30_000).selectExpr(
        "id", "case when id % 3 = 0 then 5.0d when id % 97 = 1 then null when id % 89 = 2 then double('NaN') else (id * 7919) % 4001 end v",
        "case when id % 6 = 0 then 'k' when id % 53 = 0 then null else concat('k', id % 701) end w")
    return R.kept(df, "uneven")


@pytest.mark.parametrize("order", [[("v", True), ("w", True)], [("v", False), ("w", False)], [("w", False), ("v", True), ("id", False)]])
def test_global_ranks_equal_windows(uneven, order):
    got = global_ranks(uneven, order, KINDS, rows=500, ntiles=7)
    cols = [F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last() for c, up in order]
    w = Window.orderBy(*cols)
    want = uneven.select("*", F.row_number().over(w).alias("rn"), F.rank().over(w).alias("rk"), F.dense_rank().over(w).alias("dr"),
                         F.percent_rank().over(w).alias("pr"), F.ntile(7).over(w).alias("nt"))
    total = len(order) == 3                       # ties may be numbered in any order
    cmp = ["id", "rk", "dr", "pr"] + (["rn", "nt"] if total else [])
    a, b = (x.select(*cmp).toPandas().sort_values("id").reset_index(drop=True) for x in (got, want))
    assert np.allclose(a.astype(float), b.astype(float))
    assert sorted(got.toPandas().rn) == list(range(1, 30_001))


def test_no_range_holds_a_hot_value(uneven):
    for order in ([("v", True), ("id", True)], [("v", True), ("w", True)], [("v", False)]):
        ranges = R.Ranges(uneven, order, rows=500)
        sizes = [r["count"] for r in uneven.groupBy(ranges.number(uneven)).count().collect()]
        assert len(sizes) >= 40 and max(sizes) <= 4 * 500        # of 30,000 rows, a third of them with one value


def test_number_of_ranges_follows_the_data(spark):
    few, many = (R.Ranges(spark.range(n), [("id", True)], rows=100) for n in (100, 20_000))
    assert len(few.cuts) == R.FEWEST - 1 and len(many.cuts) == 199
    none = R.Ranges(spark.range(0), [("id", True)])
    assert none.cuts == [] and global_ranks(spark.range(0), [("id", True)], {"r": "rank"}).count() == 0


def test_order_key_sorts_as_the_order(spark):
    rows = [(None, None, None), (0.0, "", dt.date(2020, 1, 1)), (-1.5, "a", None), (float("nan"), "ab", dt.date(1960, 5, 5)),
            (float("inf"), "b", dt.date(2020, 1, 2)), (2.5, "aé", dt.date(2020, 1, 1)), (2.5, "a日", None)]
    df = spark.createDataFrame(rows, "x double, s string, d date").withColumn("n", F.monotonically_increasing_id())
    for col in ("x", "s", "d"):
        for up in (True, False):
            c = F.col(col).asc_nulls_first() if up else F.col(col).desc_nulls_last()
            want = [r.n for r in df.orderBy(c, "n").collect()]
            assert [r.n for r in df.orderBy(R.order_key(df, [(col, up)]), "n").collect()] == want


def test_ffill_equals_plain_window(spark):
    a = spark.range(0, 100_000, 2).selectExpr("id k", "case when id % 10 = 0 then id end x")
    b = spark.range(0, 100_000, 5).selectExpr("id k", "case when id > 60000 then id * 2 end y")
    got = merge_ordered_ffill(a, b, "k", ["x", "y"])
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    want = a.join(b, "k", "full").select("k", *[F.last(c, True).over(w).alias(c) for c in "xy"])
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == want.count()
    lines = plan(got).splitlines()
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert all("Aggregate" in lines[i + 1] for i in singles)       # one row a range, never the rows
    tiny = global_ffill(spark.createDataFrame([(None, 1, None), (2, None, "a"), (1, None, None)], "k int, v int, w string"),
                        [("k", True)], ["v", "w"])
    assert sorted(map(tuple, tiny.collect()), key=str) == sorted([(None, 1, None), (1, 1, None), (2, 1, "a")], key=str)


def test_zip_pads_the_shorter_side(spark):
    a, b = spark.range(5).selectExpr("10 - id as x"), spark.range(3).selectExpr("id as x", "id * 2 as y")
    got = sorted(map(tuple, zip_rows(a, b, [("x", True)], [("y", False)]).collect()))
    assert got == [(0, 6, 2, 4), (1, 7, 1, 2), (2, 8, 0, 0), (3, 9, None, None), (4, 10, None, None)]
    assert zip_rows(a, b.where("false"), [("x", True)], [("y", False)]).count() == 5


# hot buckets ---------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def one_day(spark):
    """A key with all its 3,000 rows on one day (300 of them at one instant), and a usual one."""
    rng = random.Random(8)
    day = dt.datetime(2024, 3, 5)
    rows = [("hot", day + dt.timedelta(seconds=rng.randrange(80_000)), i, rng.randrange(100)) for i in range(2700)]
    rows += [("hot", day + dt.timedelta(hours=9), 10_000 + i, i) for i in range(300)]
    rows += [("usual", day + dt.timedelta(days=rng.randrange(60)), 20_000 + i, rng.randrange(100)) for i in range(200)]
    rows += [(None, day + dt.timedelta(seconds=i), 30_000 + i, i) for i in range(120)]
    return R.kept(spark.createDataFrame(rows, "k string, t timestamp_ntz, id long, v long"), "one_day")


def test_hot_bucket_is_spread(one_day):
    df = one_day.withColumn("__b", F.date_trunc("month", "t"))
    cut = R.HotCuts([df], ["k"], ["t", "id"], limit=100)
    sizes = cut.assign(df).groupBy("k", "__b").count().collect()
    hot = [r["count"] for r in sizes if r.k == "hot"]
    assert cut and len(hot) >= 20 and max(hot) <= 400
    assert {r["__b"].piece for r in sizes if r.k == "usual"} <= {0, 1, 2}
    assert not R.HotCuts([df], ["k"], ["t", "id"], limit=10_000)


def test_hot_trailing_and_running(one_day):
    tr = trailing(one_day, ["k"], ["t", "id"], "t", -5, -1, {"a": (F.avg, "v"), "m": (F.max, "v")}, limit=100)
    rs = running_sum(one_day, ["k"], ["t", "id"], "t", "v", "s", limit=100)
    w = Window.partitionBy("k").orderBy("t", "id")
    want = one_day.select("id", F.avg("v").over(w.rowsBetween(-5, -1)).alias("a"), F.max("v").over(w.rowsBetween(-5, -1)).alias("m"),
                          F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    got = tr.select("id", "a", "m").join(rs.select("id", "s"), "id")
    assert got.exceptAll(want).count() == 0 and got.count() == one_day.count()


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("strict", [False, True])
def test_hot_asof(one_day, direction, strict):
    left, right = one_day.where("id % 3 > 0").select("k", "t", "id"), one_day.where("id % 3 = 0").select("k", F.col("t").alias("u"), "v")
    hot = asof_join(left, right, "t", "u", by=["k"], strict=strict, direction=direction, tolerance="6 hours", limit=100)
    plain = asof_join(left, right, "t", "u", by=["k"], strict=strict, direction=direction, tolerance="6 hours", limit=10 ** 9)
    assert hot.columns == plain.columns
    assert hot.exceptAll(plain).count() == plain.exceptAll(hot).count() == 0 and hot.count() == left.count()


# quantiles -----------------------------------------------------------------------------------------------------------

def test_ranged_quantiles(spark):
    rng = np.random.default_rng(2)
    groups = {"many": rng.normal(0, 1e6, 20_000).round(3), "same": np.full(5_000, 7.5), "two": np.array([1.0, 2.0]),
              "ties": rng.integers(0, 4, 9_000).astype(float), None: rng.random(11)}
    rows = [(k, float(x)) for k, xs in groups.items() for x in xs] + [("none", None), ("two", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}
    got = {r.k: tuple(r)[1:] for r in ranged_quantiles(df, "x", probs, ["k"]).collect()}
    assert got.pop("none") == (None,) * 5
    for k, xs in groups.items():
        assert got[k] == pytest.approx(tuple(np.quantile(xs, list(probs.values()))))
    whole = ranged_quantiles(df, "x", probs).first()
    assert tuple(whole) == pytest.approx(tuple(np.quantile(np.concatenate(list(groups.values())), list(probs.values()))))
    assert tuple(ranged_quantiles(df.where("false"), "x", probs).first()) == (None,) * 5
    assert ranged_quantiles(df.where("false"), "x", probs, ["k"]).count() == 0
    kept = R.kept(df, "small")                                    # small files take the one-aggregate way, same values
    small = {r.k: tuple(r)[1:] for r in quantiles(kept, "x", probs, ["k"]).collect()}
    assert small.pop("none") == (None,) * 5 and small.keys() == got.keys()
    for k, v in small.items():
        assert v == pytest.approx(got[k])
    assert tuple(quantiles(kept, "x", probs).first()) == pytest.approx(tuple(whole))
    assert tuple(quantiles(kept.where("false"), "x", probs).first()) == (None,) * 5


def test_quantiles_shuffle_only_hit_ranges(spark):
    df = R.kept(spark.range(200_000).selectExpr("id % 2 g", "double(hash(id)) x"), "q")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = ranged_quantiles(df, "x", {"m": 0.5}, ["g"])
        out.collect()
        p = plan(out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the rows meet the hit ranges by a broadcast join below the only exchange of rows, which is a partial aggregate's
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and "CartesianProduct" not in p


def test_sample_of_large_files_is_not_sent_by_every_task(spark, monkeypatch):
    monkeypatch.setattr(R, "SMALL_FILES", 0)
    monkeypatch.setattr(R, "SAMPLE", 500)
    df = spark.range(0, 40_000, 1, 40).selectExpr("id * 7919 % 40000 as v")
    taken = []
    collect = type(df).collect

    def watched(self):
        taken.append(self._jdf.queryExecution().executedPlan().toString())
        return collect(self)
    monkeypatch.setattr(type(df), "collect", watched)
    cut = R.Ranges(df, [("v", True)], rows=1000)
    monkeypatch.undo()
    assert taken and not [p for p in taken if "TakeOrderedAndProject" in p]
    assert cut.rows == 40_000 and len(cut.cuts) == 39
    sizes = [r["count"] for r in df.groupBy(cut.number(df).alias("b")).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 4_000


def test_asof_tasks_follow_the_files(spark, tmp_path, monkeypatch):
    from quarry.operators import asof
    monkeypatch.setattr(R, "SMALL_FILES", 0)
    monkeypatch.setattr(asof, "FILE_BYTES_A_TASK", 1000, raising=False)
    path = str(tmp_path / "rows")
    spark.range(4000).selectExpr("id % 7 as k", "timestamp_seconds(id * 86400) as t", "id as v").write.parquet(path)
    left = spark.read.parquet(path)
    right = left.where("v % 3 = 0").selectExpr("k", "t as rt", "v as w")
    got = asof_join(left, right, "t", "rt", by=["k"])
    tasks = min(8192, R.leaf_bytes(left, right) // 1000)
    p = got._jdf.queryExecution().executedPlan().toString()
    assert tasks > 8 and f", {tasks}), REPARTITION_BY_NUM" in p
    for r in got.collect():     # rows of a key come every 7 days, every third of them is on the right
        want = max((x for x in range(r.v, -1, -7) if x % 3 == 0), default=None)
        assert r.w == want


def test_player_tasks_follow_the_files(spark, monkeypatch):
    from quarry.catalog import load_all
    from quarry.session import Tables
    fn, d = load_all()["available_players_asof"].fn, "/root/testdata/sf0.001"
    want = sorted(map(tuple, fn(Tables(spark, d)).collect()))
    monkeypatch.setattr(R, "SPREAD_FILES", 0, raising=False)
    got = fn(Tables(spark, d))
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == want
