"""Small tables with results worked out by hand, and brute-force checks of
the custom operators on seeded fixtures with a hot key and ties."""
import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import columns as C
from quarry.operators import joins as J
from quarry.operators.asof import asof_join
from quarry.operators.stats import quantiles
from quarry.operators.windows import global_rank, running_sum, trailing


def ts(s):
    return dt.datetime.fromisoformat(s)


# --------------------------------------------------- results worked out by hand

def test_asof_without_key(spark):
    parcels = spark.createDataFrame(
        [(11, ts("2023-03-05 23:59")), (12, ts("2023-03-06 00:00")), (13, ts("2023-03-08 12:30")), (14, ts("2023-03-01 09:00"))],
        "parcel long, sent timestamp_ntz")
    tariffs = spark.createDataFrame(
        [(ts("2023-03-06 00:00"), 7.5), (ts("2023-03-08 12:31"), 9.0), (ts("2023-03-02 00:00"), 6.25)],
        "valid_from timestamp_ntz, price double")
    priced = {r.parcel: r.price for r in asof_join(parcels, tariffs, "sent", "valid_from").collect()}
    assert priced == {11: 6.25, 12: 7.5, 13: 7.5, 14: None}


def test_merge_ordered_ffill(spark):
    stock = spark.createDataFrame([(dt.date(2024, 2, 27), 5), (dt.date(2024, 2, 29), 8)], "d date, x int")
    sold = spark.createDataFrame([(dt.date(2024, 2, 28), 1), (dt.date(2024, 3, 1), 2)], "d date, y int")
    merged = J.merge_ordered_ffill(stock, sold, "d", ["x", "y"]).collect()
    assert {(r.d.day, r.x, r.y) for r in merged} == {(27, 5, None), (28, 5, 1), (29, 8, 1), (1, 8, 2)}


def test_join_fanout(spark):
    crates = spark.createDataFrame([(7, "a"), (8, "b"), (9, "c")], "crate int, tag string")
    weights = spark.createDataFrame([(8, 1.5), (9, 2.5), (9, 3.5), (9, 4.5)], "crate int, kilos double")
    report = J.join_fanout(crates, weights, ["crate"]).first()
    assert report.joined_rows == 4 and report.max_right_per_key == 3
    with pytest.raises(J.JoinKeyNotUnique):
        J.safe_join(crates, weights, ["crate"])
    out, seen = J.safe_join(crates, weights.groupBy("crate").agg(F.max("kilos").alias("kilos")), ["crate"])
    assert {r.crate: r.kilos for r in out.collect()} == {7: None, 8: 1.5, 9: 4.5}
    assert seen["left"].get["rows"] == seen["out"].get["rows"] == 3


@pytest.mark.parametrize("values", [[3, 9, 4, 15, 7, 27, 11], [41, 44, 39, 47, 43, 45, 120, 38, 46], [2.5], [1, 1, 1, 8]])
def test_quantiles(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    row = quantiles(df, "x", {"low": 0.25, "mid": 0.5, "high": 0.75}).first()
    assert np.allclose([row.low, row.mid, row.high], np.percentile(values, [25, 50, 75]))


def test_bins(spark):
    degrees = spark.createDataFrame([(d,) for d in [0, 10, 11, 20, 25, 31, 90]], "d int")
    name = C.bin_right_closed(F.col("d"), [0, 10, 20, 30, 100], ["cold", "mild", "warm", "hot"])
    got = {r[0]: r[1] for r in degrees.select("d", name).collect()}
    assert got == {0: None, 10: "cold", 11: "mild", 20: "mild", 25: "warm", 31: "hot", 90: "hot"}


def test_deviation_correlation_and_non_finite(spark):
    df = spark.createDataFrame([(float(v),) for v in (2, 4, 4, 4, 5, 5, 7, 9)], "x double")
    both = df.agg(F.avg("x"), F.stddev_pop("x")).first()
    assert np.allclose(tuple(both), (5.0, 2.0))
    xs, ys = [1.5, 0.5, 3.0, 2.0], [9.0, 4.0, 16.0, 12.5]
    c = spark.createDataFrame(list(zip(xs, ys)), "x double, y double").agg(F.corr("x", "y")).first()[0]
    assert math.isclose(c, np.corrcoef(xs, ys)[0, 1], rel_tol=1e-12)
    odd = spark.createDataFrame([(0, float("nan")), (1, -3.5), (2, float("inf")), (3, 0.25)], "i int, x double")
    clean = odd.select("i", C.nan_to_num(F.col("x"), -1.0, 77.0).alias("y")).collect()
    assert {r.i: r.y for r in clean} == {0: -1.0, 1: -3.5, 2: 77.0, 3: 0.25}


def test_rolling_mean_and_dense_rank(spark):
    s = spark.createDataFrame(list(enumerate([6.0, 3.0, 9.0, 12.0, 0.0])), "i int, v double")
    three = s.select("i", F.avg("v").over(Window.orderBy("i").rowsBetween(-2, 0)).alias("m"))
    assert {r.i: r.m for r in three.collect()} == {0: 6.0, 1: 4.5, 2: 6.0, 3: 8.0, 4: 7.0}
    k = spark.createDataFrame([("k1", 12), ("k2", 30), ("k3", 12), ("k4", 5)], "k string, n int")
    ranks = global_rank(k, [("n", False)], "dense_rank", "place").collect()
    assert {r.k: r.place for r in ranks} == {"k2": 1, "k1": 2, "k3": 2, "k4": 3}


def test_share_of_total(spark):
    s = spark.createDataFrame([(3.0,), (5.0,), (12.0,)], "v double")
    shares = s.select("v", (F.col("v") / s.agg(F.sum("v")).scalar()).alias("share")).collect()
    assert {r.v: round(r.share, 9) for r in shares} == {3.0: 0.15, 5.0: 0.25, 12.0: 0.6}


def test_word_count_helper(spark):
    df = spark.createDataFrame([("  a  b c ",), ("",), ("   ",), ("one",)], "s string")
    assert [r[0] for r in df.select(C.word_count(F.col("s"))).collect()] == [3, 0, 0, 1]


# ------------------------------------------------- brute force on fixtures

def _skewed(rng, n, keys=6):
    # one key holds about a third of the rows; times have ties
    k = np.where(rng.random(n) < 0.34, 0, rng.integers(1, keys, n))
    t = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 60 * 24 * 90, n), unit="m")
    return k, t


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_matches_pandas(spark, strict, direction):
    rng = np.random.default_rng(5)
    lk, lt = _skewed(rng, 600)
    rk, rt = _skewed(rng, 400)
    left = pd.DataFrame({"id": np.arange(600), "k": lk, "t": lt})
    right = pd.DataFrame({"k": rk, "rt": rt, "v": rng.integers(0, 10**6, 400)})
    right = right.sort_values(["k", "rt", "v"]).drop_duplicates(["k", "rt"], keep="last")
    exp = pd.merge_asof(left.sort_values("t"), right.sort_values("rt"), left_on="t", right_on="rt", by="k",
                        direction=direction, allow_exact_matches=not strict, tolerance=pd.Timedelta("3D"))
    L = spark.createDataFrame(left.assign(t=left.t.dt.to_pydatetime())).withColumn("t", F.col("t").cast("timestamp_ntz"))
    R = spark.createDataFrame(right.assign(rt=right.rt.dt.to_pydatetime())).withColumn("rt", F.col("rt").cast("timestamp_ntz"))
    got = asof_join(L, R, "t", "rt", by=["k"], strict=strict, tolerance="3 days", direction=direction).toPandas()
    e = exp.set_index("id").sort_index()["v"]
    g = got.set_index("id").sort_index()["v"]
    assert len(g) == 600
    assert (e.isna() == g.isna()).all()
    assert (e.dropna().astype(int) == g.dropna().astype(int)).all()


def test_trailing_and_running_match_plain_window(spark):
    rng = np.random.default_rng(3)
    k, t = _skewed(rng, 3000)
    pdf = pd.DataFrame({"k": k, "t": t.to_pydatetime(), "id": np.arange(3000), "v": rng.integers(0, 100, 3000)})
    df = spark.createDataFrame(pdf).withColumn("t", F.col("t").cast("timestamp_ntz"))
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = df.select("id", F.avg("v").over(w.rowsBetween(-5, -1)).alias("a"),
                      F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    tr = trailing(df, ["k"], ["t", "id"], "t", -5, -1, {"a": (F.avg, "v")},
                  bucket=lambda c: F.date_trunc("week", c)).select("id", "a")
    rs = running_sum(df, ["k"], ["t", "id"], "t", "v", "s", bucket=lambda c: F.date_trunc("week", c)).select("id", "s")
    got = tr.join(rs, "id").toPandas().set_index("id").sort_index()
    exp = plain.toPandas().set_index("id").sort_index()
    assert np.allclose(got["a"].fillna(-1), exp["a"].fillna(-1))
    assert (got["s"] == exp["s"]).all()


@pytest.mark.parametrize("kind", ["row_number", "rank", "dense_rank", "percent_rank", "ntile"])
def test_global_rank_matches_plain_window(spark, kind):
    rng = np.random.default_rng(11)
    vals = rng.integers(0, 50, 2000).astype(float)
    vals[rng.random(2000) < 0.3] = 7.0          # a hot value
    pdf = pd.DataFrame({"id": np.arange(2000), "v": vals})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.col("id") % 97 == 0, None).otherwise(F.col("v")))
    order = [("v", False), ("id", True)] if kind in ("row_number", "ntile") else [("v", False)]
    w = Window.orderBy(*[F.col(c).desc_nulls_last() if not a else F.col(c) for c, a in order])
    fn = {"row_number": F.row_number(), "rank": F.rank(), "dense_rank": F.dense_rank(),
          "percent_rank": F.percent_rank(), "ntile": F.ntile(7)}[kind]
    exp = df.select("id", fn.over(w).alias("r")).toPandas().set_index("id").sort_index()["r"]
    got = global_rank(df, order, kind, "r", buckets=8, ntiles=7).toPandas().set_index("id").sort_index()["r"]
    assert np.allclose(got.astype(float), exp.astype(float))
