"""Random columns, matrices, categories, samples, grids, checked joins, maps and windowed streams."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry import sources as src
from quarry import streaming as st
from quarry.functions import columns as C
from quarry.functions import random as rnd
from quarry.operators import joins as J
from quarry.operators.matrix import row_stats, vector_stats, vector_sums
from quarry.operators.reshape import compact, decode, dictionary, encode, parquet_bytes
from quarry.operators.sampling import bottom_k, pair_grids


def test_random_columns_depend_on_the_key_alone(spark):
    def draw(df):
        k = F.col("id")
        return {r.id: tuple(r)[1:] for r in df.select(
            "id", rnd.uniform(1, k, 0), rnd.normal(1, k, 1), rnd.gamma(1, k, 1, 0.4, 2.0), rnd.gamma(1, k, 2, 2.2, 30.0),
            rnd.integers(1, k, 7, -2, 3), rnd.choice(1, k, 8, ["a", "b", "c"], [0, 1, 3])).collect()}
    one, other = draw(spark.range(4000).repartition(1)), draw(spark.range(4000).repartition(13).orderBy(F.rand()))
    assert one == other
    u, n, small, big, ints, pick = map(np.array, zip(*one.values()))
    u, n, small, big = (x.astype(float) for x in (u, n, small, big))
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.02
    assert abs(n.mean()) < 0.06 and abs(n.std() - 1) < 0.05
    assert small.min() > 0 and abs(small.mean() - 0.8) < 0.1 and abs(small.var() - 1.6) < 0.4
    assert abs(big.mean() - 66) < 3 and abs(big.std() - 30 * math.sqrt(2.2)) < 3
    assert set(ints.astype(int)) == {-2, -1, 0, 1, 2} and set(pick) == {"b", "c"} and abs((pick == "c").mean() - 0.75) < 0.03
    with pytest.raises(ValueError):
        rnd.choice(1, F.col("id"), 0, ["a"], [0])


@pytest.mark.parametrize("size", [1, 7, 8, 20])
def test_vector_stats(spark, size):
    rng = np.random.default_rng(size)
    x = rng.normal(3, 2, (300, size))
    x[:, size // 2] = 4.0
    rows = [(v.tolist(),) for v in x] + [(None,), ([1.0] * (size + 1),), ([float("nan")] * size,), ([None] * size,), ([float("inf")] * size,), ([],)]
    df = spark.createDataFrame(rows, "v array<double>")
    got = {(r.i, r.j): r for r in vector_stats(df, "v", size).collect()}
    assert len(got) == size * size
    cov = np.atleast_2d(np.cov(x, rowvar=False))
    for (i, j), r in got.items():
        assert r.n == 300 and r.cov == pytest.approx(cov[i - 1, j - 1], abs=1e-9)
        if size // 2 in (i - 1, j - 1):
            assert r.corr is None
        else:
            assert r.corr == pytest.approx(np.corrcoef(x[:, i - 1], x[:, j - 1])[0, 1])
    assert vector_sums(df.where("false"), "v", size).count() == 0


def test_row_stats(spark):
    m = np.random.default_rng(1).normal(0, 1, (3, 40))
    cells = [(name, c, float(m[i, c])) for i, name in enumerate("abc") for c in range(40) if (i, c) != (1, 5)] + [("z", 0, 1.0)]
    got = {(r.row_a, r.row_b): (r.n, r.corr) for r in row_stats(spark.createDataFrame(cells, "r string, c int, v double"), "r", "c", "v", list("abc")).collect()}
    want = np.corrcoef(np.delete(m, 5, axis=1))
    assert got == {(a, b): (39, pytest.approx(want[i, j])) for i, a in enumerate("abc") for j, b in enumerate("abc")}


def test_categories_round_trip(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b"), (5, "é"), (6, "")], "id int, s string")
    d = dictionary(df, "s")
    assert {r.category: r.code for r in d.collect()} == {"": 0, "a": 1, "b": 2, "é": 3}
    coded = encode(df, "s", d, "code")
    assert {r.id: r.code for r in coded.collect()} == {1: 2, 2: -1, 3: 1, 4: 2, 5: 3, 6: 0}
    back = decode(coded.drop("s"), "code", d, "s").select("id", "s")
    assert back.exceptAll(df).count() == 0 and back.count() == 6
    assert encode(spark.createDataFrame([(9, "new")], "id int, s string"), "s", d).first().s == -1


def test_compact_is_smaller_and_the_same(spark):
    df = spark.range(20_000).selectExpr("id * 3 as k", "concat('a long category name ', id % 50) as s", "double(id % 7) as x")
    out, found = compact(df, ["s"])
    assert dict(out.dtypes) == {"k": "int", "s": "tinyint", "x": "tinyint"}
    assert parquet_bytes(out) < parquet_bytes(df)
    back = decode(out.withColumnRenamed("s", "code"), "code", found["s"], "s").select(F.col("k").cast("long"), "s", F.col("x").cast("double"))
    assert back.exceptAll(df).count() == 0 and back.count() == 20_000


def test_bottom_k_is_bounded_and_mergeable(spark):
    df = spark.range(5000).selectExpr("id", "case when id % 10 < 9 then 'hot' else 'other' end p")
    whole = {r.id for r in bottom_k(df, 40, ["id"], ["p"]).collect()}
    parts = [bottom_k(df.where(f"id % 3 = {i}"), 40, ["id"], ["p"]) for i in range(3)]
    merged = {r.id for r in bottom_k(parts[0].union(parts[1]).union(parts[2]), 40, ["id"], ["p"]).collect()}
    assert whole == merged and len(whole) == 80
    assert bottom_k(df, 7, ["id"]).count() == 7 and bottom_k(df.where("false"), 7, ["id"], ["p"]).count() == 0


def test_pair_grids(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), 1.0, None if i % 5 else 2.0 + i) for i, (a, b) in enumerate(rng.random((200, 2)))]
    got = {(r.col_x, r.col_y, r.bin_x, r.bin_y): r.n for r in pair_grids(spark.createDataFrame(rows, "a double, b double, c double, d double"), list("abcd"), 4).collect()}
    cols = {c: [r[i] for r in rows] for i, c in enumerate("abcd")}

    def cell(c, v):
        known = [x for x in cols[c] if x is not None]
        lo, hi = min(known), max(known)
        return 0 if hi == lo else min(int((v - lo) * 4 / (hi - lo)), 3)
    want = {}
    for i, x in enumerate("abcd"):
        for y in "abcd"[i + 1:]:
            for v, w in zip(cols[x], cols[y]):
                if v is not None and w is not None:
                    k = (x, y, cell(x, v), cell(y, w))
                    want[k] = want.get(k, 0) + 1
    assert got == want


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_join_report_counts_the_join(spark, how):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,), (4,)], "k int")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n"), (9, "q")], "k int, v string")
    r = J.join_report(a, b, ["k"], how).first()
    assert r.out_rows == a.join(b, ["k"], how).count()
    assert (r.left_rows, r.right_rows, r.right_duplicate_keys, r.matched_left_rows, r.right_unique) == (5, 5, 1, 3, False)
    empty = J.join_report(a, b.where("false"), ["k"], how).first()
    assert empty.right_unique and empty.out_rows == a.join(b.where("false"), ["k"], how).count()


def test_inverted_map_and_rows(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2, "c": 1, "d": None},), ({},), (None,)], "m map<string,int>")
    assert [r.i for r in df.select(C.inverted("m").alias("i")).collect()] == [{2: "b", 1: "c"}, {}, None]
    lens = spark.range(20).selectExpr("id", "case when id = 0 then array() else sequence(1, id) end v").select("id", C.rows_of(F.col("v"), 7).alias("g"))
    for r in lens.collect():
        assert r.g == [list(range(1, r.id + 1))[i:i + 7] for i in range(0, r.id, 7)]


def test_update_mode_keeps_the_last_version(spark):
    folder, out = src.scratch_dir(spark, "arriving"), src.scratch_dir(spark, "windows")
    schema = "ts timestamp, event_type string, value double"
    for i, rows in enumerate(["2024-01-01 10:00:00 2024-01-02 11:00:00".split(), "2024-01-02 12:00:00 2024-01-05 01:00:00".split()]):
        times = [f"{rows[0]} {rows[1]}", f"{rows[2]} {rows[3]}"]
        spark.createDataFrame([(t, "a", 1.0) for t in times], "ts string, event_type string, value double") \
            .withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)
        stream = st.tumbling_daily(st.event_stream(spark, folder, spark.createDataFrame([], schema).schema))
        st.run_available(stream, out, mode="update")
    rows = st.last_versions(spark, out, stream.schema, ["day_start", "event_type"], "day_end").collect()
    assert {(r.day_start.day, r.n, r.closed) for r in rows} == {(1, 1, True), (2, 2, True), (5, 1, False)}
    none = st.last_versions(spark, src.scratch_dir(spark, "never"), stream.schema, ["day_start", "event_type"], "day_end")
    assert none.count() == 0 and none.columns == [*stream.columns, "closed"]


def test_except_all_spreads_copies(spark):
    a = spark.range(45_000).selectExpr("case when id % 3 = 0 then 'hot' when id % 1000 = 1 then null else concat('v', id % 50) end as x", "1 as y")
    b = a.where("x is null or x = 'v7'").limit(300).union(spark.createDataFrame([("only b", 1)], "x string, y int"))
    got, want = J.except_all(a, b), a.exceptAll(b)
    assert sorted(map(str, got.groupBy("x", "y").count().collect())) == sorted(map(str, want.groupBy("x", "y").count().collect()))
    held = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("x") == "hot").alias("n")).collect()
    assert max(r.n for r in held) <= 10_000 and got.columns == ["x", "y"]
    assert J.except_all(a.where("false"), b).count() == 0
