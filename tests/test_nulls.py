"""Shared operators on rows with NULL keys, times and values, against the plain window and DuckDB."""
import duckdb
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.asof import asof_join
from quarry.operators.windows import running_sum
from quarry.session import ensure_checkpoint_dir

TIMES = ["2024-01-05", "2024-01-20", "2024-02-03", "2024-03-01", None]


def test_running_sum_equals_the_plain_window(spark):
    rows = [(k, t, v, i) for i, (k, t, v) in enumerate(
        (k, t, v) for k in ("a", "b", None) for t, v in zip(TIMES, (None, 4, None, 3, 5) if k != "b" else (None, None, 2, None, None)))]
    df = spark.createDataFrame(rows, "k string, t string, v long, id int").withColumn("t", F.to_timestamp("t"))
    got = {r.id: r.s for r in running_sum(df, ["k"], ["t", "id"], "t", "v", "s").collect()}
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert got == {r.id: r.s for r in df.withColumn("s", F.sum("v").over(w)).collect()} and len(got) == len(rows)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("by", [["k"], []])
def test_asof_ignores_nulls(spark, direction, by):
    left = pd.DataFrame([(i, k, t) for i, (k, t) in enumerate((k, t) for k in ("a", None) for t in TIMES)], columns=["id", "k", "t"])
    right = pd.DataFrame([(k, t, j) for j, (k, t) in enumerate((k, t) for k in ("a", None) for t in ("2024-01-10", "2024-02-20", None))],
                         columns=["k", "u", "j"])
    right = right if by else right[right.k == "a"].drop(columns="k")
    left["t"], right["u"] = pd.to_datetime(left.t), pd.to_datetime(right.u)
    spread = {"backward": "t >= u", "forward": "t <= u", "nearest": "true"}[direction]
    con = duckdb.connect()
    con.register("l", left)
    con.register("r", right)
    want = con.execute(f"""select id, (select arg_min(j, abs(epoch(t) - epoch(u))) from r
                           where u is not null and t is not null and {spread} {'and r.k = l.k' if by else ''}) as j from l""").fetchall()
    sl = spark.createDataFrame([(int(a), b, None if pd.isna(c) else c.to_pydatetime()) for a, b, c in left.itertuples(index=False)],
                               "id int, k string, t timestamp")
    sr = spark.createDataFrame([tuple(None if pd.isna(x) else x.to_pydatetime() if hasattr(x, "to_pydatetime") else x for x in r)
                                for r in right.itertuples(index=False)], ("k string, " if by else "") + "u timestamp, j int")
    got = asof_join(sl, sr, "t", "u", by=by, direction=direction).select("id", "j").collect()
    assert sorted((r.id, r.j) for r in got) == sorted((a, None if b is None or pd.isna(b) else int(b)) for a, b in want)


def test_only_a_local_master_gets_a_scratch_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_grouped_quantiles_with_nulls_and_a_hot_value(spark):
    import duckdb
    import numpy as np
    from quarry.operators.stats import quantiles
    rng = np.random.default_rng(4)
    rows = [(int(k) if k else None, float(v)) for k, v in zip(rng.integers(0, 4, 900), rng.integers(0, 300, 900))]
    rows += [(1, 42.0)] * 700 + [(9, None)] * 3 + [(8, 1.5)] + [(1, None), (None, None)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = {r.k: (r.a, r.b, r.c) for r in quantiles(df, "v", {"a": 0.1, "b": 0.5, "c": 0.99}, by=["k"]).collect()}
    table = df.toArrow()                                                                    # noqa: F841
    want = {k: x for k, *x in duckdb.sql("""
        select k, quantile_cont(v, 0.1), quantile_cont(v, 0.5), quantile_cont(v, 0.99) from table group by k""".replace(
        "table", '"table"')).fetchall()}
    assert set(got) == set(want) == {None, 1, 2, 3, 8, 9}
    for k, x in want.items():
        assert got[k] == (None, None, None) if x[0] is None else np.allclose(got[k], x)


def test_downcast_keeps_values(spark):
    from quarry.operators.reshape import downcast
    df = spark.createDataFrame([(1, 0.1, 1e300, 7.0, None), (200, 2.5, 0.5, 9.0, None)], "a long, b double, c double, d double, e double")
    assert dict(downcast(df).dtypes) == {"a": "smallint", "b": "double", "c": "double", "d": "tinyint", "e": "double"}
    small = downcast(df, lossy=True)
    assert dict(small.dtypes) == {"a": "smallint", "b": "float", "c": "double", "d": "tinyint", "e": "double"}
    assert [r.c for r in small.orderBy("a").collect()] == [1e300, 0.5]


def test_stream_dedup_over_batches(spark):
    from quarry import sources, streaming
    folder, out = sources.scratch_dir(spark, "dedup_in"), sources.scratch_dir(spark, "dedup_out")
    for day in (1, 15, 28):
        spark.sql(f"select id % 5 as user_id, timestamp'2024-0{1 + day % 3}-{day:02d}' as ts from range(20)").coalesce(1) \
            .write.mode("append").parquet(folder)
    stream = streaming.event_stream(spark, folder, spark.read.parquet(folder).schema, max_files_per_trigger=1)
    streaming.run_available(streaming.dedup(stream, ["user_id"]), out)
    assert sorted(r.user_id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]
