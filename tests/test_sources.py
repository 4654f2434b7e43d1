"""Readers and writers: dirty CSV, JDBC options, JSON arrays."""
import pytest
from pyspark.sql import functions as F

from quarry import sources as src

DIRTY = """parcel,depot,seen,kilos
9001,4,2019-11-30,2.5
9002,4,30.11.2019,0.75
9003,  ,2019-12-01,6
9004,7,2019/12/02,11.25
9005,9,2019-12-03,40
9006,7,2020-02-29,0.5
"""


def test_dirty_csv(spark):
    path = src.scratch_dir(spark, "dirty_fixture")
    lines = [(line,) for line in DIRTY.strip().splitlines()]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(path)
    good, bad = src.read_csv_dirty(
        spark, path, ["parcel", "depot", "seen", "kilos"],
        types={"parcel": "bigint", "depot": "bigint", "seen": "date", "kilos": "double"},
        date_formats={"seen": ["yyyy-MM-dd", "dd.MM.yyyy", "yyyy/MM/dd"]}, required=["depot"])
    seen = {r.parcel: str(r.seen) for r in good.collect()}
    assert seen == {9001: "2019-11-30", 9002: "2019-11-30", 9004: "2019-12-02", 9005: "2019-12-03", 9006: "2020-02-29"}
    assert ["depot" in r.reason for r in bad.collect()] == [True]


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("QUARRY_TEST_PW", "s3cret")
    o = src.jdbc_options("jdbc:sqlserver://h;databaseName=d", table="dbo.Orders", user="u",
                         password_env="QUARRY_TEST_PW", partition_column="OrderID", lower_bound=1,
                         upper_bound=10**6, num_partitions=64)
    assert o["password"] == "s3cret" and o["numPartitions"] == "64" and o["dbtable"] == "dbo.Orders"
    with pytest.raises(ValueError):
        src.jdbc_options("jdbc:x", table="t", query="select 1")
    with pytest.raises(ValueError):
        src.jdbc_options("jdbc:x", query="select 1", partition_column="id", lower_bound=0, upper_bound=1,
                         num_partitions=2)
    with pytest.raises(KeyError):
        src.jdbc_options("jdbc:x", table="t", password_env="QUARRY_UNSET_VAR_X")


def test_json_array_rows(spark):
    shelf = spark.createDataFrame([('[{"sku":"p-4","left":0},{"sku":"q-9","left":13},{"sku":null,"left":2}]',)], "doc string")
    items = shelf.select(src.json_array_rows(F.col("doc"), "struct<sku:string,left:int>")).collect()
    assert sorted((r[1], r[0]) for r in items) == [(0, "p-4"), (2, None), (13, "q-9")]


def test_scratch_dir_under_checkpoint(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert src.scratch_dir(spark, "x").startswith(base)
