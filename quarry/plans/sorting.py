"""SURVEY 2.6: sort, limit, top-k, paging."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import query

S = "2.6"


@query("sort_multi", section=S, sql="""
select c_custkey, c_mktsegment, c_acctbal from customer order by c_mktsegment asc nulls first, c_acctbal desc, c_custkey
""")
def sort_multi(t):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy(
        F.col("c_mktsegment").asc_nulls_first(), F.col("c_acctbal").desc(), "c_custkey")


@query("limit_topn", section=S, sql="""
select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 5
""")
def limit_topn(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5)


@query("limit_with_ties", section=S, sql="""
select o_orderkey, o_orderdate from orders
where o_orderdate >= (select min(o_orderdate) from (select o_orderdate from orders order by o_orderdate desc limit 3))
""")
def limit_with_ties(t):
    """TOP (3) WITH TIES by date: take 3, read the cutoff, keep all rows at or
    above it (no global window)."""
    cut = t.orders.orderBy(F.col("o_orderdate").desc()).limit(3).agg(F.min("o_orderdate")).scalar()
    return t.orders.where(F.col("o_orderdate") >= cut).select("o_orderkey", "o_orderdate")


@query("limit_percent", section=S, sql="""
with r as (select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc, o_orderkey) as rn,
                  count(*) over () as n from orders)
select o_orderkey, o_totalprice from r where rn <= ceil(0.1 * n)
""")
def limit_percent(t):
    """TOP (10) PERCENT: distributed row number, keep rn <= ceil(p * n)."""
    from quarry.operators.windows import global_row_number
    r = global_row_number(t.orders.select("o_orderkey", "o_totalprice"),
                          [("o_totalprice", False), ("o_orderkey", True)])
    n = t.orders.agg(F.count(F.lit(1))).scalar()
    return r.where(F.col("rn") <= F.ceil(0.1 * n)).select("o_orderkey", "o_totalprice")


@query("limit_offset", section=S, sql="""
select o_orderkey, o_orderdate from orders order by o_orderdate, o_orderkey offset 20 limit 10
""")
def limit_offset(t):
    """Paging with a unique sort key."""
    return t.orders.select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey").offset(20).limit(10)


@query("top2_values", section=S, sql="""
select o_totalprice from orders order by o_totalprice desc limit 2
""")
def top2_values(t):
    return t.orders.select("o_totalprice").orderBy(F.col("o_totalprice").desc()).limit(2)


@query("top2_per_group", section=S, sql="""
select o_custkey, o_totalprice from (
  select o_custkey, o_totalprice, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn
  from orders) where rn <= 2
""")
def top2_per_group(t):
    from pyspark.sql import Window
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return t.orders.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= 2).select("o_custkey", "o_totalprice")


@query("limit_unordered", section=S)
def limit_unordered(t):
    """SELECT TOP 100 * without ORDER BY: any 100 rows (rows-only check)."""
    return t.orders.limit(100)


@query("sort_key", section=S, sql="""
select p_name, p_retailprice from part order by p_retailprice desc, p_name
""")
def sort_key(t):
    return t.part.select("p_name", "p_retailprice").orderBy(F.col("p_retailprice").desc(), "p_name")
