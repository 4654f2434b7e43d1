"""SURVEY 2.7: set operations and the home/away unpivot."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.operators.roles import team_perspective

S = "2.7"


@query("union_all", section=S, sql="""
select c_nationkey as nationkey from customer union all select s_nationkey from supplier
""")
def union_all(t):
    return t.customer.select(F.col("c_nationkey").alias("nationkey")).unionByName(
        t.supplier.select(F.col("s_nationkey").alias("nationkey")))


@query("union_distinct", section=S, sql="""
select c_nationkey as nationkey from customer union select s_nationkey from supplier
""")
def union_distinct(t):
    return t.customer.select(F.col("c_nationkey").alias("nationkey")).unionByName(
        t.supplier.select(F.col("s_nationkey").alias("nationkey"))).distinct()


@query("distinct_rows", section=S, sql="select distinct l_returnflag, l_linestatus from lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@query("dedup_keep_first", section=S, sql="""
select o_custkey, o_orderkey, o_orderdate from (
  select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from orders) where rn = 1
""")
def dedup_keep_first(t):
    """drop_duplicates(keep='first') with a stated order: min of a struct per
    key -- a partial aggregate, so a hot key shrinks map-side (H14)."""
    g = t.orders.groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("s"))
    return g.select("o_custkey", "s.o_orderkey", "s.o_orderdate")


@query("set_intersect", section=S, sql="""
select c_nationkey as nationkey from customer intersect select s_nationkey from supplier
""")
def set_intersect(t):
    return t.customer.select(F.col("c_nationkey").alias("nationkey")).intersect(
        t.supplier.select(F.col("s_nationkey").alias("nationkey")))


@query("set_except", section=S, sql="""
select o_custkey as custkey from orders where o_orderstatus = 'F'
except select o_custkey from orders where o_orderstatus = 'O'
""")
def set_except(t):
    f = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("custkey"))
    o = t.orders.where(F.col("o_orderstatus") == "O").select(F.col("o_custkey").alias("custkey"))
    return f.subtract(o)


@query("set_except_all", section=S, sql="""
select l_returnflag from lineitem except all select l_returnflag from lineitem where l_linestatus = 'F'
""")
def set_except_all(t):
    """A few values with many copies each: counted, and only the result is written out copy by copy."""
    from quarry.operators.joins import except_all
    return except_all(t.lineitem.select("l_returnflag"), t.lineitem.where(F.col("l_linestatus") == "F").select("l_returnflag"))


@query("unpivot_roles", views=("matches",), section=S, sql="""
select match_id, home_team_id as team_id, 1 as is_home, home_score as gf, away_score as ga from matches
union all
select match_id, away_team_id, 0, away_score, home_score from matches
""")
def unpivot_roles(t):
    """One scan + generator instead of two scans and UNION ALL."""
    return team_perspective(t.matches, keep=["match_id"])


@query("set_ops", section=S, sql="""
select 'intersect' as op, nationkey from (select c_nationkey as nationkey from customer
                                          intersect select s_nationkey from supplier)
union all
select 'union', nationkey from (select c_nationkey as nationkey from customer union select s_nationkey from supplier)
union all
select 'except', nationkey from (select c_nationkey as nationkey from customer except select s_nationkey from supplier)
""")
def set_ops(t):
    """Intersection, union and difference of two key sets (set semantics)."""
    a = t.customer.select(F.col("c_nationkey").alias("nationkey"))
    b = t.supplier.select(F.col("s_nationkey").alias("nationkey"))
    return (a.intersect(b).select(F.lit("intersect").alias("op"), "nationkey")
            .unionByName(a.union(b).distinct().select(F.lit("union").alias("op"), "nationkey"))
            .unionByName(a.subtract(b).select(F.lit("except").alias("op"), "nationkey")))
