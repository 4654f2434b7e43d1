"""SURVEY 2.11: data quality and leakage checks."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.operators import joins as J

S = "2.11"


@query("dq_unique_key", section=S, sql="""
select l_orderkey, l_linenumber, count(*) as cnt from lineitem group by 1, 2 having count(*) > 1
""")
def dq_unique_key(t):
    """Offending keys of a uniqueness rule (partial aggregation)."""
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


@query("dq_duplicates_report", views=("matches",), section=S, sql="""
select league, season, match_date, home_team_id, away_team_id, count(*) as cnt
from matches group by league, season, match_date, home_team_id, away_team_id having count(*) > 1
""")
def dq_duplicates_report(t):
    keys = ["league", "season", "match_date", "home_team_id", "away_team_id"]
    return t.matches.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


@query("dq_duplicates_report_nodate", views=("matches",), section=S, sql="""
select league, season, home_team_id, away_team_id, count(*) as cnt
from matches group by league, season, home_team_id, away_team_id having count(*) > 1
""")
def dq_duplicates_report_nodate(t):
    keys = ["league", "season", "home_team_id", "away_team_id"]
    return t.matches.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


@query("dedup_delete", section=S, sql="""
select o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderstatus from (
  select *, row_number() over (partition by o_custkey, o_orderdate, o_totalprice order by o_orderkey) as rn from orders)
where rn = 1
""")
def dedup_delete(t):
    """Keep the first row of each duplicate group (the new table version).
    min(struct) per key is a partial aggregate: a hot key shrinks map-side."""
    k = ["o_custkey", "o_orderdate", "o_totalprice"]
    g = t.orders.groupBy(*k).agg(F.min(F.struct("o_orderkey", "o_orderstatus")).alias("s"))
    return g.select("s.o_orderkey", *k, "s.o_orderstatus")


@query("dq_range", section=S, sql="""
select rule, n_bad from (
  select count(*) filter (where not (l_quantity > 0)) as qty_positive,
         count(*) filter (where not (l_discount between 0 and 0.1)) as discount_range,
         count(*) filter (where not (l_extendedprice >= 0)) as price_nonneg,
         count(*) filter (where not (l_tax >= 0)) as tax_nonneg from lineitem)
unpivot (n_bad for rule in (qty_positive, discount_range, price_nonneg, tax_nonneg))
""")
def dq_range(t):
    """All rules in one pass: count_if(NOT rule) per rule, then long form."""
    rules = {"qty_positive": F.col("l_quantity") > 0,
             "discount_range": F.col("l_discount").between(0, 0.1),
             "price_nonneg": F.col("l_extendedprice") >= 0,
             "tax_nonneg": F.col("l_tax") >= 0}
    wide = t.lineitem.agg(*[F.count_if(~c).alias(n) for n, c in rules.items()])
    return wide.unpivot([], list(rules), "rule", "n_bad")


@query("dq_time_order", section=S, sql="""
select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate, o.o_orderdate
from lineitem l join orders o on o.o_orderkey = l.l_orderkey where l.l_shipdate < o.o_orderdate
""")
def dq_time_order(t):
    """Events before their parent event (shipped before ordered)."""
    j = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return j.where(F.col("l_shipdate") < F.col("o_orderdate")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "o_orderdate")


@query("dq_leakage_flag", views=("matches", "odds"), section=S, sql="""
select o.bookmaker, bool_or(o.collected_at >= m.match_date) as has_leak,
       count(*) filter (where o.collected_at >= m.match_date) as n_leaky
from odds o left join matches m on m.match_id = o.match_id group by o.bookmaker
""")
def dq_leakage_flag(t):
    """Any feature row collected at/after its event (equality counts as leak)."""
    j = t.odds.join(t.matches.select("match_id", "match_date"), "match_id", "left")
    leak = F.col("collected_at") >= F.col("match_date")
    return j.groupBy("bookmaker").agg(F.bool_or(leak).alias("has_leak"), F.count_if(leak).alias("n_leaky"))


@query("dq_missing_ref", section=S, sql="""
select o.o_orderkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)
""")
def dq_missing_ref(t):
    return t.orders.join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti") \
        .select("o_orderkey")


@query("dq_join_fanout", section=S, sql="""
with l as (select l_orderkey, l_linenumber, count(*) as nl from lineitem group by 1, 2)
select sum(nl * nl) as joined_rows, max(nl) as max_right_per_key from l
""")
def dq_join_fanout(t):
    """Rows a self join of lineitem on (orderkey, linenumber) would produce,
    predicted from per-key counts without running the join."""
    k = ["l_orderkey", "l_linenumber"]
    return J.join_fanout(t.lineitem.select(*k), t.lineitem.select(*k), k)


@query("dq_compare_frames", section=S, sql="""
with a as (select o_orderkey, o_custkey, o_orderdate, o_totalprice from orders),
b as (select o_orderkey, o_custkey, o_orderdate, o_totalprice from (
        select *, row_number() over (partition by o_custkey, o_orderdate, o_totalprice order by o_orderkey) as rn
        from orders) where rn = 1)
select (select count(*) from (select * from a except all select * from b)) as only_left,
       (select count(*) from (select * from b except all select * from a)) as only_right
""")
def dq_compare_frames(t):
    """Two versions of a table compared with exceptAll both ways."""
    cols = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
    a = t.orders.select(*cols)
    b = dedup_delete(t).select(*cols)
    only_left = a.exceptAll(b).agg(F.count(F.lit(1))).scalar()
    only_right = b.exceptAll(a).agg(F.count(F.lit(1))).scalar()
    return t.spark.range(1).select(only_left.alias("only_left"), only_right.alias("only_right"))
