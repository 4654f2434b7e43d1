"""SURVEY 2.9: pivots, melt, one-hot, resampling, islands, moving averages."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.operators.reshape import daily_spine, islands, melt, one_hot as one_hot_op, pivot_fixed

S = "2.9"
STATUSES = ["F", "O", "P"]
# The five market segments of the customer table.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("pivot_static", section=S, sql="""
select cast(year(o_orderdate) as integer) as yr,
""" + ",\n".join(f"  count(*) filter (where o_orderstatus = '{s}') as {s}" for s in STATUSES) + """
from orders group by year(o_orderdate)
""")
def pivot_static(t):
    """PIVOT with a closed value list (H10): one hash aggregation, no
    distinct-values job."""
    return pivot_fixed(t.orders.withColumn("yr", F.year("o_orderdate")), ["yr"], "o_orderstatus", STATUSES,
                       F.count(F.lit(1)), fill=0)


@query("pivot_global", section=S, sql="""
select """ + ", ".join(f"round(sum(o_totalprice) filter (where o_orderstatus = '{s}'), 4) as {s}" for s in STATUSES) + """
from orders
""")
def pivot_global(t):
    p = t.orders.groupBy().pivot("o_orderstatus", STATUSES).agg(F.sum("o_totalprice"))
    return p.select(*[F.round(s, 4).alias(s) for s in STATUSES])


@query("pivot_dynamic", section=S, sql="""
select cast(year(o_orderdate) as integer) as yr,
       count(*) filter (where o_orderpriority = '1-URGENT') as "1-URGENT", count(*) filter (where o_orderpriority = '2-HIGH') as "2-HIGH",
       count(*) filter (where o_orderpriority = '3-MEDIUM') as "3-MEDIUM",
       count(*) filter (where o_orderpriority = '4-NOT SPECIFIED') as "4-NOT SPECIFIED",
       count(*) filter (where o_orderpriority = '5-LOW') as "5-LOW"
from orders group by yr
""")
def pivot_dynamic(t):
    """Columns from the data: Spark first runs a distinct-values job (capped by
    spark.sql.pivotMaxValues), then the static pivot."""
    p = t.orders.withColumn("yr", F.year("o_orderdate")).groupBy("yr").pivot("o_orderpriority").count()
    return p.fillna(0)


_PFT_SQL = """
with p as (select o_custkey,
""" + ",\n".join(f"  coalesce(sum(o_totalprice) filter (where o_orderstatus = '{s}'), 0) as {s}" for s in STATUSES) + """
  from orders group by o_custkey)
"""


@query("pivot_fill_total", section=S, sql=_PFT_SQL + """
select o_custkey, """ + ", ".join(f"round({s}, 4) as {s}" for s in STATUSES) + """, round(F + O + P, 4) as total from p
""")
def pivot_fill_total(t):
    """pivot_table(aggfunc='sum').fillna(0) plus a row total."""
    p = pivot_fixed(t.orders, ["o_custkey"], "o_orderstatus", STATUSES, F.sum("o_totalprice"), fill=0.0)
    return p.select("o_custkey", *[F.round(s, 4).alias(s) for s in STATUSES],
                    F.round(sum(F.col(s) for s in STATUSES), 4).alias("total"))


@query("pivot_multi_agg_pct", section=S, sql="""
with s as (select strftime(o_orderdate, '%Y') || 'Q' || cast(quarter(o_orderdate) as varchar) as q,
                  case when o_orderkey % 2 = 0 then 'A' else 'B' end as variant, o_totalprice as amount from orders),
p as (select q, count(*) filter (where variant = 'A') as count_A, count(*) filter (where variant = 'B') as count_B,
             coalesce(sum(amount) filter (where variant = 'A'), 0) as sum_A,
             coalesce(sum(amount) filter (where variant = 'B'), 0) as sum_B from s group by q)
select q, count_A, count_B, round(sum_A, 4) as sum_A, round(sum_B, 4) as sum_B, round(sum_A + sum_B, 4) as sum_total,
       round(100.0 * count_A / (count_A + count_B), 6) as pct_count_A,
       round(100.0 * count_B / (count_A + count_B), 6) as pct_count_B
from p
""")
def pivot_multi_agg_pct(t):
    """Two aggregates x variant by quarter, totals and percentages; the
    variant list is fixed so a missing variant is a 0 column (H39)."""
    s = t.orders.select(F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("Q"),
                                 F.quarter("o_orderdate").cast("string")).alias("q"),
                        F.when(F.col("o_orderkey") % 2 == 0, "A").otherwise("B").alias("variant"),
                        F.col("o_totalprice").alias("amount"))
    p = s.groupBy("q").pivot("variant", ["A", "B"]).agg(F.count(F.lit(1)).alias("count"), F.sum("amount").alias("sum"))
    p = p.fillna(0, subset=["A_count", "B_count"]).fillna(0.0, subset=["A_sum", "B_sum"])
    n = F.col("A_count") + F.col("B_count")
    return p.select("q", F.col("A_count").alias("count_A"), F.col("B_count").alias("count_B"),
                    F.round("A_sum", 4).alias("sum_A"), F.round("B_sum", 4).alias("sum_B"),
                    F.round(F.col("A_sum") + F.col("B_sum"), 4).alias("sum_total"),
                    F.round(100.0 * F.col("A_count") / n, 6).alias("pct_count_A"),
                    F.round(100.0 * F.col("B_count") / n, 6).alias("pct_count_B"))


@query("unpivot_melt", section=S, sql=_PFT_SQL + """, w as (select o_custkey, F, O, P, F + O + P as total from p)
select o_custkey, variable, round(value, 4) as value
from (unpivot w on F, O, P, total into name variable value value)
""")
def unpivot_melt(t):
    """melt after adding the total column: 'total' becomes a variable, as in
    the reference (H11)."""
    p = pivot_fixed(t.orders, ["o_custkey"], "o_orderstatus", STATUSES, F.sum("o_totalprice"), fill=0.0)
    p = p.withColumn("total", sum(F.col(s) for s in STATUSES))
    m = melt(p, ["o_custkey"], STATUSES + ["total"], "variable", "value")
    return m.select("o_custkey", "variable", F.round("value", 4).alias("value"))


@query("one_hot", section=S, sql="""
select c_custkey, """ + ", ".join(f"cast(c_mktsegment = '{v}' as integer) as c_mktsegment_{v}" for v in SEGMENTS[1:]) + """
from customer
""")
def one_hot(t):
    """get_dummies(drop_first=True) over the fixed segment list."""
    return one_hot_op(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", SEGMENTS).drop("c_mktsegment")


@query("resample_daily", section=S, sql="""
with d as (select cast(o_orderdate as date) as day, sum(o_totalprice) as s from orders group by 1),
spine as (select unnest(generate_series(min(day), max(day), interval 1 day))::date as day from d)
select spine.day, round(coalesce(d.s, 0), 4) as sales from spine left join d on d.day = spine.day
""")
def resample_daily(t):
    """resample('D').sum(): every calendar day, empty days 0."""
    d = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("s"))
    spine = daily_spine(t.orders, "o_orderdate")
    return spine.join(d, "day", "left").select("day", F.round(F.coalesce("s", F.lit(0.0)), 4).alias("sales"))


@query("resample_weekly", section=S, sql="""
select cast(date_trunc('week', o_orderdate) as date) + 6 as week_end, round(sum(o_totalprice), 4) as sales
from orders group by 1
""")
def resample_weekly(t):
    """resample('W'): weeks labelled by the Sunday that ends them."""
    return (t.orders.groupBy(F.date_add(F.to_date(F.date_trunc("week", "o_orderdate")), 6).alias("week_end"))
            .agg(F.round(F.sum("o_totalprice"), 4).alias("sales")))


@query("gaps_islands", section=S, sql="""
with d as (select distinct user_id, cast(ts as date) as d from events),
g as (select user_id, d, d - cast(row_number() over (partition by user_id order by d) as integer) as grp from d)
select user_id, min(d) as island_start, max(d) as island_end, count(*) as days from g group by user_id, grp
""")
def gaps_islands(t):
    """Runs of consecutive active days per user (day - row_number)."""
    return islands(t.events, ["user_id"], "ts")


@query("gaps_islands_global", section=S, sql="""
with d as (select distinct cast(o_orderdate as date) as d from orders),
g as (select d, d - cast(row_number() over (order by d) as integer) as grp from d)
select min(d) as island_start, max(d) as island_end, count(*) as days from g group by grp
""")
def gaps_islands_global(t):
    """The reference's form without a key: the window runs over distinct
    calendar days (bounded by the calendar, H38)."""
    return islands(t.orders, [], "o_orderdate")


@query("daily_ma_running", section=S, sql="""
with d as (select cast(o_orderdate as date) as day, sum(o_totalprice) as s from orders group by 1)
select day, round(s, 4) as sales,
       round(avg(s) over (order by day rows between 2 preceding and current row), 4) as ma3,
       round(sum(s) over (order by day rows between unbounded preceding and current row), 2) as running
from d
""")
def daily_ma_running(t):
    """Daily totals, then a 3-row mean and a running sum sharing one sort
    (one row per day, so the ordered window is small)."""
    d = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("s"))
    w = Window.orderBy("day")
    return d.select("day", F.round("s", 4).alias("sales"),
                    F.round(F.avg("s").over(w.rowsBetween(-2, 0)), 4).alias("ma3"),
                    F.round(F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, 0)), 2).alias("running"))


@query("monthly_ma", section=S, sql="""
with m as (select cast(last_day(o_orderdate) as date) as m_end, sum(o_totalprice) as m_sales from orders group by 1)
select m_end, round(m_sales, 4) as m_sales,
       round(avg(m_sales) over (order by m_end rows between 2 preceding and current row), 4) as ma3 from m
""")
def monthly_ma(t):
    m = t.orders.groupBy(F.last_day("o_orderdate").alias("m_end")).agg(F.sum("o_totalprice").alias("s"))
    w = Window.orderBy("m_end").rowsBetween(-2, 0)
    return m.select("m_end", F.round("s", 4).alias("m_sales"), F.round(F.avg("s").over(w), 4).alias("ma3"))
