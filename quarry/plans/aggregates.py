"""SURVEY 2.4: aggregations."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import query

S = "2.4"


@query("agg_count_star", section=S, sql="""
select count(*) as n_rows from customer c left join orders o
  on o.o_custkey = c.c_custkey
""")
def agg_count_star(t):
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").agg(F.count(F.lit(1)).alias("n_rows"))


@query("agg_count_col", section=S, sql="""
select count(o.o_orderkey) as n_orders from customer c
left join orders o on o.o_custkey = c.c_custkey
""")
def agg_count_col(t):
    """COUNT(col) skips NULLs."""
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").agg(F.count("o_orderkey").alias("n_orders"))


@query("agg_count_distinct", section=S, sql="""
select o_orderstatus, count(distinct o_custkey) as n_customers from orders group by o_orderstatus
""")
def agg_count_distinct(t):
    return t.orders.groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("n_customers"))


@query("agg_count_distinct_approx", section=S)
def agg_count_distinct_approx(t):
    """HyperLogLog++ variant for scale (fixed-size state per group)."""
    return t.orders.groupBy("o_orderstatus").agg(F.approx_count_distinct("o_custkey", 0.01).alias("n_customers"))


@query("agg_count_distinct_error", section=S, sql="""
select o_orderstatus, count(distinct o_custkey) as n_customers, true as within_5_percent from orders group by o_orderstatus
""")
def agg_count_distinct_error(t):
    """The approximate count held against the exact one.

    Both count the distinct (status, customer), which changes no sketch: beside a DISTINCT aggregate Spark would keep a
    sketch for every pair of them."""
    exact, approx = F.count("o_custkey"), F.approx_count_distinct("o_custkey", 0.01)
    return t.orders.select("o_orderstatus", "o_custkey").distinct().groupBy("o_orderstatus").agg(exact.alias("n_customers"), (F.abs(approx - exact) <= 0.05 * exact).alias("within_5_percent"))


@query("agg_sum_by", section=S, sql="""
select o_custkey, round(sum(o_totalprice), 4) as total from orders group by o_custkey
""")
def agg_sum_by(t):
    return t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 4).alias("total"))


@query("agg_multi", section=S, sql="""
select o_custkey, round(sum(o_totalprice), 4) as total, max(o_totalprice) as max_order, count(*) as n_orders
from orders group by o_custkey
""")
def agg_multi(t):
    return t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 4).alias("total"),
                                             F.max("o_totalprice").alias("max_order"),
                                             F.count(F.lit(1)).alias("n_orders"))


@query("agg_basic_stats", section=S, sql="""
select round(sum(l_quantity), 4) as s, round(avg(l_quantity), 8) as mean, round(var_pop(l_quantity), 6) as var,
       round(stddev_pop(l_quantity), 8) as std, min(l_quantity) as mn, max(l_quantity) as mx,
       arg_max(l_orderkey, struct_pack(q := l_quantity, k := l_orderkey)) as argmax_order
from lineitem
""")
def agg_basic_stats(t):
    """numpy statistics are population (ddof=0, H6); arg-max as max_by with a
    deterministic tie-break."""
    return t.lineitem.agg(F.round(F.sum("l_quantity"), 4).alias("s"), F.round(F.avg("l_quantity"), 8).alias("mean"),
                          F.round(F.var_pop("l_quantity"), 6).alias("var"),
                          F.round(F.stddev_pop("l_quantity"), 8).alias("std"),
                          F.min("l_quantity").alias("mn"), F.max("l_quantity").alias("mx"),
                          F.max_by("l_orderkey", F.struct("l_quantity", "l_orderkey")).alias("argmax_order"))


@query("agg_conditional", section=S, sql="""
select l_returnflag, cast(sum(case when l_discount > 0.05 then 1 else 0 end) as bigint) as n_discounted,
       count(*) filter (where l_linestatus = 'F') as n_final
from lineitem group by l_returnflag
""")
def agg_conditional(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.sum(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).alias("n_discounted"),
        F.count_if(F.col("l_linestatus") == "F").alias("n_final"))


@query("agg_avg_case", section=S, sql="""
select l_returnflag, round(avg(case when l_linestatus = 'F' then l_quantity end), 8) as avg_final_qty
from lineitem group by l_returnflag
""")
def agg_avg_case(t):
    """Mean over matching rows only (no ELSE: other rows are NULL, not 0)."""
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.avg(F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))), 8).alias("avg_final_qty"))


@query("agg_having", section=S, sql="""
select o_custkey, count(*) as n_orders from orders group by o_custkey having count(*) > 15
""")
def agg_having(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")).where(F.col("n_orders") > 15)


@query("agg_avg_by", section=S, sql="""
select o_custkey, round(avg(o_totalprice), 6) as avg_order_value from orders group by o_custkey
""")
def agg_avg_by(t):
    return t.orders.groupBy("o_custkey").agg(F.round(F.avg("o_totalprice"), 6).alias("avg_order_value"))


@query("agg_year", section=S, sql="""
select cast(year(o_orderdate) as integer) as yr, round(sum(o_totalprice), 4) as total from orders group by year(o_orderdate)
""")
def agg_year(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("yr")).agg(F.round(F.sum("o_totalprice"), 4).alias("total"))


@query("agg_month", section=S, sql="""
select strftime(date_trunc('month', o_orderdate), '%Y-%m') as ym, cast(last_day(o_orderdate) as date) as m_end,
       round(sum(o_totalprice), 4) as total_sales
from orders group by date_trunc('month', o_orderdate), last_day(o_orderdate)
""")
def agg_month(t):
    """Group on the month start, format only for output."""
    g = t.orders.groupBy(F.date_trunc("month", "o_orderdate").alias("m")).agg(
        F.round(F.sum("o_totalprice"), 4).alias("total_sales"))
    return g.select(F.date_format("m", "yyyy-MM").alias("ym"), F.last_day("m").alias("m_end"), "total_sales")


@query("agg_day", section=S, sql="""
select cast(o_orderdate as date) as day, round(sum(o_totalprice), 4) as total from orders group by cast(o_orderdate as date)
""")
def agg_day(t):
    return t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.round(F.sum("o_totalprice"), 4).alias("total"))


@query("agg_ratio_arpu", section=S, sql="""
select round(sum(o_totalprice) / count(distinct o_custkey), 4) as arpu from orders
""")
def agg_ratio_arpu(t):
    return t.orders.agg(F.round(F.sum("o_totalprice") / F.countDistinct("o_custkey"), 4).alias("arpu"))


@query("agg_pct_above_mean", section=S, sql="""
with m as (select avg(o_totalprice) as mu from orders)
select round(avg(case when o_totalprice > mu then 1e0 else 0e0 end) * 100, 6) as pct_above from orders cross join m
""")
def agg_pct_above_mean(t):
    mu = t.orders.agg(F.avg("o_totalprice")).scalar()
    return t.orders.agg(F.round(F.avg((F.col("o_totalprice") > mu).cast("double")) * 100, 6).alias("pct_above"))


@query("agg_share_of_total", section=S, sql="""
with cat as (select p.p_type as category, sum(l.l_extendedprice) as sales
             from lineitem l join part p on p.p_partkey = l.l_partkey group by p.p_type),
tot as (select sum(sales) as total_sales from cat)
select category, round(sales, 4) as sales, round(100.0 * sales / nullif(total_sales, 0), 2) as pct
from cat cross join tot
""")
def agg_share_of_total(t):
    """Category share of the grand total; the total is a one-row broadcast (H19 guarded)."""
    cat = (t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
           .groupBy(F.col("p_type").alias("category")).agg(F.sum("l_extendedprice").alias("sales")))
    total = cat.agg(F.sum("sales")).scalar()
    return cat.select("category", F.round("sales", 4).alias("sales"),
                      F.round(F.try_divide(100.0 * F.col("sales"), total), 2).alias("pct"))


@query("agg_weighted_avg", section=S, sql="""
select l_returnflag, round(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0), 6) as wavg_price
from lineitem group by l_returnflag
""")
def agg_weighted_avg(t):
    """sum(x*w) / sum(w), NULL when the weights sum to 0."""
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.try_divide(
        F.sum(F.col("l_extendedprice") * F.col("l_quantity")), F.sum("l_quantity")), 6).alias("wavg_price"))


@query("agg_string_agg", section=S, sql="""
select o_custkey, string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey) as order_ids
from orders group by o_custkey
""")
def agg_string_agg(t):
    """STRING_AGG with a stated order (H17).  listagg ... WITHIN GROUP
    concatenates per group; the group's text is the result itself."""
    return t.orders.groupBy("o_custkey").agg(
        F.expr("listagg(cast(o_orderkey as string), ',') within group (order by o_orderkey)").alias("order_ids"))


@query("agg_percentiles", section=S, sql="""
select o_orderpriority, quantile_cont(o_totalprice, 0.25) as p25, quantile_cont(o_totalprice, 0.5) as median,
       quantile_cont(o_totalprice, 0.75) as p75 from orders group by o_orderpriority
""")
def agg_percentiles(t):
    """Exact linear quantiles without collecting a group (see stats.quantiles)."""
    from quarry.operators.stats import quantiles
    return quantiles(t.orders, "o_totalprice", {"p25": 0.25, "median": 0.5, "p75": 0.75}, by=["o_orderpriority"])


@query("agg_percentiles_global", section=S, sql="""
select quantile_cont(l_extendedprice, 0.25) as p25, quantile_cont(l_extendedprice, 0.5) as median,
       quantile_cont(l_extendedprice, 0.75) as p75 from lineitem
""")
def agg_percentiles_global(t):
    from quarry.operators.stats import quantiles
    return quantiles(t.lineitem, "l_extendedprice", {"p25": 0.25, "median": 0.5, "p75": 0.75})


@query("agg_argmax_row", views=("odds",), section=S, sql="""
select match_id, odds_id, bookmaker, case when home_win >= draw and home_win >= away_win then 'home_win'
                                          when draw >= away_win then 'draw' else 'away_win' end as best
from odds
""")
def agg_argmax_row(t):
    """Row-wise arg-max over columns; ties go to the first column."""
    h, d, a = F.col("home_win"), F.col("draw"), F.col("away_win")
    best = F.greatest(h, d, a)
    return t.odds.select("match_id", "odds_id", "bookmaker",
                         F.when(h == best, "home_win").when(d == best, "draw").otherwise("away_win").alias("best"))


@query("agg_argmax_time", section=S, sql="""
select cast(o_orderdate as date) as peak_day from orders group by cast(o_orderdate as date)
order by sum(o_totalprice) desc, 1 limit 1
""")
def agg_argmax_time(t):
    """idxmax over a daily series: max_by over the per-day aggregate."""
    d = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("s"))
    return d.agg(F.max_by("day", F.struct("s", -F.unix_date("day"))).alias("peak_day"))


@query("agg_axis", section=S, sql="""
select vec_id, round(list_sum(embedding), 4) as row_sum from embeddings
""")
def agg_axis(t):
    """Row sums of a matrix stored as arrays (axis=1)."""
    return t.embeddings.select("vec_id", F.round(F.aggregate("embedding", F.lit(0.0),
                                                             lambda acc, x: acc + x.cast("double")), 4).alias("row_sum"))


@query("agg_axis_columns", section=S, sql="""
select i, round(sum(v), 4) as col_sum
from (select unnest(embedding) as v, unnest(range(1, len(embedding) + 1)) as i from embeddings) group by i
""")
def agg_axis_columns(t):
    """Column sums (axis=0): posexplode to long form, group by position."""
    return (t.embeddings.select(F.posexplode("embedding").alias("p", "v"))
            .groupBy((F.col("p") + 1).alias("i")).agg(F.round(F.sum(F.col("v").cast("double")), 4).alias("col_sum")))


@query("agg_any_all", section=S, sql="""
select o_orderstatus, bool_or(o_totalprice > 400000) as any_big, bool_and(o_totalprice > 1000) as all_over_1k
from orders group by o_orderstatus
""")
def agg_any_all(t):
    return t.orders.groupBy("o_orderstatus").agg(F.bool_or(F.col("o_totalprice") > 400000).alias("any_big"),
                                                 F.bool_and(F.col("o_totalprice") > 1000).alias("all_over_1k"))


@query("agg_top_value", section=S, sql="""
select event_type, count(*) as n from events group by event_type order by n desc, event_type limit 1
""")
def agg_top_value(t):
    """Most common value, ties broken by the value."""
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.col("n").desc(), "event_type").limit(1)


@query("agg_max_gap", section=S, sql="""
with g as (select o_custkey, date_diff('day', cast(lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as date),
                                       cast(o_orderdate as date)) as gap from orders)
select o_custkey, max(gap) as max_gap_days from g group by o_custkey having max(gap) is not null
""")
def agg_max_gap(t):
    """Largest day gap between consecutive orders of a customer."""
    from quarry.operators.windows import trailing
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    prev = trailing(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", -1, -1,
                    {"prev_date": (F.max, "o_orderdate")}, bucket=lambda c: F.date_trunc("year", c))
    g = prev.select("o_custkey", F.datediff(F.to_date("o_orderdate"), F.to_date("prev_date")).alias("gap"))
    return g.groupBy("o_custkey").agg(F.max("gap").alias("max_gap_days")).where(F.col("max_gap_days").isNotNull())
