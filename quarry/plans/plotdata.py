"""SURVEY 2.12: the data behind each chart (rendering is not built)."""
from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.catalog import query

S = "2.12"
BINS = 20


@query("plot_line_daily", section=S, sql="""
with d as (select cast(o_orderdate as date) as day, sum(o_totalprice) as s from orders group by 1)
select day, round(s, 4) as sales, round(avg(s) over (order by day rows between 6 preceding and current row), 4) as ma7,
       s = max(s) over () as is_peak from d
""")
def plot_line_daily(t):
    """Daily series, 7-row moving average overlay and the peak point (one row
    per day; the ordered window runs over the calendar-bounded table)."""
    d = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("s"))
    peak = d.agg(F.max("s")).scalar()
    w = Window.orderBy("day").rowsBetween(-6, 0)
    return d.select("day", F.round("s", 4).alias("sales"), F.round(F.avg("s").over(w), 4).alias("ma7"),
                    (F.col("s") == peak).alias("is_peak"))


@query("plot_bar_groups", section=S, sql="""
select o_orderpriority, round(sum(o_totalprice), 4) as total from orders group by 1
""")
def plot_bar_groups(t):
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.sum("o_totalprice"), 4).alias("total"))


def _hist_bin(x, lo, hi, n):
    # equal-width bins, the last one closed on the right
    return F.least(F.floor((x - lo) / (hi - lo) * n) + 1, F.lit(n)).cast("int")


_HIST_SQL = f"""
with b as (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders),
x as (select o.*, least(floor((o_totalprice - lo) / (hi - lo) * {BINS}) + 1, {BINS})::integer as bin, lo, hi
      from orders o, b)
"""


@query("plot_histogram", section=S, sql=_HIST_SQL + f"""
select bin, round(min(lo) + (bin - 1) * (min(hi) - min(lo)) / {BINS}, 4) as bin_lo, count(*) as n from x group by bin
""")
def plot_histogram(t):
    """Equal-width bin counts; bounds come from two scalar subqueries."""
    lo = t.orders.agg(F.min("o_totalprice")).scalar()
    hi = t.orders.agg(F.max("o_totalprice")).scalar()
    b = t.orders.select(_hist_bin(F.col("o_totalprice"), lo, hi, BINS).alias("bin"), lo.alias("lo"), hi.alias("hi"))
    return b.groupBy("bin").agg(F.round(F.min("lo") + (F.col("bin") - 1) * (F.min("hi") - F.min("lo")) / BINS, 4)
                                .alias("bin_lo"), F.count(F.lit(1)).alias("n"))


@query("plot_facet_counts", section=S, sql=_HIST_SQL + """
select o_orderpriority, o_orderstatus, bin, count(*) as n from x group by 1, 2, 3
""")
def plot_facet_counts(t):
    lo = t.orders.agg(F.min("o_totalprice")).scalar()
    hi = t.orders.agg(F.max("o_totalprice")).scalar()
    return (t.orders.select("o_orderpriority", "o_orderstatus", _hist_bin(F.col("o_totalprice"), lo, hi, BINS).alias("bin"))
            .groupBy("o_orderpriority", "o_orderstatus", "bin").agg(F.count(F.lit(1)).alias("n")))


GRID = 50


def _density_sql(by: str) -> str:
    group = f"{by}, " if by else ""
    return f"""
with s as (select {group}min(o_totalprice) as lo, max(o_totalprice) as hi, stddev_samp(o_totalprice) as sd, count(*) as n
           from orders{f" group by {by}" if by else ""}),
g as (select {group}i::integer as i, lo + i * (hi - lo) / {GRID - 1} as x, sd * pow(n, -0.2) as h, n from s, range({GRID}) r(i))
select {group}i, round(x, 4) as x, round(sum(exp(-0.5 * ((x - o_totalprice) / h) ^ 2)) / (n * h * sqrt(2 * pi())), 12) as density
from g join orders {f"using ({by})" if by else "on true"} group by {group}i, x, h, n
"""


def _density(rows, by):
    """Gaussian kernels (Scott's bandwidth) on a grid: one sum a grid point in one aggregate over all rows."""
    h = F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))

    def point(i):
        return F.col("lo") + i * (F.col("hi") - F.col("lo")) / (GRID - 1)
    z = [(point(F.lit(i)) - F.col("o_totalprice")) / h for i in range(GRID)]
    sums = rows.groupBy(*by, "lo", "hi", "sd", "n").agg(*[F.sum(F.exp(-0.5 * d * d)).alias(f"k{i}") for i, d in enumerate(z)])
    long = sums.select(*by, "lo", "hi", "sd", "n", F.posexplode(F.array(*[f"k{i}" for i in range(GRID)])).alias("i", "k"))
    return long.select(*by, "i", F.round(point(F.col("i")), 4).alias("x"),
                       F.round(F.col("k") / (F.col("n") * h * math.sqrt(2 * math.pi)), 12).alias("density"))


def _spread(x):
    return [F.min(x).alias("lo"), F.max(x).alias("hi"), F.stddev_samp(x).alias("sd"), F.count(x).alias("n")]


@query("plot_kde", section=S, sql=_density_sql(""))
def plot_kde(t):
    """Exact Gaussian density of order totals at 50 points."""
    stats = t.orders.agg(*_spread(F.col("o_totalprice")))
    rows = t.orders.select("o_totalprice", *[stats.select(c).scalar().alias(c) for c in ("lo", "hi", "sd", "n")])
    return _density(rows, [])


@query("plot_violin", section=S, sql=_density_sql("o_orderpriority"))
def plot_violin(t):
    """The same density for each priority; the quartiles inside it are those of plot_box_stats."""
    stats = t.orders.groupBy("o_orderpriority").agg(*_spread(F.col("o_totalprice")))
    return _density(t.orders.select("o_orderpriority", "o_totalprice").join(stats, "o_orderpriority"), ["o_orderpriority"])


@query("plot_box_stats", section=S, sql="""
with q as (select o_orderpriority, quantile_cont(o_totalprice, 0.25) as q1, quantile_cont(o_totalprice, 0.5) as med,
                  quantile_cont(o_totalprice, 0.75) as q3 from orders group by 1)
select q.o_orderpriority, round(q1, 4) as q1, round(med, 4) as med, round(q3, 4) as q3,
       min(o_totalprice) filter (where o_totalprice >= q1 - 1.5 * (q3 - q1)) as whisker_lo,
       max(o_totalprice) filter (where o_totalprice <= q3 + 1.5 * (q3 - q1)) as whisker_hi,
       count(*) filter (where o_totalprice < q1 - 1.5 * (q3 - q1) or o_totalprice > q3 + 1.5 * (q3 - q1)) as n_outliers
from q join orders o on o.o_orderpriority = q.o_orderpriority group by all
""")
def plot_box_stats(t):
    from quarry.operators.stats import quantiles
    q = quantiles(t.orders, "o_totalprice", {"q1": 0.25, "med": 0.5, "q3": 0.75}, by=["o_orderpriority"])
    j = t.orders.select("o_orderpriority", "o_totalprice").join(q, "o_orderpriority")
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    x = F.col("o_totalprice")
    return j.groupBy("o_orderpriority", "q1", "med", "q3").agg(
        F.min(F.when(x >= lo_f, x)).alias("whisker_lo"), F.max(F.when(x <= hi_f, x)).alias("whisker_hi"),
        F.count_if((x < lo_f) | (x > hi_f)).alias("n_outliers")).select(
        "o_orderpriority", *[F.round(c, 4).alias(c) for c in ("q1", "med", "q3")], "whisker_lo", "whisker_hi", "n_outliers")


@query("plot_scatter_grid", section=S, sql="""
select l_quantity, floor(l_extendedprice / 1000)::bigint as price_bin, count(*) as n from lineitem group by all
""")
def plot_scatter_grid(t):
    """All (quantity, price) points as counts on a grid: complete, and as small as the grid."""
    return t.lineitem.groupBy("l_quantity", F.floor(F.col("l_extendedprice") / 1000).alias("price_bin")).agg(
        F.count(F.lit(1)).alias("n"))


_LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_PAIRS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("plot_scatter_sample", section=S, sql="""
with h as (
  select l_returnflag, l_quantity, l_extendedprice, row_number() over (
    partition by l_returnflag order by md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)),
    l_orderkey, l_linenumber, l_partkey, l_suppkey) as n from lineitem)
select l_returnflag, l_quantity, l_extendedprice from h where n <= 500
""")
def plot_scatter_sample(t, k: int = 500):
    """At most k points a panel for a scatter plot: the sample is the feature, the smallest MD5s of the row key decide;
    plot_scatter_grid and plot_pairs have all points."""
    from quarry.operators.sampling import bottom_k
    return bottom_k(t.lineitem, k, _LINE_KEY, ["l_returnflag"]).select("l_returnflag", "l_quantity", "l_extendedprice")


@query("plot_pairs", section=S, sql="""
with e as (select """ + ", ".join(f"min({c}) as lo_{c}, max({c}) as hi_{c}" for c in _PAIRS) + """ from lineitem),
b as (select """ + ", ".join(
    f"least(floor(({c} - lo_{c}) * 10 / (hi_{c} - lo_{c})), 9)::int as {c}" for c in _PAIRS) + """ from lineitem, e)
""" + "\nunion all\n".join(f"select '{a}' as col_x, '{b}' as col_y, {a} as bin_x, {b} as bin_y, count(*) as n from b group by all"
                         for i, a in enumerate(_PAIRS) for b in _PAIRS[i + 1:]))
def plot_pairs(t):
    """Pairwise panels: the point counts of every pair of columns on a 10 x 10 grid."""
    from quarry.operators.sampling import pair_grids
    return pair_grids(t.lineitem, _PAIRS, 10)


@query("plot_regression", section=S, sql="""
select round(regr_slope(l_extendedprice, l_quantity), 6) as slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept from lineitem
""")
def plot_regression(t):
    return t.lineitem.agg(F.round(F.regr_slope("l_extendedprice", "l_quantity"), 6).alias("slope"),
                          F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 4).alias("intercept"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("plot_corr_heatmap", section=S, sql="""
select col_a, col_b, round(c, 8) as corr from (
""" + "\n  union all\n".join(
    f"  select 'c_acctbal' as col_a, '{v}' as col_b, corr(c_acctbal, cast(c_mktsegment = '{v}' as double)) as c from customer"
    for v in SEGMENTS) + "\n)")
def plot_corr_heatmap(t):
    """Correlation of a numeric column with one-hot dummies, long form."""
    c = t.customer
    wide = c.agg(*[F.corr("c_acctbal", (F.col("c_mktsegment") == v).cast("double")).alias(v) for v in SEGMENTS])
    longf = wide.unpivot([], SEGMENTS, "col_b", "c")
    return longf.select(F.lit("c_acctbal").alias("col_a"), "col_b", F.round("c", 8).alias("corr"))


@query("plot_corr_matrix", section=S, sql="""
with wide as (
  select c_acctbal, """ + ", ".join(f"(c_mktsegment = '{v}')::int::double as {v.lower()}" for v in SEGMENTS[1:]) + """ from customer)
""" + "\nunion all\n".join(f"select '{a}' as col_a, '{b}' as col_b, round(corr({a}, {b}), 8) as corr from wide"
                         for a in ["c_acctbal", *map(str.lower, SEGMENTS[1:])] for b in ["c_acctbal", *map(str.lower, SEGMENTS[1:])]))
def plot_corr_matrix(t):
    """Every pair of a numeric column and the dummies without the first level, in one aggregate."""
    from quarry.operators.reshape import one_hot
    wide = one_hot(t.customer.select("c_acctbal", "c_mktsegment"), "c_mktsegment", SEGMENTS, prefix="d")
    cols = {"c_acctbal": "c_acctbal", **{v.lower(): f"d_{v}" for v in sorted(SEGMENTS)[1:]}}
    pairs = [(a, b) for a in cols for b in cols]
    one = wide.agg(*[F.corr(F.col(cols[a]).cast("double"), F.col(cols[b]).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    return one.unpivot([], [F.col(f"`{a}|{b}`") for a, b in pairs], "pair", "c").select(
        F.split_part("pair", F.lit("|"), F.lit(1)).alias("col_a"), F.split_part("pair", F.lit("|"), F.lit(2)).alias("col_b"),
        F.round("c", 8).alias("corr"))


@query("plot_weekly_overlay", section=S, sql="""
with d as (select cast(o_orderdate as date) as day, sum(o_totalprice) as s from orders group by 1)
select day, round(s, 4) as sales, round(avg(s) over (partition by date_trunc('week', day)), 4) as week_mean from d
""")
def plot_weekly_overlay(t):
    """Daily totals and the mean of the days of their week."""
    d = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("s"))
    week = Window.partitionBy(F.date_trunc("week", "day"))
    return d.select("day", F.round("s", 4).alias("sales"), F.round(F.avg("s").over(week), 4).alias("week_mean"))
