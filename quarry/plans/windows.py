"""SURVEY 2.5: window functions."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.operators.windows import global_rank, global_ranks, running_sum, trailing

S = "2.5"
def _wc():
    return Window.partitionBy("o_custkey")
SUMS_SQL = "sums as (select o_custkey, round(sum(o_totalprice), 4) as total from orders group by o_custkey)"


def _sums(t):
    return t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 4).alias("total"))


@query("win_row_number", section=S, sql="""
select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from orders
""")
def win_row_number(t):
    """Row number per customer as a running count: per (customer, year)
    numbering plus the counts of earlier years, so a hot customer spreads
    over its years."""
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.lit(1).alias("one"))
    r = running_sum(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", "one", "rn", bucket=_year)
    return r.select("o_custkey", "o_orderkey", "rn")


def _year(c):
    return F.date_trunc("year", c)


def _prev_price(t):
    """Previous order amount of the customer: a one-row trailing frame with
    halo rows from earlier years (hot-key safe lag)."""
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return trailing(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", -1, -1,
                    {"prev": (F.max, "o_totalprice")}, bucket=_year)


@query("win_latest_per_group", section=S, sql="""
select o_custkey, o_orderkey, o_orderdate, o_totalprice from (
  select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders)
where rn = 1
""")
def win_latest_per_group(t):
    """Latest row per key as max(struct): partial aggregation, no sort of a
    hot key (equal to ROW_NUMBER ... rn = 1 with the key tie-break)."""
    g = t.orders.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_totalprice")).alias("s"))
    return g.select("o_custkey", "s.o_orderkey", "s.o_orderdate", "s.o_totalprice")


@query("win_top1_per_group", section=S, sql="""
select o_custkey, o_orderkey, o_totalprice from (
  select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders)
where rn = 1
""")
def win_top1_per_group(t):
    g = t.orders.groupBy("o_custkey").agg(F.max(F.struct("o_totalprice", (-F.col("o_orderkey")).alias("nk"))).alias("s"))
    return g.select("o_custkey", (-F.col("s.nk")).alias("o_orderkey"), F.col("s.o_totalprice").alias("o_totalprice"))


@query("win_nth_per_group", section=S, sql="""
select o_custkey, o_orderkey, o_totalprice from (
  select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders)
where rn = 2
""")
def win_nth_per_group(t):
    w = _wc().orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return t.orders.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 2) \
        .select("o_custkey", "o_orderkey", "o_totalprice")


@query("win_topn_per_group", section=S, sql="""
select o_custkey, o_orderkey, o_totalprice, rn from (
  select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders)
where rn <= 3
""")
def win_topn_per_group(t):
    w = _wc().orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return t.orders.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= 3) \
        .select("o_custkey", "o_orderkey", "o_totalprice", "rn")


@query("win_rank_dense", section=S, sql=f"""
with {SUMS_SQL}
select o_custkey, total, rank() over (order by total desc) as rnk, dense_rank() over (order by total desc) as drnk
from sums
""")
def win_rank_dense(t):
    """RANK and DENSE_RANK over all customers without a single-partition
    window: range buckets + offsets (see operators.windows)."""
    return global_ranks(_sums(t), [("total", False)], {"rnk": "rank", "drnk": "dense_rank"})


@query("win_percent_rank", section=S, sql=f"""
with {SUMS_SQL}
select o_custkey, total, percent_rank() over (order by total) as pct_rank from sums
""")
def win_percent_rank(t):
    return global_rank(_sums(t), [("total", True)], "percent_rank", "pct_rank")


@query("win_pct_rank_avg", section=S, sql=f"""
with {SUMS_SQL},
r as (select o_custkey, total, rank() over (order by total) as rk, count(*) over (partition by total) as ties,
             count(*) over () as n from sums)
select o_custkey, total, (rk + (ties - 1) / 2.0) / n as pct_avg from r
""")
def win_pct_rank_avg(t):
    """pandas rank(pct=True): average rank of the tie group / n (H5)."""
    s = _sums(t)
    r = global_rank(s, [("total", True)], "rank", "rk")
    ties = s.groupBy(F.col("total").alias("k")).agg(F.count(F.lit(1)).alias("ties"))
    n = s.agg(F.count(F.lit(1))).scalar()
    return r.join(ties, F.col("total").eqNullSafe(F.col("k"))).select("o_custkey", "total",
                                        ((F.col("rk") + (F.col("ties") - 1) / 2.0) / n).alias("pct_avg"))


@query("win_ntile", section=S, sql=f"""
with {SUMS_SQL}
select o_custkey, total, ntile(10) over (order by total desc, o_custkey) as decile from sums
""")
def win_ntile(t):
    return global_rank(_sums(t), [("total", False), ("o_custkey", True)], "ntile", "decile", ntiles=10)


@query("global_row_number", section=S, sql=f"""
with {SUMS_SQL}
select o_custkey, total, row_number() over (order by total desc, o_custkey) as rn from sums
""")
def global_row_number_q(t):
    return global_rank(_sums(t), [("total", False), ("o_custkey", True)], "row_number", "rn")


@query("win_lag_diff", section=S, sql="""
select o_custkey, o_orderkey, o_totalprice - lag(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey) as diff
from orders
""")
def win_lag_diff(t):
    return _prev_price(t).select("o_custkey", "o_orderkey", (F.col("o_totalprice") - F.col("prev")).alias("diff"))


@query("win_pct_change", section=S, sql="""
with l as (select o_custkey, o_orderkey, o_totalprice as v,
                  lag(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey) as p from orders)
select o_custkey, o_orderkey, (v - p) / nullif(p, 0) as pct_change from l
""")
def win_pct_change(t):
    """Relative change; division by a zero previous value gives NULL."""
    p = F.col("prev")
    return _prev_price(t).select("o_custkey", "o_orderkey", F.try_divide(F.col("o_totalprice") - p, p).alias("pct_change"))


@query("win_running_total", section=S, sql="""
select o_custkey, o_orderkey,
       round(sum(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey
                                     rows between unbounded preceding and current row), 4) as running
from orders
""")
def win_running_total(t):
    """Cumulative sum per customer: per (customer, year) running sums plus a
    carry of earlier years, so a hot customer is not one sorted task."""
    r = running_sum(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"),
                    ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", "o_totalprice", "running",
                    bucket=lambda c: F.date_trunc("year", c))
    return r.select("o_custkey", "o_orderkey", F.round("running", 4).alias("running"))


@query("win_expanding_mean", section=S, sql="""
select o_custkey, o_orderkey,
       round(avg(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey
                                     rows between unbounded preceding and current row), 4) as expanding_mean
from orders
""")
def win_expanding_mean(t):
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", F.lit(1).alias("one"))
    yb = lambda c: F.date_trunc("year", c)
    r = running_sum(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", "o_totalprice", "s", bucket=yb)
    r = running_sum(r, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", "one", "n", bucket=yb)
    return r.select("o_custkey", "o_orderkey", F.round(F.col("s") / F.col("n"), 4).alias("expanding_mean"))


_DAILY_SQL = "daily as (select cast(o_orderdate as date) as day, round(sum(o_totalprice), 4) as sales from orders group by 1)"


def _daily(t):
    return t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.round(F.sum("o_totalprice"), 4).alias("sales"))


@query("win_moving_avg_incl", section=S, sql=f"""
with {_DAILY_SQL}
select day, round(avg(sales) over (order by day rows between 2 preceding and current row), 4) as ma3 from daily
""")
def win_moving_avg_incl(t):
    """3-row trailing mean over daily totals (the aggregate bounds the rows to
    one per day, so the ordered window is small -- H38)."""
    w = Window.orderBy("day").rowsBetween(-2, 0)
    return _daily(t).select("day", F.round(F.avg("sales").over(w), 4).alias("ma3"))


@query("win_moving_avg_calendar", section=S, sql=f"""
with {_DAILY_SQL}
select day, round(avg(sales) over (order by day range between interval 6 day preceding and current row), 4) as ma7d
from daily
""")
def win_moving_avg_calendar(t):
    """Trailing 7 *calendar* days (H25): RANGE frame on the day number."""
    w = Window.orderBy(F.unix_date("day")).rangeBetween(-6, 0)
    return _daily(t).select("day", F.round(F.avg("sales").over(w), 4).alias("ma7d"))


@query("win_prev_n_avg", section=S, sql="""
select o_custkey, o_orderkey, avg(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey
                                                    rows between 3 preceding and 1 preceding) as avg_prev3
from orders
""")
def win_prev_n_avg(t):
    """Leak-free mean of the 3 previous orders (excludes the current row)."""
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    r = trailing(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", -3, -1,
                 {"avg_prev3": (F.avg, "o_totalprice")}, bucket=lambda c: F.date_trunc("year", c))
    return r.select("o_custkey", "o_orderkey", "avg_prev3")


@query("win_prev4_avg", views=("matches",), section=S, sql="""
with long as (
  select match_id, match_date, home_team_id as team_id,
         case when home_score > away_score then 3 when home_score = away_score then 1 else 0 end as points from matches
  union all
  select match_id, match_date, away_team_id,
         case when away_score > home_score then 3 when away_score = home_score then 1 else 0 end from matches)
select team_id, match_id, avg(points) over (partition by team_id order by match_date, match_id
                                           rows between 4 preceding and 1 preceding) as prev4_avg from long
""")
def win_prev4_avg(t):
    """The reference's 'slow' variant: mean of the previous 4 (H3)."""
    from quarry.operators.roles import points, team_perspective
    rows = team_perspective(t.matches, keep=["match_id", "match_date"]).withColumn(
        "points", points(F.col("gf"), F.col("ga")))
    r = trailing(rows, ["team_id"], ["match_date", "match_id"], "match_date", -4, -1, {"prev4_avg": (F.avg, "points")})
    return r.select("team_id", "match_id", "prev4_avg")


@query("win_prev_n_asof", section=S, sql="""
select o_custkey, o_orderkey, avg(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey
                                                    rows between 5 preceding and 1 preceding) as avg_prev5
from orders where o_orderdate < timestamp '1999-01-01'
""")
def win_prev_n_asof(t, cut: str = "1999-01-01"):
    o = t.orders.where(F.col("o_orderdate") < F.lit(cut).cast("timestamp_ntz")) \
        .select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    r = trailing(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", -5, -1,
                 {"avg_prev5": (F.avg, "o_totalprice")}, bucket=lambda c: F.date_trunc("year", c))
    return r.select("o_custkey", "o_orderkey", "avg_prev5")


@query("win_group_share", section=S, sql="""
select l_orderkey, l_linenumber, l_partkey,
       round(l_extendedprice / sum(l_extendedprice) over (partition by l_orderkey), 8) as share from lineitem
""")
def win_group_share(t):
    """groupby.transform('sum'): per-group total joined back (partial
    aggregate + join, skew-splittable by AQE)."""
    tot = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_extendedprice").alias("tot"))
    return t.lineitem.join(tot, F.col("l_orderkey").eqNullSafe(F.col("k"))).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("l_extendedprice") / F.col("tot"), 8).alias("share"))
