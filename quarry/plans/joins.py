"""SURVEY 2.3: joins, including as-of, role and pair joins."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.operators import joins as J
from quarry.operators.asof import asof_join, safe_asof
from quarry.operators.roles import explode_teams

S = "2.3"


@query("join_inner", section=S, sql="""
select o.o_orderkey, c.c_name from orders o join customer c on c.c_custkey = o.o_custkey
""")
def join_inner(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("join_dim_twice", views=("matches", "teams"), section=S, sql="""
select m.match_id, th.team_name as home, ta.team_name as away
from matches m join teams th on th.team_id = m.home_team_id join teams ta on ta.team_id = m.away_team_id
""")
def join_dim_twice(t):
    """Same 25-row dimension in two roles (broadcast: fixed bound)."""
    th = t.teams.select(F.col("team_id").alias("home_team_id"), F.col("team_name").alias("home"))
    ta = t.teams.select(F.col("team_id").alias("away_team_id"), F.col("team_name").alias("away"))
    return t.matches.join(th, "home_team_id").join(ta, "away_team_id").select("match_id", "home", "away")


@query("join_left", section=S, sql=f"""
select c.c_custkey, c.c_name, o.o_orderkey from customer c left join orders o
  on o.o_custkey = c.c_custkey
""")
def join_left(t):
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left") \
        .select("c_custkey", "c_name", "o_orderkey")


@query("join_full_ordered_ffill", section=S, sql="""
with a as (select cast(o_orderdate as date) as d, count(*) as x from orders group by 1),
b as (select cast(l_shipdate as date) as d, count(*) as y from lineitem group by 1),
j as (select coalesce(a.d, b.d) as d, a.x, b.y from a full join b on a.d = b.d)
select d, last_value(x ignore nulls) over (order by d rows between unbounded preceding and current row) as x,
          last_value(y ignore nulls) over (order by d rows between unbounded preceding and current row) as y
from j
""")
def join_full_ordered_ffill(t):
    """merge_ordered(how='outer', fill_method='ffill') on a daily key."""
    a = t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("x"))
    b = t.lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg(F.count(F.lit(1)).alias("y"))
    return J.merge_ordered_ffill(a, b, "d", ["x", "y"])


@query("join_full_ordered_ffill_keys", section=S, sql="""
with a as (select o_orderkey as k, o_totalprice as price from orders where o_orderkey % 3 <> 0),
b as (select l_orderkey as k, sum(l_quantity) as quantity from lineitem where l_orderkey % 2 = 0 group by l_orderkey),
j as (select coalesce(a.k, b.k) as k, a.price, b.quantity from a full join b on a.k = b.k)
select k, last_value(price ignore nulls) over (order by k rows between unbounded preceding and current row) as price,
          last_value(quantity ignore nulls) over (order by k rows between unbounded preceding and current row) as quantity
from j
""")
def join_full_ordered_ffill_keys(t):
    """The same on a key that grows with the data: filled in ranges of the key, each range starting with the last value
    of those before it."""
    a = t.orders.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"))
    b = t.lineitem.where("l_orderkey % 2 = 0").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_quantity").alias("quantity"))
    return J.merge_ordered_ffill(a, b, "k", ["price", "quantity"])


@query("join_cross", views=("matches",), section=S, sql="""
select m.match_id, b.bookmaker from matches m, (values ('BK0'), ('BK1'), ('BK2')) b(bookmaker)
""")
def join_cross(t):
    """merge(how='cross') with a fixed bookmaker list: a generator over the
    literal list, so each match row expands locally (no pair join)."""
    return t.matches.select("match_id", F.explode(F.array(*[F.lit(b) for b in ("BK0", "BK1", "BK2")])).alias("bookmaker"))


@query("join_anti", section=S, sql="""
select o.o_orderkey, o.o_custkey from orders o left join lineitem l on l.l_orderkey = o.o_orderkey where l.l_orderkey is null
""")
def join_anti(t):
    """LEFT JOIN ... IS NULL written as left_anti (Spark keeps the outer join
    otherwise): orders without lines."""
    return t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey", "o_custkey")


@query("join_semi_exists", section=S, sql=f"""
select c.c_custkey, c.c_name from customer c
where exists (select 1 from orders o where o.o_custkey = c.c_custkey)
""")
def join_semi_exists(t):
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


@query("join_role_in", views=("matches", "injuries"), section=S, sql="""
select m.match_id, count(i.player_id) as n_reports
from matches m left join injuries i
  on i.team_id in (m.home_team_id, m.away_team_id) and i.reported_at <= m.match_date - interval 7 day
group by m.match_id
""")
def join_role_in(t):
    """``team_id IN (home, away)`` without a nested-loop join: the match is
    exploded to its two teams and each (match, team) reads the team's running
    report count as of the cutoff; no match x report pairs are formed."""
    rep = t.injuries.where(F.col("player_id").isNotNull()).groupBy("team_id", "reported_at") \
        .agg(F.count(F.lit(1)).alias("n"))
    from quarry.operators.windows import running_sum
    cum = running_sum(rep, ["team_id"], ["reported_at"], "reported_at", "n", "n_so_far")
    mt = explode_teams(t.matches, keep=["match_id", "match_date"]).withColumn(
        "cutoff", F.col("match_date") - F.expr("INTERVAL 7 DAYS"))
    j = asof_join(mt, cum.select("team_id", "reported_at", "n_so_far"), "cutoff", "reported_at", by=["team_id"])
    return j.groupBy("match_id").agg(F.sum(F.coalesce("n_so_far", F.lit(0))).alias("n_reports"))


@query("join_pair_or", views=("matches",), section=S, sql="""
select m1.match_id, count(*) as n_past_meetings
from matches m1 join matches m2
  on ((m2.home_team_id = m1.home_team_id and m2.away_team_id = m1.away_team_id)
   or (m2.home_team_id = m1.away_team_id and m2.away_team_id = m1.home_team_id))
 and m2.match_date < m1.match_date
group by m1.match_id
""")
def join_pair_or(t):
    """Earlier meetings of the same unordered pair.  The OR condition becomes
    the equi key (least, greatest); instead of forming every pair, the
    meetings per (pair, date) are counted and a running sum over earlier
    dates gives the count for each match."""
    return J.earlier_pair_counts(t.matches, "home_team_id", "away_team_id", "match_date", "match_id") \
        .where(F.col("n_past_meetings") > 0)


@query("join_range_time", views=("matches", "odds"), section=S, sql="""
select m.match_id, o.collected_at, o.odds_id from matches m join odds o on o.match_id = m.match_id
where o.collected_at < m.match_date
""")
def join_range_time(t):
    """Equi key plus time residual (hash join with a post-filter)."""
    return t.matches.join(t.odds, "match_id").where(F.col("collected_at") < F.col("match_date")) \
        .select("match_id", "collected_at", "odds_id")


@query("join_leaky", views=("matches", "odds"), section=S, sql="""
select m.match_id, o.collected_at, o.odds_id from matches m join odds o on o.match_id = m.match_id
where o.collected_at >= m.match_date
""")
def join_leaky(t):
    """The wrong join, kept as a detector: odds collected at/after kick-off."""
    return t.matches.join(t.odds, "match_id").where(F.col("collected_at") >= F.col("match_date")) \
        .select("match_id", "collected_at", "odds_id")


def _purchases_views(t):
    p = t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    v = t.events.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"))
    return p, v


_ASOF_SQL = """
with p as (select event_id, user_id, ts from events where event_type = 'purchase'),
v as (select user_id, ts as view_ts, event_id as view_id from events where event_type = 'view')
select p.event_id, p.user_id, p.ts, {cols} from p asof left join v on p.user_id = v.user_id and p.ts {op} v.view_ts
"""


@query("asof_backward", section=S, sql=_ASOF_SQL.format(cols="v.view_ts, v.view_id", op=">="))
def asof_backward(t):
    """Last view of the same user at or before each purchase."""
    p, v = _purchases_views(t)
    return asof_join(p, v, "ts", "view_ts", by=["user_id"])


@query("asof_strict", section=S, sql=_ASOF_SQL.format(cols="v.view_ts, v.view_id", op=">"))
def asof_strict(t):
    """Last view strictly before each purchase (features must not see the
    event itself, H4)."""
    p, v = _purchases_views(t)
    return asof_join(p, v, "ts", "view_ts", by=["user_id"], strict=True)


@query("asof_forward", section=S, sql=_ASOF_SQL.replace("p.ts {op} v.view_ts", "v.view_ts >= p.ts")
       .format(cols="v.view_ts, v.view_id"))
def asof_forward(t):
    """First view at or after each purchase."""
    p, v = _purchases_views(t)
    return asof_join(p, v, "ts", "view_ts", by=["user_id"], direction="forward")


@query("asof_nearest", section=S, sql="""
with p as (select event_id, user_id, ts from events where event_type = 'purchase'),
v as (select user_id, ts as view_ts, max(event_id) as view_id from events where event_type = 'view' group by 1, 2),
b as (select p.*, v.view_ts, v.view_id from p asof left join v on p.user_id = v.user_id and p.ts >= v.view_ts),
f as (select p.event_id, v.view_ts, v.view_id from p asof left join v on p.user_id = v.user_id and v.view_ts >= p.ts),
j as (select b.event_id, b.user_id, b.ts, b.view_ts as b_ts, b.view_id as b_id, f.view_ts as f_ts, f.view_id as f_id,
             f.view_ts is null or (b.view_ts is not null and b.ts - b.view_ts <= f.view_ts - b.ts) as back
      from b join f on f.event_id = b.event_id)
select event_id, user_id, ts, case when back then b_ts else f_ts end as view_ts, case when back then b_id else f_id end as view_id from j
""")
def asof_nearest(t):
    """Nearest view in time (backward on equal distance)."""
    p, v = _purchases_views(t)
    return asof_join(p, v, "ts", "view_ts", by=["user_id"], direction="nearest")


@query("asof_nokey", section=S, sql="""
with c as (select cast(l_shipdate as date) as campaign_day, round(avg(l_discount), 6) as discount
           from lineitem group by 1),
c2 as (select cast(campaign_day as timestamp) as campaign_ts, discount from c)
select o.o_orderkey, o.o_orderdate, c2.campaign_ts, c2.discount
from orders o asof left join c2 on o.o_orderdate >= c2.campaign_ts
""")
def asof_nokey(t):
    """As-of on time only (currency / campaign table).  Without a key the
    rows are still spread by day bucket; each bucket carries the last
    campaign row of the days before it."""
    c = t.lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg(F.round(F.avg("l_discount"), 6).alias("discount")) \
        .select(F.col("d").cast("timestamp_ntz").alias("campaign_ts"), "discount")
    return asof_join(t.orders.select("o_orderkey", "o_orderdate"), c, "o_orderdate", "campaign_ts")


@query("safe_asof", section=S, sql="""
with p as (select event_id, user_id, ts from events where event_type = 'purchase'),
v as (select user_id, ts as view_ts, event_id as view_id from events where event_type = 'view'),
j as (select p.event_id, p.user_id, p.ts, v.view_ts, v.view_id
      from p asof left join v on p.user_id = v.user_id and p.ts >= v.view_ts)
select event_id, user_id, ts,
       case when ts - view_ts <= interval 2 day then view_ts end as view_ts,
       case when ts - view_ts <= interval 2 day then view_id end as view_id
from j
""")
def safe_asof_q(t):
    """The library wrapper with a tolerance (2 days here; default 7)."""
    p, v = _purchases_views(t)
    return safe_asof(p, v, "ts", "view_ts", by=["user_id"], tolerance="2 days")


@query("safe_join", section=S, sql="""
select o.o_orderkey, o.o_custkey, c.c_name from orders o left join customer c on c.c_custkey = o.o_custkey
""")
def safe_join(t):
    """Join with a right-key uniqueness check and row counts observed while it runs (``safe_merge``); see
    :func:`quarry.operators.joins.safe_join`.  safe_join_report has the counts beforehand."""
    out, _observed = J.safe_join(*_with_customer(t), on=["o_custkey"], how="left", check_right_unique=True)
    return out.select("o_orderkey", "o_custkey", "c_name")


def _with_customer(t):
    return t.orders.select("o_orderkey", "o_custkey"), t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")


@query("safe_join_report", section=S, sql="""
with c as (select c_custkey as k, count(*) as n from customer group by 1),
o as (select o_custkey as k, count(*) as n from orders group by 1),
l as (select l_orderkey as k, count(*) as n from lineitem group by 1),
ok as (select o_orderkey as k, count(*) as n from orders group by 1),
j as (
  select 'orders to customers' as checked, coalesce(o.n, 0) as nl, coalesce(c.n, 0) as nr from o full join c on c.k = o.k
  union all select 'orders to lines', coalesce(ok.n, 0), coalesce(l.n, 0) from ok full join l on l.k = ok.k)
select checked, sum(nl)::bigint as left_rows, sum(nr)::bigint as right_rows, count(*) filter (where nr > 0) as right_keys,
       count(*) filter (where nr > 1) as right_duplicate_keys, coalesce(sum(nl) filter (where nr > 0), 0)::bigint as matched_left_rows,
       sum(nl * greatest(nr, 1))::bigint as out_rows, max(nr) <= 1 as right_unique
from j group by checked
""")
def safe_join_report(t):
    """The reports of two joins before they run: one that keeps its rows, and one that multiplies them."""
    lines = J.join_report(t.orders.select("o_orderkey"), t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"], "left")
    return J.join_report(*_with_customer(t), ["o_custkey"], "left").select(F.lit("orders to customers").alias("checked"), "*").union(
        lines.select(F.lit("orders to lines").alias("checked"), "*"))


@query("apply_topk", section=S, sql="""
select c.c_custkey, x.o_orderkey, x.o_totalprice from customer c,
lateral (select o.o_orderkey, o.o_totalprice from orders o where o.o_custkey = c.c_custkey
         order by o.o_totalprice desc, o.o_orderkey limit 3) x
""")
def apply_topk(t):
    """CROSS APPLY (TOP 3 ...): rank + filter; the limit is applied per
    partition before the shuffle (WindowGroupLimit)."""
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    top = t.orders.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= 3)
    return top.join(t.customer, F.col("c_custkey") == F.col("o_custkey"), "left_semi") \
        .select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")


@query("concat_horizontal", section=S, sql="""
with a as (select o_custkey as custkey, count(*) as n_orders from orders group by 1),
b as (select o.o_custkey as custkey, count(*) as n_lines
      from lineitem l join orders o on o.o_orderkey = l.l_orderkey group by 1)
select a.custkey, a.n_orders, b.n_lines from a full join b on a.custkey = b.custkey
""")
def concat_horizontal(t):
    """pd.concat(axis=1): side-by-side on an explicit key (full join)."""
    a = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = (t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
         .groupBy(F.col("o_custkey").alias("custkey")).agg(F.count(F.lit(1)).alias("n_lines")))
    return a.join(b, "custkey", "full")


@query("concat_horizontal_position", section=S, sql="""
with a as (select s_suppkey, s_acctbal, row_number() over (order by s_acctbal desc, s_suppkey) - 1 as position from supplier),
b as (select p_partkey, p_retailprice, row_number() over (order by p_retailprice desc, p_partkey) - 1 as position from part)
select coalesce(a.position, b.position) as position, s_suppkey, s_acctbal, p_partkey, p_retailprice
from a full join b on a.position = b.position
""")
def concat_horizontal_position(t):
    """zip_longest / concat(axis=1) by position: two tables of different length, each in its own order, side by side."""
    from quarry.operators.windows import zip_rows
    return zip_rows(t.supplier.select("s_suppkey", "s_acctbal"), t.part.select("p_partkey", "p_retailprice"),
                    [("s_acctbal", False), ("s_suppkey", True)], [("p_retailprice", False), ("p_partkey", True)])
