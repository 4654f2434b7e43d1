"""Derived views of the sports and retail schemas over the base tables.

Each view has a DataFrame builder (used by the Spark queries) and the same
definition as SQL text (used inside the oracle SQL as a CTE, because only the
base tables are registered on the oracle side).
"""
from __future__ import annotations

from pyspark.sql import functions as F


def _matches(t):
    o = t.orders
    return o.select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_orderpriority").alias("league"),
        F.year("o_orderdate").alias("season"),
        F.col("o_orderdate").alias("match_date"),
        (F.col("o_custkey") % 25).alias("home_team_id"),
        ((F.col("o_custkey") + 1 + F.col("o_orderkey") % 24) % 25).alias("away_team_id"),
        (F.col("o_orderkey") % 5).alias("home_score"),
        (F.floor("o_totalprice").cast("bigint") % 5).alias("away_score"),
    )


def _teams(t):
    return t.nation.select(F.col("n_nationkey").alias("team_id"),
                           F.col("n_name").alias("team_name"))


def _odds(t):
    l = t.lineitem
    return l.select(
        F.col("l_orderkey").alias("match_id"),
        F.concat(F.lit("BK"), (F.col("l_suppkey") % 3).cast("string")).alias("bookmaker"),
        F.col("l_shipdate").alias("collected_at"),
        (F.lit(1.4) + F.col("l_quantity") / 30.0).alias("home_win"),
        (F.lit(2.5) + F.col("l_discount") * 20.0).alias("draw"),
        (F.lit(1.6) + F.col("l_tax") * 25.0).alias("away_win"),
        F.col("l_partkey").alias("odds_id"),
    )


def _playerstats(t):
    l = t.lineitem
    return l.select(
        F.col("l_orderkey").alias("match_id"),
        (F.col("l_suppkey") % 25).alias("team_id"),
        F.col("l_partkey").alias("player_id"),
        (F.col("l_extendedprice") / 1e5).alias("xg"),
    )


def _injuries(t):
    e = t.events
    return e.select(
        (F.col("user_id") % 25).alias("team_id"),
        F.col("user_id").alias("player_id"),
        F.when(F.col("event_type") == "error", "OUT").otherwise("OK").alias("status"),
        (F.col("ts") - F.expr("INTERVAL 25 YEARS")).alias("reported_at"),
    )


def _squad(t):
    return t.events.select((F.col("user_id") % 25).alias("team_id"),
                           F.col("user_id").alias("player_id")).distinct()


def _teamelo(t):
    l = t.lineitem
    return l.select(
        (F.col("l_suppkey") % 25).alias("team_id"),
        F.col("l_shipdate").alias("as_of_date"),
        (F.lit(1500.0) + F.col("l_extendedprice") / 1000.0).alias("elo"),
    )


def _payments(t):
    l = t.lineitem
    return l.where(F.col("l_linestatus") == "F").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").alias("paid_at"),
        F.col("l_returnflag").alias("method"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
    )


BUILDERS = {
    "matches": _matches, "teams": _teams, "odds": _odds, "playerstats": _playerstats,
    "injuries": _injuries, "squad": _squad, "teamelo": _teamelo, "payments": _payments,
}

# Fixed view definitions on the oracle side (same rows as the builders above).
VIEW_SQL = {
    "teams": "select n_nationkey as team_id, n_name as team_name from nation",
    "matches": (
        "select o_orderkey as match_id, o_orderpriority as league, "
        "cast(year(o_orderdate) as integer) as season, o_orderdate as match_date, "
        "o_custkey % 25 as home_team_id, (o_custkey + 1 + o_orderkey % 24) % 25 as away_team_id, "
        "o_orderkey % 5 as home_score, cast(floor(o_totalprice) as bigint) % 5 as away_score from orders"),
    "odds": (
        "select l_orderkey as match_id, concat('BK', cast(l_suppkey % 3 as varchar)) as bookmaker, "
        "l_shipdate as collected_at, 1.4e0 + l_quantity / 30e0 as home_win, "
        "2.5e0 + l_discount * 20e0 as draw, 1.6e0 + l_tax * 25e0 as away_win, "
        "l_partkey as odds_id from lineitem"),
    "playerstats": (
        "select l_orderkey as match_id, l_suppkey % 25 as team_id, l_partkey as player_id, "
        "l_extendedprice / 1e5 as xg from lineitem"),
    "injuries": (
        "select user_id % 25 as team_id, user_id as player_id, "
        "case when event_type = 'error' then 'OUT' else 'OK' end as status, "
        "ts - interval '25' year as reported_at from events"),
    "squad": "select distinct user_id % 25 as team_id, user_id as player_id from events",
    "teamelo": (
        "select l_suppkey % 25 as team_id, l_shipdate as as_of_date, "
        "1500e0 + l_extendedprice / 1000e0 as elo from lineitem"),
    "payments": (
        "select l_orderkey as order_id, l_shipdate as paid_at, l_returnflag as method, "
        "l_extendedprice * (1 - l_discount) as amount from lineitem where l_linestatus = 'F'"),
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named derived views."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} as ({VIEW_SQL[n]})" for n in names)
    body = sql.strip()
    if body[:4].lower() == "with":
        return f"with {ctes},\n{body[4:].lstrip()}"
    return f"with {ctes}\n{body}"
