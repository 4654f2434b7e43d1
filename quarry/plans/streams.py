"""SURVEY 2.14 (extension): streaming versions of the time-based queries.

Each key runs a real Structured Streaming query over the table's parquet
file (availableNow trigger, sink in the shared checkpoint folder) and returns
the sink's content, so the batch oracle checks stream = batch.  The windowed
keys run in update mode: every window is returned in its last version, marked
closed once the watermark has passed it."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry import sources as src
from quarry import streaming as st
from quarry.catalog import query

S = "2.14"


def _events_stream(t):
    return st.event_stream(t.spark, t.sf_dir, t.events.schema, glob="events.parquet")


@query("stream_tumbling_daily", section=S, sql="""
with m as (select max(ts) as mx from events)
select date_trunc('day', ts) as day_start, event_type, count(*) as n, round(sum(value), 6) as total,
       date_trunc('day', ts) + interval 1 day <= mx - interval 1 day as closed
from events, m group by date_trunc('day', ts), event_type, mx
""")
def stream_tumbling_daily(t):
    out = src.scratch_dir(t.spark, "stream_daily")
    days = st.tumbling_daily(_events_stream(t))
    st.run_available(days, out, mode="update")
    r = st.last_versions(t.spark, out, days.schema, ["day_start", "event_type"], "day_end")
    return r.select(F.col("day_start").cast("timestamp_ntz").alias("day_start"), "event_type", "n",
                    F.round("total", 6).alias("total"), "closed")


@query("stream_sliding_avg", section=S, sql="""
with m as (select max(ts) as mx from events),
x as (select date_trunc('day', ts) - to_days(k) as window_start, value
      from events, range(0, 7) r(k))
select window_start, window_start + interval 7 day as window_end, round(avg(value), 6) as avg_value, count(*) as n,
       window_start + interval 7 day <= mx - interval 1 day as closed
from x, m group by window_start, mx
""")
def stream_sliding_avg(t):
    out = src.scratch_dir(t.spark, "stream_sliding")
    weeks = st.sliding_avg(_events_stream(t))
    st.run_available(weeks, out, mode="update")
    r = st.last_versions(t.spark, out, weeks.schema, ["window_start"], "window_end")
    return r.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                    F.round("avg_value", 6).alias("avg_value"), "n", "closed")


@query("stream_dedup", section=S, sql="select distinct user_id, event_type from events")
def stream_dedup(t):
    """One row a (user, type), kept as state over all batches."""
    out = src.scratch_dir(t.spark, "stream_dedup")
    st.run_available(st.dedup(_events_stream(t), ["user_id", "event_type"]), out)
    return t.spark.read.parquet(out).select("user_id", "event_type")


def _odds_stream(t):
    s = st.event_stream(t.spark, t.sf_dir, t.lineitem.schema, glob="lineitem.parquet", time_col="l_shipdate")
    return s.select(F.col("l_orderkey").alias("match_id"),
                    F.concat(F.lit("BK"), (F.col("l_suppkey") % 3).cast("string")).alias("bookmaker"),
                    F.col("l_shipdate").alias("collected_at"), F.col("l_partkey").alias("odds_id"),
                    (F.lit(1.4) + F.col("l_quantity") / 30.0).alias("home_win"))


@query("stream_latest_snapshot", views=("odds",), section=S, sql="""
select match_id, bookmaker, collected_at, odds_id, home_win from (
  select *, row_number() over (partition by match_id, bookmaker
                               order by collected_at desc, odds_id desc, home_win desc) as rn from odds) where rn = 1
""")
def stream_latest_snapshot(t):
    """Latest odds per (match, bookmaker) as a stateful streaming aggregate
    (update mode); the batches' updates are merged with the same max(struct)."""
    out = src.scratch_dir(t.spark, "stream_latest")
    st.run_available(st.latest_snapshot(_odds_stream(t), ["match_id", "bookmaker"], "collected_at",
                                        ["odds_id", "home_win"]), out, mode="update")
    r = t.spark.read.parquet(out)
    g = r.groupBy("match_id", "bookmaker").agg(F.max(F.struct("collected_at", "odds_id", "home_win")).alias("s"))
    return g.select("match_id", "bookmaker", F.col("s.collected_at").cast("timestamp_ntz").alias("collected_at"),
                    "s.odds_id", "s.home_win")


@query("stream_late_quarantine", views=("matches", "odds"), section=S, sql="""
select o.match_id, o.odds_id, o.collected_at from odds o join matches m on m.match_id = o.match_id
where o.collected_at >= m.match_date
""")
def stream_late_quarantine(t):
    """Stream-static join of arriving odds with matches; rows collected at or
    after kick-off go to the quarantine sink (read back here)."""
    _clean, leaky = st.late_quarantine(_odds_stream(t), t.matches, "match_id", "collected_at", "match_date")
    out = src.scratch_dir(t.spark, "stream_quarantine")
    st.run_available(leaky.select("match_id", "odds_id", "collected_at"), out)
    r = t.spark.read.parquet(out)
    return r.select("match_id", "odds_id", F.col("collected_at").cast("timestamp_ntz").alias("collected_at"))
