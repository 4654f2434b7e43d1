"""Window operators that stay distributed.

* ``trailing``: a bounded ROWS frame (e.g. the 5 previous rows) per key,
  computed per (key, time bucket) with halo rows from earlier buckets, so a
  hot key is not one task; a bucket with too many rows is cut further at
  equal-depth places of its order.
* ``running_sum``: cumulative sum per key with a carry for each such bucket.
* ``global_ranks``: ORDER BY-only windows without the single-partition
  exchange a plain ``Window.orderBy`` plans.  Rows are cut into ranges of the
  whole sort key, whose number follows the data, numbered inside each range,
  and shifted by the counts of earlier ranges.
* ``global_ffill``: forward fill along an order, the same way.
"""
from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ranges import ROWS_A_RANGE, SPLIT, HotCuts, Ranges, same

BucketFn = Callable[[Column], Column]


def month_bucket(t: Column) -> Column:
    return F.date_trunc("month", t)


def _bucketed(df: DataFrame, by: Sequence[str], order: Sequence[str], time_col: str, bucket: BucketFn, limit: int | None) -> DataFrame:
    """``df`` with ``__b``: the calendar bucket, cut further where one (key, bucket) holds more than ``limit`` rows."""
    base = df.withColumn("__b", bucket(F.col(time_col)))
    return HotCuts([base], by, order, limit).assign(base)


def trailing(df: DataFrame, by: Sequence[str], order: Sequence[str], time_col: str,
             lo: int, hi: int, aggs: dict[str, tuple[Callable[[Column], Column], str]],
             bucket: BucketFn = month_bucket, limit: int | None = None) -> DataFrame:
    """Add ``fn(col)`` over ``ROWS BETWEEN lo AND hi`` for each
    ``name -> (fn, col)`` in ``aggs`` (lo <= hi <= 0).

    ``order`` must be a total order within ``by`` (append a unique key) and
    start with ``time_col``.  The result equals the plain window.  Rows are
    partitioned by (by, bucket(time_col)); each bucket receives the last
    ``-lo`` rows of the buckets before it as halo rows, taken from a bounded
    tail per bucket (at most ``-lo`` rows each), so no group is collected
    whole and a hot key is spread over its buckets.  ``limit``: rows above which
    a bucket is cut (see :class:`~quarry.operators.ranges.HotCuts`).
    """
    n = -lo
    values = list(dict.fromkeys(v for _, v in aggs.values()))
    if n == 0:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(lo, hi)
        return df.select("*", *[f(F.col(v)).over(w).alias(name) for name, (f, v) in aggs.items()])
    base = _bucketed(df, by, order, time_col, bucket, limit)
    carry_cols = [c for c in dict.fromkeys(list(order) + values) if c not in by]
    # tail: the last n rows of each (key, bucket); the limit runs before the shuffle
    wtail = Window.partitionBy(*by, "__b").orderBy(*[F.col(c).desc() for c in order])
    tails = (base.select(*by, "__b", *carry_cols)
             .withColumn("__rn", F.row_number().over(wtail)).where(F.col("__rn") <= n)
             .groupBy(*by, "__b")
             .agg(F.collect_list(F.struct(*carry_cols)).alias("__tail")))
    # halo of a bucket: the n last rows among the n previous non-empty buckets
    whalo = Window.partitionBy(*by).orderBy("__b").rowsBetween(-n, -1)
    halo = (tails.withColumn("__h", F.flatten(F.collect_list("__tail").over(whalo)))
            .select(*by, "__b", F.explode(F.slice(F.reverse(F.array_sort("__h")), 1, n)).alias("__r"))
            .select(*by, "__b", "__r.*", F.lit(0).alias("__phase")))
    rows = base.withColumn("__phase", F.lit(1)).unionByName(halo, allowMissingColumns=True)
    w = (Window.partitionBy(*by, "__b").orderBy(F.col("__phase"), *[F.col(c) for c in order])
         .rowsBetween(lo, hi))
    out = rows.select("*", *[f(F.col(v)).over(w).alias(name) for name, (f, v) in aggs.items()])
    return out.where(F.col("__phase") == 1).drop("__phase", "__b")


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[str], time_col: str,
                value: str, alias: str, bucket: BucketFn = month_bucket, limit: int | None = None) -> DataFrame:
    """Cumulative sum per key: per-bucket running sum plus the totals of all
    earlier buckets (a window over the one-row-per-bucket summary).  ``order``
    is a total order that starts with ``time_col``."""
    base = _bucketed(df, by, order, time_col, bucket, limit)
    tot = base.groupBy(*by, "__b").agg(F.sum(value).alias("__bt"))
    wc = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    keys = [*by, "__b"]
    carry = tot.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.sum("__bt").over(wc).alias("__carry"))
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = F.sum(value).over(w)
    # NULL only while nothing was summed, as with the plain window
    return (base.join(carry, same(keys, [f"__k{i}" for i in range(len(keys))])).withColumn(alias, F.coalesce(F.col("__carry") + own, F.col("__carry"), own))
            .drop("__carry", "__b", *[f"__k{i}" for i in range(len(keys))]))


# --------------------------------------------------------------------------
# ORDER BY-only windows

def _order(order: Sequence[tuple[str, bool]]):
    return [F.col(c).asc_nulls_first() if a else F.col(c).desc_nulls_last() for c, a in order]


def global_ranks(df: DataFrame, order: Sequence[tuple[str, bool]], outputs: dict[str, str],
                 buckets: int | None = None, ntiles: int | None = None, rows: int = ROWS_A_RANGE) -> DataFrame:
    """Several ORDER BY-only rankings in one pass over the data.

    ``outputs`` maps an output column to a kind: row_number | rank |
    dense_rank | percent_rank | ntile.  ``order`` is a list of (column,
    ascending).  Results equal ``F.<kind>().over(Window.orderBy(...))`` with
    Spark's NULL order (first on ascending, last on descending); rows that tie
    in the whole order are numbered in any order.  A task sorts about ``rows``
    rows (or the table is cut into ``buckets`` ranges, if given); those of a sort key that fills several ranges are spread, so neither
    a common leading value nor a common whole key is one task's work.
    """
    ranges = Ranges(df, order, rows, many=buckets)
    b = df.withColumn("__gr_bk", ranges.number(df))
    counts = b.groupBy("__gr_bk").agg(F.count(F.lit(1)).alias("__gr_cnt"))
    wloc = Window.partitionBy("__gr_bk").orderBy(*_order(order))
    kinds = set(outputs.values())
    if kinds & {"row_number", "ntile"}:
        b = b.withColumn("__gr_rn", F.row_number().over(wloc))
    if kinds & {"rank", "percent_rank"}:
        b = b.withColumn("__gr_rk", F.rank().over(wloc))
    if "dense_rank" in kinds:
        b = b.withColumn("__gr_dr", F.dense_rank().over(wloc))
        counts = b.groupBy("__gr_bk").agg(F.count(F.lit(1)).alias("__gr_cnt"), F.max("__gr_dr").alias("__gr_dcnt"))
    # one row a part of a range, at most 3 x MOST: what stands before it becomes its offset.  The parts of one key
    # share the rank offset of their first and count as one distinct key
    before = Window.orderBy("__gr_bk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("__gr_bk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.floor(F.col("__gr_bk") / SPLIT)
    offs = counts.select("*", own.alias("__gr_rng"), F.coalesce(F.sum("__gr_cnt").over(before), F.lit(0)).alias("__gr_off"),
                         F.sum("__gr_cnt").over(whole).alias("__gr_total"),
                         (F.lag(own, 1, -1).over(Window.orderBy("__gr_bk")) != own).alias("__gr_first"))
    in_range = Window.partitionBy("__gr_rng")
    more = []
    if "dense_rank" in kinds:
        offs = offs.withColumn("__gr_dbefore", F.coalesce(F.sum(F.when(F.col("__gr_first"), F.col("__gr_dcnt"))).over(before), F.lit(0)))
        more.append(F.min("__gr_dbefore").over(in_range).alias("__gr_doff"))
    offs = offs.select("__gr_bk", "__gr_off", "__gr_total", F.min("__gr_off").over(in_range).alias("__gr_roff"), *more)
    b = b.join(F.broadcast(offs), "__gr_bk")
    n = F.col("__gr_total")
    for alias, kind in outputs.items():
        if kind == "row_number":
            val = F.col("__gr_off") + F.col("__gr_rn")
        elif kind == "rank":
            val = F.col("__gr_roff") + F.col("__gr_rk")
        elif kind == "dense_rank":
            val = F.col("__gr_doff") + F.col("__gr_dr")
        elif kind == "percent_rank":
            r = F.col("__gr_roff") + F.col("__gr_rk")
            val = F.when(n <= 1, F.lit(0.0)).otherwise((r - 1) / (n - 1))
        elif kind == "ntile":
            r = F.col("__gr_off") + F.col("__gr_rn")
            k = F.lit(ntiles)
            q = F.floor(n / k)
            rem = n % k
            big = rem * (q + 1)
            val = F.when(q == 0, r).when(r <= big, F.floor((r - 1) / (q + 1)) + 1) \
                .otherwise(rem + F.floor((r - 1 - big) / q) + 1).cast("int")
        else:
            raise ValueError(f"unknown ranking {kind}")
        b = b.withColumn(alias, val)
    return b.drop(*[c for c in b.columns if c.startswith("__gr_")])


def global_rank(df: DataFrame, order: Sequence[tuple[str, bool]], kind: str = "row_number",
                alias: str = "rn", buckets: int | None = None, ntiles: int | None = None) -> DataFrame:
    return global_ranks(df, order, {alias: kind}, buckets, ntiles)


def global_row_number(df: DataFrame, order: Sequence[tuple[str, bool]], alias: str = "rn",
                      buckets: int | None = None) -> DataFrame:
    return global_rank(df, order, "row_number", alias, buckets)


def global_ffill(df: DataFrame, order: Sequence[tuple[str, bool]], cols: Sequence[str], rows: int = ROWS_A_RANGE) -> DataFrame:
    """``cols`` with each NULL replaced by the last value before it along ``order`` (NULL where there is none).

    Inside a range of the order a window fills; what a range starts with is the last value of the ranges before it, from
    one row a range.  ``order`` should be total: among rows of equal order any may count as the last."""
    ranges = Ranges(df, order, rows, split=False)
    b = df.withColumn("__gr_bk", ranges.number(df))
    local = Window.partitionBy("__gr_bk").orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("__gr_bk").rowsBetween(Window.unboundedPreceding, -1)
    filled = b.select("*", *[F.last(c, ignorenulls=True).over(local).alias(f"__gr_v{i}") for i, c in enumerate(cols)])
    end = Window.partitionBy("__gr_bk").orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = (b.select("__gr_bk", *[F.last(c, ignorenulls=True).over(end).alias(f"__gr_e{i}") for i, c in enumerate(cols)])
            .groupBy("__gr_bk").agg(*[F.first(f"__gr_e{i}").alias(f"__gr_e{i}") for i in range(len(cols))]))
    carry = ends.select("__gr_bk", *[F.last(f"__gr_e{i}", ignorenulls=True).over(before).alias(f"__gr_c{i}") for i in range(len(cols))])
    j = filled.join(F.broadcast(carry), "__gr_bk")
    out = {c: F.coalesce(F.col(f"__gr_v{i}"), F.col(f"__gr_c{i}")) for i, c in enumerate(cols)}
    return j.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in df.columns])


def zip_rows(left: DataFrame, right: DataFrame, left_order: Sequence[tuple[str, bool]], right_order: Sequence[tuple[str, bool]],
             position: str = "position") -> DataFrame:
    """Both tables side by side by position along their orders, counted from 0; the shorter one is padded with NULLs.

    Each side is numbered by ranges and joined on the number, so no side is gathered in one task.  Columns that both
    sides have get the suffix ``_right`` on the right."""
    a = global_row_number(left, left_order, "__zip_l")
    b = global_row_number(right, right_order, "__zip_r")
    taken = {c.lower() for c in left.columns} | {position.lower()}
    new = [F.col(f"`{c}`").alias(f"{c}_right" if c.lower() in taken else c) for c in right.columns]
    b = b.select("__zip_r", *new)
    j = a.join(b, F.col("__zip_l") == F.col("__zip_r"), "full")
    return j.select((F.coalesce("__zip_l", "__zip_r") - 1).alias(position), *[F.col(f"`{c}`") for c in left.columns],
                    *[F.col(f"`{c}`") for c in b.columns[1:]])
