"""Join helpers: checked joins, ordered merge, pair counting."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F


class JoinKeyNotUnique(ValueError):
    pass


def safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
              check_right_unique: bool = True):
    """Join that refuses a fan-out and reports row counts.

    The uniqueness check is one aggregate over the right keys (partial
    aggregation; only a yes/no reaches the driver).  Row counts of the left
    input and of the output are collected by ``Observation`` during the
    action that consumes the result, so they cost no extra pass.
    Returns (joined DataFrame, dict of Observations); :func:`join_report`
    gives the counts before the join runs.
    """
    on = list(on)
    if check_right_unique and not right.groupBy(*on).count().where("count > 1").isEmpty():
        raise JoinKeyNotUnique(f"right side has duplicate keys on {on}")
    lo, oo = Observation("left_rows"), Observation("out_rows")
    l2 = left.observe(lo, F.count(F.lit(1)).alias("rows"))
    out = l2.join(right, on, how).observe(oo, F.count(F.lit(1)).alias("rows"))
    return out, {"left": lo, "out": oo}


def join_report(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """One row about ``left`` join ``right``: left_rows, right_rows, right_keys, right_duplicate_keys, matched_left_rows,
    out_rows and right_unique, from the counts of each key (two partial aggregates and a join of them).

    A NULL key matches nothing.  ``how``: inner, left, right, full, left_semi or left_anti."""
    on = list(on)
    names = [f"__j{i}" for i in range(len(on))]
    l, r = (df.groupBy(*[F.col(c).alias(n) for c, n in zip(on, names)]).agg(F.count(F.lit(1)).alias(f"__n{s}"))
            for df, s in ((left, "l"), (right, "r")))
    j = l.join(r, names, "full")
    nl, nr = F.coalesce("__nl", F.lit(0)), F.coalesce("__nr", F.lit(0))
    one_l, one_r = F.greatest(nl, F.lit(1)), F.greatest(nr, F.lit(1))
    hit = (nl > 0) & (nr > 0)
    out = {"inner": nl * nr, "left": nl * one_r, "right": one_l * nr, "full": F.when(hit, nl * nr).otherwise(nl + nr),
           "left_semi": F.when(hit, nl).otherwise(0), "left_anti": F.when(hit, 0).otherwise(nl)}[how]
    return j.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in (
        ("left_rows", nl), ("right_rows", nr), ("right_keys", (nr > 0).cast("long")), ("right_duplicate_keys", (nr > 1).cast("long")),
        ("matched_left_rows", F.when(hit, nl).otherwise(0)), ("out_rows", out))],
        F.coalesce(F.max(nr) <= 1, F.lit(True)).alias("right_unique"))


def join_fanout(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Predict the size of ``left JOIN right`` before running it: the sum over
    keys of count_left * count_right (two partial aggregates and a join of
    per-key counts)."""
    on = list(on)
    lc = left.groupBy(*on).agg(F.count(F.lit(1)).alias("nl"))
    rc = right.groupBy(*on).agg(F.count(F.lit(1)).alias("nr"))
    return lc.join(rc, on).agg(F.sum(F.col("nl") * F.col("nr")).alias("joined_rows"),
                               F.max(F.col("nr")).alias("max_right_per_key"))


COPIES = 10_000       # rows of one value that a task writes at once


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """EXCEPT ALL: of every row as many copies as ``a`` has more than ``b`` (columns by position; NULLs are equal).

    Values stay counts until the end: both sides are counted in one partial aggregate, and the copies of a common value
    are written by many tasks, ``COPIES`` at a time."""
    cols = a.columns
    counted = (a.withColumn("__n", F.lit(1).cast("long")).union(b.withColumn("__n", F.lit(-1).cast("long")))
               .groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.sum("__n").alias("__n")).where("__n > 0"))
    dealt = counted.withColumn("__at", F.explode(F.expr(f"sequence(0L, (__n - 1) div {COPIES})"))) \
        .withColumn("__n", F.least(F.lit(COPIES), F.col("__n") - F.col("__at") * COPIES))
    # a stated number, since small rows that are about to grow would be put together again
    spread = dealt.repartition(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.select(*[F.col(f"`{c}`") for c in cols], F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))).alias("__i")).drop("__i")


def merge_ordered_ffill(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Full outer join on an ordered key of any size, then forward fill of ``cols`` along it, by ranges of the key.
    Meant for one row a key value on each side; a NULL key comes first."""
    from quarry.operators.windows import global_ffill
    return global_ffill(a.join(b, key, "full"), [(key, True)], cols).select(key, *cols)


def earlier_pair_counts(df: DataFrame, a: str, b: str, time_col: str, id_col: str) -> DataFrame:
    """For each row, the number of rows of the same unordered pair {a, b} at a
    strictly earlier time -- without forming the pairs."""
    p = df.select(id_col, time_col, F.least(a, b).alias("__lo"), F.greatest(a, b).alias("__hi"))
    per_day = p.groupBy("__lo", "__hi", time_col).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__lo", "__hi").orderBy(time_col).rowsBetween(Window.unboundedPreceding, -1)
    cum = per_day.withColumn("n_past_meetings", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    return p.join(cum, ["__lo", "__hi", time_col]).select(id_col, "n_past_meetings")
