"""As-of join: for each left row, the last right row at (or strictly before)
the left time, optionally per key and within a tolerance.

Spark has no as-of join operator (``_joinAsOf`` plans a nested-loop join),
so it is formulated with built-in operators only:

* rows of both sides are cut into (key, time bucket) groups, so that a hot
  key is spread over many tasks instead of one; a bucket with too many rows
  is cut further at equal-depth times;
* the last right row of every earlier bucket (first of every later bucket
  for forward matches) is carried into a bucket by a window over the small
  (key, bucket) summary, which has one row per bucket;
* inside a bucket, left and right rows are unioned and ``last(right,
  ignorenulls)`` over a running frame picks the match.  Whether a right row
  at exactly the left time counts is decided by the order of the ``side``
  column (strict: left sorts first).

Every left row comes out exactly once; no pairs are formed.  Where buckets are
hot, the distinct (key, time) of the left side are matched and joined back,
so many left rows of one instant are not one task's work either.
"""
from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import ranges
from quarry.operators.ranges import HotCuts, leaf_bytes, same, wanted

FILE_BYTES_A_TASK, MOST_TASKS = 1 << 20, 8192   # of input files; sorted rows may take a hundred times their files
BucketFn = Callable[[Column], Column]


def day_bucket(t: Column) -> Column:
    return F.date_trunc("day", t)


def month_bucket(t: Column) -> Column:
    return F.date_trunc("month", t)


def _carry(L, R, knames, backward):
    """Per left bucket: the nearest right row from an earlier (later) bucket."""
    pick = F.max if backward else F.min
    rlast = R.groupBy(*knames, "__b").agg(pick(F.struct("__t", "__R")).alias("__last"))
    lb = (L.select(*knames, "__b").distinct()
          .withColumn("__last", F.lit(None).cast(rlast.schema["__last"].dataType)))
    summary = lb.withColumn("__src", F.lit(0)).unionByName(rlast.withColumn("__src", F.lit(1)))
    border = F.col("__b").asc() if backward else F.col("__b").desc()
    w = (Window.partitionBy(*knames).orderBy(border, F.col("__src").asc())
         .rowsBetween(Window.unboundedPreceding, -1))
    return (summary.withColumn("__c", F.last("__last", ignorenulls=True).over(w))
            .where((F.col("__src") == 0) & F.col("__c").isNotNull())
            .select(*knames, "__b", F.col("__c.__t").alias("__t"), F.col("__c.__R").alias("__R"),
                    F.lit(0 if backward else 2).alias("__phase"), F.lit(0).alias("__side")))


def _sides(left, right, left_on, right_on, by, bucket):
    """(key, time, bucket) of all rows of both sides."""
    def side(df, on):
        return df.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(by)], F.col(on).alias("__t"), bucket(F.col(on)).alias("__b"))
    return [side(left, left_on), side(right, right_on)]


def _asof_core(left, right, left_on, right_on, by, strict, bucket, back, fwd, cuts):
    keys = list(by)
    knames = [f"__k{i}" for i in range(len(keys))]
    kcols = [F.col(k).alias(n) for k, n in zip(keys, knames)]
    rpay = [c for c in right.columns if c not in keys]
    L = (left.select(*kcols, F.col(left_on).alias("__t"), F.struct(*left.columns).alias("__L"))
         .withColumn("__b", bucket(F.col("__t"))))
    L = cuts.assign(L) if cuts else L
    # one right row per (key, time): ties resolve to the largest payload in
    # both directions, so collapsing them first is exact and shrinks hot keys
    # map-side (partial aggregation) before any sort.
    R = (right.dropna("any", subset=[right_on, *keys])         # NULL keys and times match nothing
         .select(*kcols, F.col(right_on).alias("__t"), F.struct(*rpay).alias("__R"))
         .groupBy(*knames, "__t").agg(F.max("__R").alias("__R"))
         .withColumn("__b", bucket(F.col("__t"))))
    R = cuts.assign(R) if cuts else R
    parts = [L.withColumn("__phase", F.lit(1)).withColumn("__side", F.lit(1)),
             R.withColumn("__phase", F.lit(1)).withColumn("__side", F.lit(0))]
    if back:
        parts.append(_carry(L, R, knames, True))
    if fwd:
        parts.append(_carry(L, R, knames, False))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    size = leaf_bytes(left, right)
    if size > ranges.SMALL_FILES:   # tasks follow the data: merged by compressed size, they would sort gigabytes each
        tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, size // FILE_BYTES_A_TASK))
        rows = rows.repartition(tasks, *knames, "__b")
    is_right = F.col("__side") == 0
    # right rows are unique per (key, time) after the pre-aggregation, so
    # (phase, time, side) is a total order for the rows that matter.
    # tie order on equal time: inclusive -> right before left when looking back
    # (after when looking forward); strict -> the opposite.
    out = rows
    if back:
        tie = is_right.desc() if not strict else is_right.asc()
        w = (Window.partitionBy(*knames, "__b")
             .orderBy(F.col("__phase"), F.col("__t"), tie)
             .rowsBetween(Window.unboundedPreceding, 0))
        out = out.withColumn("__B", F.when(F.col("__t").isNotNull(), F.last("__R", ignorenulls=True).over(w)))
    if fwd:
        tie = is_right.asc() if not strict else is_right.desc()
        w = (Window.partitionBy(*knames, "__b")
             .orderBy(F.col("__phase"), F.col("__t"), tie)
             .rowsBetween(0, Window.unboundedFollowing))
        out = out.withColumn("__F", F.when(F.col("__t").isNotNull(), F.first("__R", ignorenulls=True).over(w)))
    return out.where(F.col("__L").isNotNull())


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
              by: Sequence[str] = (), strict: bool = False, tolerance: str | None = None,
              direction: str = "backward", bucket: BucketFn = day_bucket, limit: int | None = None) -> DataFrame:
    """Left as-of join.

    ``direction``: ``backward`` (last right time <= left time, or < when
    ``strict``), ``forward`` (first right time >= / >), or ``nearest``
    (smaller distance, backward on ties).  ``tolerance`` is an interval
    string such as ``'7 days'``; farther matches give NULLs.  Output: all left
    columns, then the right columns except the ``by`` keys.  ``limit``: rows
    above which a (key, bucket) is cut (see
    :class:`~quarry.operators.ranges.HotCuts`).
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"unknown direction {direction}")
    rpay = [c for c in right.columns if c not in by]
    by = list(by)
    cuts = None
    if wanted([left, right], limit):
        cuts = HotCuts(_sides(left, right, left_on, right_on, by, bucket), [f"__k{i}" for i in range(len(by))], ["__t"], limit)
    if not cuts:
        return _asof(left, right, left_on, right_on, by, strict, tolerance, direction, bucket, cuts)
    instants = [*by, left_on]
    at = [f"__a{i}" for i in range(len(instants))]
    found = _asof(left.select(*instants).distinct(), right, left_on, right_on, by, strict, tolerance, direction, bucket, cuts)
    found = found.select(*[F.col(c).alias(a) for c, a in zip(instants, at)], F.struct(*rpay).alias("__match"))
    return left.join(found, same(instants, at), "left").select(*[left[c] for c in left.columns], *[F.col(f"__match.{c}").alias(c) for c in rpay])


def _asof(left, right, left_on, right_on, by, strict, tolerance, direction, bucket, cuts):
    rpay = [c for c in right.columns if c not in by]
    back = direction in ("backward", "nearest")
    fwd = direction in ("forward", "nearest")
    if back and fwd:        # the later match is sought for the rows that carry their earlier match
        core = _asof_core(left, right, left_on, right_on, by, strict, bucket, True, False, cuts)
        rows = core.select("__L.*", F.col("__B").alias("__prev"))
        core = (_asof_core(rows, right, left_on, right_on, by, strict, bucket, False, True, cuts)
                .withColumn("__B", F.col("__L.__prev")).withColumn("__L", F.col("__L").dropFields("__prev")))
    else:
        core = _asof_core(left, right, left_on, right_on, by, strict, bucket, back, fwd, cuts)
    lt = F.col("__t")
    B, Fw = (F.col(c) if want else F.lit(None) for c, want in (("__B", back), ("__F", fwd)))
    if direction == "backward":
        m, use_back = B, F.lit(True)
    elif direction == "forward":
        m, use_back = Fw, F.lit(False)
    else:
        secs = lambda c: F.unix_micros(c.cast("timestamp"))
        db = secs(lt) - secs(B.getField(right_on))
        dfw = secs(Fw.getField(right_on)) - secs(lt)
        use_back = Fw.isNull() | (B.isNotNull() & (db <= dfw))
        m = F.when(use_back, B).otherwise(Fw)
    if tolerance:
        iv = F.expr(f"INTERVAL {tolerance}")
        rt = m.getField(right_on)
        far = F.when(use_back, lt - rt > iv).otherwise(rt - lt > iv)
        m = F.when(far, F.lit(None)).otherwise(m)
    return core.select("__L.*", *[m.getField(c).alias(c) for c in rpay])


def safe_asof(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
              by: Sequence[str] = (), tolerance: str | None = "7 days",
              direction: str = "backward", strict: bool = False) -> DataFrame:
    """As-of join with a default tolerance of 7 days (the library wrapper)."""
    return asof_join(left, right, left_on, right_on, by=by, strict=strict,
                     tolerance=tolerance, direction=direction)
