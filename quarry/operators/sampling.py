"""Bounded samples and grid counts for plots."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_hash(*cols: str | Column) -> Column:
    """MD5 of the columns' texts, joined by ``-`` (a NULL is an empty text)."""
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("-", *texts).cast("binary"))


def bottom_k(df: DataFrame, k: int, key: Sequence[str], panel: Sequence[str] = ()) -> DataFrame:
    """At most ``k`` rows a panel: those with the smallest hashes of the row key ``key``, which should be unique.

    A uniform sample that does not depend on partitions, and a mergeable one: the sample of two tables together is
    that of their samples.  Each task keeps k rows a panel before the shuffle (``row_number() <= k`` is limited per
    partition), so a hot panel arrives as k rows a task."""
    order = Window.partitionBy(*[F.col(c) for c in panel]).orderBy("__h", *key)
    hashed = df.withColumn("__h", key_hash(*key))
    if not panel:
        return hashed.orderBy("__h", *key).limit(k).drop("__h")
    return hashed.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= k).drop("__h", "__n")


def pair_grids(df: DataFrame, cols: Sequence[str], bins: int) -> DataFrame:
    """Point counts of every pair of columns on a ``bins`` x ``bins`` grid over their ranges: (col_x, col_y, bin_x, bin_y,
    n), pairs in the order of ``cols``, empty cells left out.  Rows with a NULL in one of a pair are no points.

    One aggregate for the ranges, then one expand (a row becomes its pairs' cells) and one aggregate that is combined
    map-side: at most pairs x bins² rows a task are shuffled, whatever the table."""
    ends = df.agg(F.struct(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(f"c{i}")
                             for i, c in enumerate(cols)])).scalar()
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]).withColumn("ends", ends)

    def cell(i: int) -> Column:
        x, lo, hi = F.col(f"x{i}"), F.col(f"ends.c{i}.lo"), F.col(f"ends.c{i}.hi")
        # the upper end belongs to the last bin; a column of one value is all in bin 0
        return F.when(x.isNotNull(), F.least(F.coalesce(F.floor(F.try_divide((x - lo) * bins, hi - lo)), F.lit(0)), F.lit(bins - 1)).cast("int"))
    binned = rows.select(*[cell(i).alias(f"b{i}") for i in range(len(cols))])
    pairs = F.array(*[F.struct(F.lit(a).alias("col_x"), F.lit(b).alias("col_y"), F.col(f"b{i}").alias("bin_x"), F.col(f"b{j}").alias("bin_y"))
                      for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j])
    return (binned.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("bin_x").isNotNull() & F.col("bin_y").isNotNull())
            .groupBy("col_x", "col_y", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("n")))
