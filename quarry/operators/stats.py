"""Distributed statistics helpers (exact quantiles, Welch t)."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ranges import SMALL_FILES, bisect, kept, leaf_bytes, same

CUTS = 1000             # value ranges a group is cut into: a task of the last step holds about 1/1000 of a group
FEW_GROUPS = 1_000      # groups up to which their cuts (8 kB each) are broadcast


def quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), small: int = SMALL_FILES) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy's default, SQL
    ``percentile_cont``), one row (per group) with one column per name in ``probs``.

    Input files of at most ``small`` bytes: equal values become one row with a count, and a task sorts the distinct
    values of a group, whose number the files bound.  Beyond that no task holds a group: see
    :func:`ranged_quantiles`.  NULL values do not count; a NULL group is a group, and a group (or table) without
    values has NULL quantiles.
    """
    if leaf_bytes(df) > small:
        return ranged_quantiles(df, value, probs, by)
    keys, v = _values(df, value, by)
    # values without a number count 0, so their group stays
    counted = v.groupBy(*keys, "__v").agg(F.count("__v").alias("__c"))
    group = Window.partitionBy(*keys)
    placed = counted.select("*", F.sum("__c").over(group).alias("__n"),
                            F.sum("__c").over(group.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)).alias("__end"))
    found = _picked(probs) + [F.max("__n").alias("__n")]
    rows = placed.groupBy(*keys).agg(*found) if by else placed.agg(*found)
    return rows.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], *_between(probs))


def _values(df: DataFrame, value: str, by: Sequence[str]) -> tuple[list[str], DataFrame]:
    keys = [f"__k{i}" for i in range(len(by))] or ["__all"]
    return keys, df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], *([] if by else [F.lit(0).alias("__all")]), F.col(value).alias("__v"))


def _picked(probs: dict[str, float]) -> list[Column]:
    """Of counted values (__v, __c copies that end at rank __end of __n) the two neighbours of each position."""
    found = []
    for i, p in enumerate(probs.values()):
        low, high, _ = _wanted(F.col("__n"), p)
        for side, rank in (("lo", low), ("hi", high)):
            inside = (rank <= F.col("__end")) & (rank > F.col("__end") - F.col("__c"))
            found.append(F.max(F.when(inside, F.col("__v"))).alias(f"__{side}{i}"))
    return found


def _between(probs: dict[str, float]) -> list[Column]:
    out = []
    for i, (name, p) in enumerate(probs.items()):
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        out.append((lo + _wanted(F.col("__n"), p)[2] * (hi - lo)).alias(name))
    return out


def _wanted(n: Column, p: float) -> tuple[Column, Column, Column]:
    """Ranks of the two neighbours of a position, and its place between them."""
    h = (n - 1) * F.lit(p)
    low = F.floor(h) + 1
    return low, F.least(low + 1, n), h - F.floor(h)


def ranged_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """The same for groups of any size.  Each group is cut into value ranges at approximate quantiles (one partial
    aggregate, kept as a table), a second pass counts the ranges map-side, and only the rows of the ranges that hold a
    wanted rank are shuffled, equal values as one row with a count, and sorted -- so neither a hot group nor a hot
    value is one task's work."""
    keys, v = _values(df, value, by)
    x = F.col("__v")
    groups = kept(v.groupBy(*keys).agg(F.count(x).alias("__n"), F.array_distinct(F.percentile_approx(
        x, [i / CUTS for i in range(1, CUTS)], 10 * CUTS)).alias("__cuts")), "quantile_cuts")
    few = groups.count() <= FEW_GROUPS

    def joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
        other = right.withColumnsRenamed({c: f"{c}_r" for c in on})
        return left.join(F.broadcast(other) if few else other, same(on, [f"{c}_r" for c in on]), how).drop(*[f"{c}_r" for c in on])
    ranged = joined(v.where(x.isNotNull()), groups, keys).withColumn("__b", bisect(F.col("__cuts"), x, CUTS)).drop("__cuts")
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)   # CUTS rows a group
    spans = ranged.groupBy(*keys, "__n", "__b").agg(F.count(F.lit(1)).alias("__m")) \
        .withColumn("__off", F.coalesce(F.sum("__m").over(before), F.lit(0)))
    hit = F.lit(False)
    for p in probs.values():
        low, high, _ = _wanted(F.col("__n"), p)
        hit = hit | ((high > F.col("__off")) & (low <= F.col("__off") + F.col("__m")))
    # two ranges a group and quantile, as a table: its broadcast is bounded by that of the groups
    hits = kept(spans.where(hit).select(*keys, "__b", "__off"), "quantile_ranges")
    counted = joined(ranged, hits, [*keys, "__b"]).groupBy(*keys, "__n", "__b", "__off", "__v").agg(F.count(F.lit(1)).alias("__c"))
    upto = Window.partitionBy(*keys, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("__end", F.col("__off") + F.sum("__c").over(upto))
    ends = placed.groupBy(*keys).agg(*_picked(probs))
    # an empty table has no group, but its quantiles over all are one row of NULLs
    every = groups.drop("__cuts") if by else groups.agg(F.lit(0).alias("__all"), F.coalesce(F.sum("__n"), F.lit(0)).alias("__n"))
    return joined(every, ends, keys, "left").select(*[F.col(k).alias(c) for c, k in zip(by, keys)], *_between(probs))


def welch(mean_a: Column, var_a: Column, n_a: Column, mean_b: Column, var_b: Column, n_b: Column):
    """Welch t statistic and Welch-Satterthwaite degrees of freedom (a - b)."""
    se2 = var_a / n_a + var_b / n_b
    t = (mean_a - mean_b) / F.sqrt(se2)
    df = se2 * se2 / (var_a * var_a / (n_a * n_a * (n_a - 1)) + var_b * var_b / (n_b * n_b * (n_b - 1)))
    return t, df
