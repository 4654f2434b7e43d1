"""Matrices of rows or of vector columns: Gram matrix, means, covariances and correlations in one pass."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDE = 8          # index blocks of 8 x 8: 64 running sums a block, which Spark compiles into one loop


def vector_sums(df: DataFrame, vector: str | Column, size: int) -> DataFrame:
    """Sums of outer products over the rows: (i, j, s) for 0 <= i <= j <= ``size``, where entry 0 of every vector is 1.

    So (0, 0) is the number of rows, (0, j) the sum of entry j and (i, j) that of the products (entries count from 1).
    Every row adds to blocks of 8 x 8 indices, which are summed map-side: a task shuffles one number a cell, however
    many rows it reads.  Rows whose vector is NULL, has another length, or holds a NULL, NaN or infinite entry do not
    count."""
    v = F.col(vector) if isinstance(vector, str) else vector
    v = F.transform(v, lambda x: x.cast("double"))
    blocks = size // SIDE + 1
    one = F.concat(F.array(F.lit(1.0)), F.col("v"), F.array_repeat(F.lit(0.0), blocks * SIDE - size - 1))
    rows = df.select(v.alias("v")).where(F.coalesce(F.size("v") == size, F.lit(False))).select(
        one.alias("v"), F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))).alias("bad")).where("not bad")
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(blocks) for b in range(a, blocks)])
    cut = rows.select("v", F.explode(pairs).alias("p")).select(
        "p.a", "p.b", F.slice("v", F.col("p.a") * SIDE + 1, F.lit(SIDE)).alias("x"), F.slice("v", F.col("p.b") * SIDE + 1, F.lit(SIDE)).alias("y"))
    cells = [(r, c) for r in range(SIDE) for c in range(SIDE)]
    sums = cut.groupBy("a", "b").agg(*[F.sum(F.get("x", F.lit(r)) * F.get("y", F.lit(c))).alias(f"s{r}_{c}") for r, c in cells])
    every = sums.select("a", "b", F.inline(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c"), F.col(f"s{r}_{c}").alias("s"))
                                                    for r, c in cells])))
    i, j = F.col("a") * SIDE + F.col("r"), F.col("b") * SIDE + F.col("c")
    return every.select(i.alias("i"), j.alias("j"), "s").where((F.col("i") <= F.col("j")) & (F.col("j") <= size))


def vector_stats(df: DataFrame, vector: str | Column, size: int) -> DataFrame:
    """(i, j, n, mean_i, mean_j, cov, corr) for all pairs of entries of a vector column, 1 <= i, j <= ``size``.

    ``cov`` is the sample covariance.  They follow from the sums of :func:`vector_sums`, so entries whose mean is
    many times their spread lose digits: subtract a constant from them first.  A constant entry has NULL correlations."""
    g = vector_sums(df, vector, size)
    n = F.max(F.when((F.col("i") == 0) & (F.col("j") == 0), F.col("s")))
    # size + 1 rows: the sum and the sum of squares of each entry
    ends = g.where((F.col("i") == 0) | (F.col("i") == F.col("j"))).groupBy("j").agg(
        F.max(F.when(F.col("i") == 0, F.col("s"))).alias("sum"), F.max(F.when(F.col("i") == F.col("j"), F.col("s"))).alias("square"))
    half = g.where("i > 0").join(ends.select(F.col("j").alias("i"), F.col("sum").alias("si"), F.col("square").alias("qi")), "i") \
        .join(ends.select("j", F.col("sum").alias("sj"), F.col("square").alias("qj")), "j")
    turned = half.where("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "s", F.col("sj").alias("si"),
                                        F.col("si").alias("sj"), F.col("qj").alias("qi"), F.col("qi").alias("qj"))
    both = half.select("i", "j", "s", "si", "sj", "qi", "qj").union(turned).withColumn("n", g.agg(n).scalar())
    cross, vi, vj = (F.col("s") - F.col("si") * F.col("sj") / F.col("n"), F.col("qi") - F.col("si") * F.col("si") / F.col("n"),
                     F.col("qj") - F.col("sj") * F.col("sj") / F.col("n"))
    return both.select("i", "j", F.col("n").cast("long").alias("n"), (F.col("si") / F.col("n")).alias("mean_i"),
                       (F.col("sj") / F.col("n")).alias("mean_j"), F.try_divide(cross, F.col("n") - 1).alias("cov"),
                       F.when((vi > 0) & (vj > 0), cross / F.sqrt(vi * vj)).alias("corr"))


def row_stats(cells: DataFrame, row: str, column: str, value: str, rows: Sequence) -> DataFrame:
    """The same between the rows of a matrix in long form (row, column, value): (row_a, row_b, n, ..., cov, corr).

    A column becomes a vector over the listed ``rows``, so its cells meet, not the pairs of cells; columns in which a
    listed row has no value do not count.  Several cells of one place: their sum."""
    place = F.map_from_entries(F.collect_list(F.struct(F.col("__r"), F.col("__v"))))
    one = cells.where(F.col(row).isin(list(rows))).groupBy(F.col(column).alias("__c"), F.col(row).alias("__r")).agg(F.sum(value).alias("__v"))
    names = F.array(*[F.lit(r) for r in rows])
    vectors = one.groupBy("__c").agg(place.alias("m")).select(F.transform(names, lambda r: F.try_element_at("m", r)).alias("v"))
    stats = vector_stats(vectors, "v", len(rows))
    return stats.select(F.get(names, F.col("i") - 1).alias("row_a"), F.get(names, F.col("j") - 1).alias("row_b"),
                        "n", "mean_i", "mean_j", "cov", "corr")
