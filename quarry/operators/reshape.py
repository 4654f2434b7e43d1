"""Reshaping operators: pivots, melt, one-hot, resampling, islands, downcast, categories."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_INT_TYPES = [("tinyint", -2**7, 2**7 - 1), ("smallint", -2**15, 2**15 - 1),
              ("int", -2**31, 2**31 - 1), ("bigint", -2**63, 2**63 - 1)]
FEW_VALUES = 100_000     # values of a dictionary that is broadcast
_FLOAT_MAX = 3.4028234663852886e38


def downcast(df: DataFrame, lossy: bool = False) -> DataFrame:
    """Cast every integral-valued numeric column to the narrowest integer type
    that holds its range.  One aggregate computes all minima and maxima
    (a single row reaches the driver); the casts stay lazy.

    Fractional doubles keep their type unless ``lossy`` is set: then those
    whose range a float holds become floats and keep about 7 digits."""
    num = [f.name for f in df.schema.fields if f.dataType.typeName() in
           ("byte", "short", "integer", "long", "double", "float")]
    bounds = df.agg(*[F.min(c).alias(f"mn_{c}") for c in num], *[F.max(c).alias(f"mx_{c}") for c in num],
                    *[F.bool_and(F.col(c) == F.floor(c)).alias(f"int_{c}") for c in num]).first()
    out = []
    for f in df.schema.fields:
        c = f.name
        lo, hi = (bounds[f"mn_{c}"], bounds[f"mx_{c}"]) if c in num else (None, None)
        if lo is not None and bounds[f"int_{c}"] is not False and -2**63 <= lo and hi < 2**63:
            target = next(n for n, a, b in _INT_TYPES if lo >= a and hi <= b)
            out.append(F.col(c).cast(target).alias(c))
        elif lossy and f.dataType.typeName() == "double" and lo is not None and max(-lo, hi) <= _FLOAT_MAX:
            out.append(F.col(c).cast("float").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def dictionary(df: DataFrame, col: str) -> DataFrame:
    """The categories of a column: (category, code), codes 0, 1, ... in the order of the values; NULL is no category.

    The distinct values are numbered by ranges, so a column of many values is no one task's work.  The dictionary is a
    written table, so that its readers do not find the values again."""
    from quarry.operators.ranges import kept
    from quarry.operators.windows import global_row_number
    values = df.select(F.col(f"`{col}`").alias("category")).where(F.col("category").isNotNull()).distinct()
    return kept(global_row_number(values, [("category", True)], "__n").select("category", (F.col("__n") - 1).alias("code")), "dictionary")


def _sent(categories: DataFrame) -> DataFrame:
    """A dictionary of up to ``FEW_VALUES`` values goes to every task, so that rows are not gathered by few values."""
    return F.broadcast(categories) if categories.limit(FEW_VALUES + 1).count() <= FEW_VALUES else categories


def encode(df: DataFrame, col: str, categories: DataFrame, code: str | None = None) -> DataFrame:
    """``df`` with the column ``code`` (default: in place of ``col``): the code of the value, -1 for NULL or a value that
    ``categories`` (see :func:`dictionary`) does not have.  A dictionary of few values is broadcast; with many, a common
    value is no hot task: AQE splits the join."""
    found = _sent(categories).select(F.col("category").alias("__cat"), F.col("code").alias("__code"))
    j = df.join(found, F.col(f"`{col}`") == F.col("__cat"), "left")
    value = F.coalesce("__code", F.lit(-1))
    if code:
        return j.select(*[F.col(f"`{c}`") for c in df.columns if c != code], value.alias(code))
    return j.select(*[value.alias(c) if c == col else F.col(f"`{c}`") for c in df.columns])


def decode(df: DataFrame, code: str, categories: DataFrame, col: str) -> DataFrame:
    """``df`` with the column ``col``: the value of the code, NULL for -1."""
    found = _sent(categories).select(F.col("code").alias("__code"), F.col("category").alias("__cat"))
    return df.join(found, F.col(f"`{code}`") == F.col("__code"), "left").select(
        *[F.col(f"`{c}`") for c in df.columns if c != col], F.col("__cat").alias(col))


def compact(df: DataFrame, categories: Sequence[str] = (), lossy: bool = False) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``df`` with the listed text columns as codes and all numbers in their narrowest types, and the dictionaries."""
    found = {c: dictionary(df, c) for c in categories}
    out = df
    for c, d in found.items():
        out = encode(out, c, d)
    return downcast(out.select(*df.columns), lossy), found


def parquet_bytes(df: DataFrame) -> int:
    """Bytes of the table's files when written as Parquet (to a scratch folder, removed again)."""
    from quarry.sources import scratch_dir
    path = scratch_dir(df.sparkSession, "size")
    df.write.parquet(path)
    jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    size = sum(f.getLen() for f in fs.listStatus(folder) if f.getPath().getName().endswith(".parquet"))
    fs.delete(folder, True)
    return size


def melt(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str],
         var_name: str = "variable", value_name: str = "value") -> DataFrame:
    return df.unpivot(list(id_vars), list(value_vars), var_name, value_name)


def pivot_fixed(df: DataFrame, group: Sequence[str], col: str, values: Sequence, agg, fill=None) -> DataFrame:
    """Pivot with an explicit value list (no distinct-values job, H10)."""
    out = df.groupBy(*group).pivot(col, list(values)).agg(agg)
    return out.fillna(fill) if fill is not None else out


def one_hot(df: DataFrame, col: str, levels: Sequence[str], drop_first: bool = True, prefix: str | None = None):
    """Dummy columns for ``levels`` (sorted); ``drop_first`` drops the first level."""
    lv = sorted(levels)[1:] if drop_first else sorted(levels)
    p = prefix or col
    return df.select("*", *[(F.col(col) == v).cast("int").alias(f"{p}_{v}") for v in lv])


def islands(df: DataFrame, by: Sequence[str], day_col: str) -> DataFrame:
    """Runs of consecutive days per key (gaps and islands).

    Distinct days per key, then ``day - row_number`` is constant inside a
    run.  The window is per key over *distinct days*, so its size is bounded
    by the calendar, not by the row count."""
    d = df.select(*by, F.to_date(day_col).alias("d")).distinct()
    w = Window.partitionBy(*by).orderBy("d")
    g = d.withColumn("grp", F.date_sub("d", F.row_number().over(w)))
    return g.groupBy(*by, "grp").agg(F.min("d").alias("island_start"), F.max("d").alias("island_end"),
                                     F.count(F.lit(1)).alias("days")).drop("grp")


def daily_spine(df: DataFrame, time_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Every calendar day between the min and max of ``time_col`` (per key)."""
    b = df.groupBy(*by).agg(F.min(F.to_date(time_col)).alias("lo"), F.max(F.to_date(time_col)).alias("hi"))
    return b.select(*by, F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
