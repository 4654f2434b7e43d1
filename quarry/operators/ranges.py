"""Cutting rows into ranges of an order, so that their number follows the data.

* :class:`Ranges`: ranges of a whole table by a whole sort key.  Cuts are equal-depth keys of a bounded random sample; a
  key that fills several cuts gets ranges of its own, over which its rows are spread.
* :class:`HotCuts`: the same inside the buckets of a key (a customer's year, say) that hold too many rows; the other
  buckets stay whole.
"""
from __future__ import annotations

import math
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources import scratch_dir

SAMPLE, SMALL_SAMPLE = 65_536, 1024  # keys drawn for the cuts, of large and of small files
ROWS_A_RANGE = 50_000               # aim; twice that is rarely passed (the cuts are sampled)
FEWEST, MOST = 16, 8192             # ranges; beyond 400 million rows they grow, as a task can sort far more with spilling
SPLIT = 1 << 14                     # numbers kept free for the parts of one key
HOT_ROWS = 1_000_000                # rows a bucket may hold
HOT_SAMPLE, HOT_PIECES = 8192, 1024  # rows drawn of a hot bucket, on average, and pieces at most
SMALL_FILES = 64 << 20              # up to this many bytes of input no bucket is looked for

SPREAD_FILES = 16 << 20             # up to this many bytes of input rows are not spread

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def kept(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the session's shared folder."""
    path = scratch_dir(df.sparkSession, tag)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def leaf_bytes(*frames: DataFrame) -> int:
    """Bytes of the files below the frames, as the planner knows them (no job)."""
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        total += sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return total


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as its files have MB, so that what a task sorts does not grow with the
    data; small files are left as they are.  Tasks merged by compressed size may sort gigabytes each."""
    size = leaf_bytes(df)
    if size <= SPREAD_FILES:
        return df
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST, size >> 20)), *keys)


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality, column by column."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def order_key(df: DataFrame, order: Sequence[tuple[str, bool]]) -> Column:
    """A struct that sorts ascending as ``order`` does: NULLs first where ascending, last where descending, NaN above
    all numbers.  Descending integers are complemented, other numbers negated, texts complemented digit by digit."""
    fields = []
    for i, (name, ascending) in enumerate(order):
        kind, c = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, T.DateType):
            c, kind = F.unix_date(c), T.IntegerType()
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c, kind = F.unix_micros(c.cast("timestamp")), T.LongType()
        elif isinstance(kind, T.BooleanType):
            c, kind = c.cast("int"), T.IntegerType()
        if ascending:
            fields.append(c.alias(f"k{i}"))
            continue
        fields.append(c.isNull().alias(f"n{i}"))
        if isinstance(kind, _INTS):
            fields.append(F.bitwise_not(c).alias(f"k{i}"))
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            fields += [(~F.isnan(c)).alias(f"f{i}"), (-c).alias(f"k{i}")]
        elif isinstance(kind, T.DecimalType):
            fields.append((-c).alias(f"k{i}"))
        else:   # the end of a text sorts behind its continuations
            digits = F.hex(c.cast("string").cast("binary") if not isinstance(kind, T.BinaryType) else c)
            fields.append(F.concat(F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G")).alias(f"k{i}"))
    return F.struct(*fields)


def bisect(bounds: Column, key: Column, most: int) -> Column:
    """How many of at most ``most`` ascending ``bounds`` lie below ``key``, by halving steps."""
    steps = F.expr(f"array({', '.join(str(1 << b) for b in reversed(range(max(most, 1).bit_length())))})")
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(bounds, at + step - 1).isNotNull() & (F.get(bounds, at + step - 1) < key), at + step).otherwise(at))


def _place(key: Row) -> tuple:
    """Sorts as Spark sorts the struct: NULL first, NaN last, texts by code point."""
    return tuple((0, 0) if v is None else (2, 0) if isinstance(v, float) and math.isnan(v) else (1, bytes(v) if isinstance(v, bytearray) else v)
                 for v in key)


def _literal(key: Row, kind: T.StructType) -> str:
    """A key as SQL.  Texts and bytes are written in hexadecimal, numbers with all their digits."""
    def one(v, f: T.StructField) -> str:
        if v is None:
            text = "null"
        elif isinstance(v, str):
            text = f"decode(unhex('{v.encode().hex()}'), 'UTF-8')"
        elif isinstance(v, (bytes, bytearray)):
            text = f"unhex('{bytes(v).hex()}')"
        else:
            text = f"'{v!r}'" if isinstance(v, float) else f"'{v}'"
        return f"'{f.name}', cast({text} as {f.dataType.simpleString()})"
    return "named_struct(" + ", ".join(one(v, f) for v, f in zip(key, kind)) + ")"


class Ranges:
    """Ranges of ``df`` by ``order`` (column, ascending); a sample of the rows is drawn, and they are counted.

    A range holds about ``rows`` rows, unless their number ``many`` is given.  Rows of one whole sort key share a range, unless ``split`` is set: then a key
    that fills several cuts has a range of its own, dealt by a hash of the row to as many parts as it fills cuts (rows
    that agree in every column stay together).  ``MOST`` bounds the number of ranges and so every table of them."""

    def __init__(self, df: DataFrame, order: Sequence[tuple[str, bool]], rows: int = ROWS_A_RANGE, many: int | None = None, split: bool = True):
        self.order, self.columns, self.split = list(order), df.columns, split
        keys = df.select(order_key(df, order).alias("k"))
        self.type = keys.schema["k"].dataType
        if leaf_bytes(df) > SMALL_FILES:    # a limit would bring a full sample from every task to the driver
            self.rows = df.count()
            size = SAMPLE if (many or MOST) > SMALL_SAMPLE // 16 else SMALL_SAMPLE
            drawn = keys.where(F.rand(17) * self.rows < size).collect()
        else:
            seen = Observation("rows")
            drawn = keys.observe(seen, F.count(F.lit(1)).alias("n")).orderBy(F.rand(17)).limit(SMALL_SAMPLE).collect()
            self.rows = seen.get["n"]
        drawn = sorted((r.k for r in drawn), key=_place)
        many = many or min(MOST, max(FEWEST, -(-self.rows // rows)))
        cuts = [drawn[len(drawn) * i // many] for i in range(1, many)] if drawn else []
        self.cuts, self.parts = [], []
        for c in cuts:
            if self.cuts and _place(c) == _place(self.cuts[-1]):
                self.parts[-1] += 1
            else:
                self.cuts.append(c)
                self.parts.append(1)

    def number(self, df: DataFrame) -> Column:
        """The range of a row, ascending along the order: range * SPLIT + part."""
        key = order_key(df, self.order)
        if not self.cuts:
            return F.lit(0).cast("long")
        cuts = F.expr("array(" + ", ".join(_literal(c, self.type) for c in self.cuts) + ")")
        at = bisect(cuts, key, len(self.cuts))
        if not self.split or max(self.parts) == 1:
            return at.cast("long") * 2 * SPLIT
        parts = F.get(F.expr(f"array({', '.join(map(str, self.parts))})"), at)
        own = (parts > 1) & (F.get(cuts, at) == key)        # the key that fills the cut above: the last of its range
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in self.columns]), parts)
        return F.when(own, (at.cast("long") * 2 + 1) * SPLIT + part).otherwise(at.cast("long") * 2 * SPLIT)


def wanted(frames: Sequence[DataFrame], limit: int | None) -> bool:
    """Whether hot buckets are to be looked for."""
    return limit is not None or leaf_bytes(*frames) > SMALL_FILES


class HotCuts:
    """Cuts of the (key, bucket) groups that hold more than ``limit`` rows over all ``frames``.

    Every frame has the columns ``keys``, ``__b`` (bucket) and ``order``.  Counting is one partial aggregate; it is left
    out where the input files have up to ``SMALL_FILES`` bytes and no ``limit`` is given.  Of each hot group
    ``HOT_SAMPLE`` rows on average give its cuts.  :meth:`assign` replaces ``__b`` by (bucket, piece); rows of one sort key share a piece."""

    def __init__(self, frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str], limit: int | None = None):
        self.keys, self.order, self.cuts = list(keys), list(order), None
        if not wanted(frames, limit):
            return
        limit = limit or HOT_ROWS
        group = [*self.keys, "__b"]
        rows = reduce(DataFrame.union, [f.select(*group, F.struct(*self.order).alias("__o")) for f in frames])
        hot = kept(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit), "hot_buckets")
        if hot.isEmpty():
            return
        other = hot.withColumnsRenamed({c: f"{c}_h" for c in group})
        names = [f"{c}_h" for c in group]
        drawn = (rows.join(other, same(group, names)).where(F.rand(29) * F.col("__n") < HOT_SAMPLE)
                 .groupBy(*names, "__n").agg(F.sort_array(F.collect_list("__o")).alias("s")))
        many = F.least(F.lit(HOT_PIECES), F.ceil(F.col("__n") / limit)).cast("int")
        place = F.transform(F.sequence(F.lit(1), F.greatest(many - 1, F.lit(1))), lambda i: F.get("s", F.floor(F.size("s") * i / many).cast("int")))
        self.cuts = kept(drawn.select(*names, F.array_distinct(place).alias("__cuts")), "hot_cuts")

    def __bool__(self) -> bool:
        return self.cuts is not None

    def assign(self, df: DataFrame) -> DataFrame:
        if self.cuts is None:
            return df
        group = [*self.keys, "__b"]
        j = df.join(self.cuts, same(group, [f"{c}_h" for c in group]), "left")
        piece = F.coalesce(bisect(F.col("__cuts"), F.struct(*self.order), HOT_PIECES), F.lit(0))
        return j.select(*[F.col(f"`{c}`") for c in df.columns if c != "__b"], F.struct(F.col("__b").alias("bucket"), piece.alias("piece")).alias("__b"))
