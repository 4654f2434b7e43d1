"""Readers and writers: Parquet, CSV (clean and dirty), JSON, JDBC.

All paths are folders on shared storage.  Scratch output goes below the
session's ``spark.checkpoint.dir`` (the shared folder a cluster names), never
to a machine-local temporary folder.
"""
from __future__ import annotations

import os
import uuid
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarry.session import ensure_checkpoint_dir

DEFAULT_NA = ("", "NA", "N/A", "n/a", "na", "null", "NULL", "None", "-", "NaN")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "quarry-out", f"{name}-{uuid.uuid4().hex[:12]}")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True,
             encoding: str = "UTF-8", sep: str = ",") -> DataFrame:
    """Typed CSV read with an explicit schema (no inference pass)."""
    return (spark.read.schema(schema).option("header", header).option("encoding", encoding)
            .option("sep", sep).option("mode", "PERMISSIVE").csv(path))


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with an explicit schema (UTF-8)."""
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def json_array_rows(doc: Column, schema: str) -> Column:
    """A JSON array of objects in a text column -> generator of rows
    (``json.loads`` + ``pd.DataFrame(list)``); use with ``select(inline(...))``."""
    return F.inline(F.from_json(doc, f"array<{schema}>"))


# ------------------------------------------------------------------ dirty CSV

def _na(c: Column, na_values: Iterable[str]) -> Column:
    t = F.trim(c)
    return F.when(t.isNull() | t.isin(*list(na_values)), F.lit(None)).otherwise(t)


def parse_timestamp(c: Column, formats: Sequence[str]) -> Column:
    """First format that parses wins (ordered list, H12); otherwise NULL."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def clean_columns(raw: DataFrame, types: dict[str, str], date_formats: dict[str, Sequence[str]] | None = None,
                  na_values: Iterable[str] = DEFAULT_NA) -> DataFrame:
    """Coerce string columns: NA tokens -> NULL, ``try_cast`` to the target
    type, dates through an ordered list of formats; bad values become NULL."""
    date_formats = date_formats or {}
    out = []
    for name in raw.columns:
        v = _na(F.col(name), na_values)
        if name in date_formats:
            v = parse_timestamp(v, date_formats[name]).cast(types.get(name, "timestamp_ntz"))
        elif name in types:
            v = v.try_cast(types[name])
        out.append(v.alias(name))
    return raw.select(*out)


def read_csv_dirty(spark: SparkSession, path: str, columns: Sequence[str], types: dict[str, str],
                   date_formats: dict[str, Sequence[str]] | None = None, required: Sequence[str] = (),
                   na_values: Iterable[str] = DEFAULT_NA, header: bool = True):
    """Read a dirty CSV as text, coerce it, and split off rejected rows.

    Returns (clean, rejects): ``rejects`` holds rows where a ``required``
    column is NULL after coercion, with the raw text and a reason."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    raw = spark.read.schema(schema).option("header", header).csv(path)
    withraw = raw.withColumn("__raw", F.to_json(F.struct(*raw.columns)))
    sel = []
    for name in raw.columns:
        v = _na(F.col(name), na_values)
        if date_formats and name in date_formats:
            v = parse_timestamp(v, date_formats[name]).cast(types.get(name, "timestamp_ntz"))
        elif name in types:
            v = v.try_cast(types[name])
        sel.append(v.alias(name))
    full = withraw.select(*sel, "__raw")
    bad = F.lit(False)
    reason = F.lit(None).cast("string")
    for c in reversed(list(required)):
        bad = bad | F.col(c).isNull()
        reason = F.when(F.col(c).isNull(), F.lit(f"missing or unparseable {c}")).otherwise(reason)
    clean = full.where(~bad).drop("__raw") if required else full.drop("__raw")
    rejects = full.where(bad).select(F.col("__raw").alias("raw"), reason.alias("reason"))
    return clean, rejects


# ----------------------------------------------------------------------- JDBC

def jdbc_options(url: str, table: str | None = None, query: str | None = None, user: str | None = None,
                 password_env: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetchsize: int = 10000, driver: str | None = None) -> dict:
    """Options for a partitioned JDBC read/write.

    The password is read from an environment variable named by the caller,
    never passed as a literal.  A partition column with bounds splits the
    read into ``num_partitions`` parallel range queries, so no single task
    (and never the driver) fetches the whole result.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = {"url": url, "fetchsize": str(fetchsize)}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if user:
        opts["user"] = user
    if password_env:
        pw = os.environ.get(password_env)
        if pw is None:
            raise KeyError(f"environment variable {password_env} is not set")
        opts["password"] = pw
    if driver:
        opts["driver"] = driver
    if partition_column:
        if query is not None:
            raise ValueError("partitioned reads need dbtable (Spark does not split a query option)")
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_jdbc(spark: SparkSession, options: dict) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, options: dict, mode: str = "overwrite", truncate: bool = True) -> None:
    """``to_sql(if_exists='replace')``: overwrite, keeping the table
    definition when ``truncate`` is set."""
    opts = dict(options)
    opts.pop("query", None)
    df.write.format("jdbc").options(**opts).option("truncate", str(truncate).lower()).mode(mode).save()
