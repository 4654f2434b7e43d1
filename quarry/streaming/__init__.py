"""Structured Streaming extension: the time-based queries on event streams.

The reference has no streaming operator; these repeat its time-based
batch queries (daily resample, moving averages, de-duplication, latest
snapshot, leakage check) incrementally.  Each returns a streaming
DataFrame; state is bounded by the watermark or by the number of keys.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def event_stream(spark: SparkSession, folder: str, schema: StructType, glob: str = "*.parquet",
                 max_files_per_trigger: int | None = None, time_col: str = "ts") -> DataFrame:
    """Parquet files arriving in ``folder`` as a stream.  The event-time
    column is cast to TIMESTAMP (watermarks reject TIMESTAMP_NTZ)."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    s = r.parquet(folder)
    return s.withColumn(time_col, F.col(time_col).cast("timestamp"))


def tumbling_daily(stream: DataFrame, by: Sequence[str] = ("event_type",), value: str = "value",
                   time_col: str = "ts", watermark: str = "1 day") -> DataFrame:
    """Daily totals per key.  In append mode a day comes out once the watermark passes it, in update mode whenever it
    changed; ``seen`` is its latest event (for :func:`last_versions`)."""
    return (stream.withWatermark(time_col, watermark)
            .groupBy(F.window(time_col, "1 day").alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.max(time_col).alias("seen"))
            .select(F.col("w.start").alias("day_start"), F.col("w.end").alias("day_end"), *by, "n", "total", "seen"))


def sliding_avg(stream: DataFrame, value: str = "value", time_col: str = "ts", length: str = "7 days",
                slide: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """Mean over a trailing calendar window (7 days, advancing daily)."""
    return (stream.withWatermark(time_col, watermark)
            .groupBy(F.window(time_col, length, slide).alias("w"))
            .agg(F.avg(value).alias("avg_value"), F.count(F.lit(1)).alias("n"), F.max(time_col).alias("seen"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "avg_value", "n", "seen"))


def dedup(stream: DataFrame, keys: Sequence[str], time_col: str = "ts", watermark: str | None = None) -> DataFrame:
    """Drop repeated keys: one row a key, whatever the batches (state: the distinct keys).

    With a ``watermark`` keys are forgotten after that delay, and come out again if they return later."""
    if watermark is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(list(keys))


def latest_snapshot(stream: DataFrame, keys: Sequence[str], time_col: str, payload: Sequence[str]) -> DataFrame:
    """Last row per key (update mode): a streaming max(struct) whose state is
    one row per key."""
    best = F.max(F.struct(F.col(time_col), *[F.col(c) for c in payload])).alias("__b")
    return stream.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__b.{c}").alias(c) for c in [time_col, *payload]])


def late_quarantine(stream: DataFrame, events: DataFrame, key: str, time_col: str, event_time: str):
    """Stream-static join against the event table, split into rows collected
    before the event (clean) and at/after it (leaky)."""
    j = stream.join(events.select(key, event_time), key)
    leak = F.col(time_col) >= F.col(event_time).cast("timestamp")
    return j.where(~leak), j.where(leak)


def run_available(stream: DataFrame, out_dir: str, mode: str = "append") -> None:
    """Run a streaming query over everything available, then stop.

    ``append``: the parquet file sink (exactly-once through its commit log).
    ``update``: each micro-batch's changed rows go to their own batch folder
    via foreachBatch (idempotent per batch id: a retried batch overwrites
    its folder).  Checkpoints live next to the output in the shared folder.
    """
    ck = out_dir.rstrip("/") + "-checkpoint"
    if mode == "append":
        q = (stream.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", ck)
             .outputMode("append").trigger(availableNow=True).start())
    else:
        def write_batch(df, batch_id):
            df.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")
        q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ck)
             .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()


def last_versions(spark: SparkSession, out_dir: str, schema: StructType, keys: Sequence[str], end: str,
                  watermark: str = "1 day") -> DataFrame:
    """What an update-mode run of windows left in ``out_dir``: the last version of each window (``keys``), and ``closed``:
    whether the watermark, which lags the latest event (``seen``) by ``watermark``, has passed its ``end``.

    A version is the batch that wrote it; the last one is a maximum per key, combined map-side.  Without any batch the
    result is empty."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(out_dir)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema).withColumn("closed", F.lit(True))
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(out_dir)
    rest = [f.name for f in schema.fields if f.name not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("v")).select(*keys, "v.*")
    mark = rows.agg(F.max("seen") - F.expr(f"INTERVAL {watermark}")).scalar()
    return last.select(*schema.fieldNames(), (F.col(end) <= mark).alias("closed"))
