"""Session helpers and table access."""
from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "quarry") -> SparkSession:
    """Session for tests and benchmarks (local mode).

    On a cluster the deployment supplies master, memory and
    ``spark.checkpoint.dir``; this builder only sets what is unset.
    """
    given = SparkConf()          # what the deployment sets (spark-submit, defaults file) is in here
    b = SparkSession.builder.appName(app)
    for k, v in {
        "spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # naming the Python line of every expression costs several JVM calls each, most of a short query's planning
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.driver.memory": os.environ.get("QUARRY_DRIVER_MEMORY", "16g"),
    }.items():
        if not given.contains(k):
            b = b.config(k, v)
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    always used.  When nothing is configured a local master gets a fresh
    scratch folder; any other master is an error, because executors would
    not see each other's files.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return conf
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="quarry-ckpt-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


class Tables:
    """Lazy access to the base parquet tables and the derived views.

    ``t.orders`` reads ``{sf_dir}/orders.parquet``; derived views such as
    ``t.matches`` are defined in :mod:`quarry.plans.views` on top of them.
    Reading is lazy, so only referenced columns reach the scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in BASE_TABLES:
            return self.read(name)
        from quarry.plans import views
        builder = views.BUILDERS.get(name)
        if builder is None:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = builder(self)
        return self._cache[name]
