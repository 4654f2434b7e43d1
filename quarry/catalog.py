"""Query catalogue: key -> (Spark function, oracle SQL).

A plan module registers a query with :func:`query`; the decorated function
receives a :class:`quarry.session.Tables` and returns a DataFrame.  The SQL
text is the same query for an independent engine (DuckDB) over the same
parquet tables; derived views are added as CTEs.  Keeping both in one place
means ``queries()`` and ``oracle_sql()`` cannot drift apart.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.plans.views import with_views
from quarry.session import Tables


@dataclass(frozen=True)
class Entry:
    key: str
    fn: Callable[[Tables], DataFrame]
    sql: str | None
    section: str


REGISTRY: dict[str, Entry] = {}


def query(key: str, sql: str | None = None, views: tuple[str, ...] = (), section: str = ""):
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, with_views(sql, *views) if sql else None, section)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # Importing the plan modules fills the registry.
    from quarry.plans import (  # noqa: F401
        scans, projection, joins, aggregates, windows, sorting, setops, scalars,
        reshape, analytics, quality, plotdata, text, streams)
    return REGISTRY


def run(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_all()[key].fn(Tables(spark, sf_dir))
