"""Scalar column helpers: buckets, flags, safe arithmetic, strings, dates."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_category(c: Column, levels: Sequence[str]) -> Column:
    """1-based ordinal of ``c`` in ``levels`` (NULL when absent)."""
    e = F.when(F.lit(False), F.lit(None))
    for i, v in enumerate(levels, 1):
        e = e.when(c == v, F.lit(i))
    return e


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI mode would raise, H19)."""
    return F.try_divide(a, b)


def bin_right_closed(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """pandas.cut: intervals (e0, e1], (e1, e2], ...; outside -> NULL."""
    e = F.when(F.lit(False), F.lit(None))
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        e = e.when((c > lo) & (c <= hi), F.lit(lab))
    return e


def flag(cond: Column) -> Column:
    return cond.cast("int")


def odds_probabilities(home: Column, draw: Column, away: Column):
    """Normalised implied probabilities and the bookmaker margin (H2)."""
    inv = 1.0 / home + 1.0 / draw + 1.0 / away
    return (1.0 / home) / inv, (1.0 / draw) / inv, (1.0 / away) / inv, inv - 1.0


def len_trimmed(s: Column) -> Column:
    """T-SQL LEN: trailing blanks ignored."""
    return F.length(F.rtrim(s))


def word_count(s: Column) -> Column:
    """len(s.split()): whitespace runs, empty text -> 0."""
    t = F.trim(s)
    return F.when((t == "") | t.isNull(), F.lit(0)).otherwise(F.size(F.split(t, r"\s+")))


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods between two timestamps (pandas .dt.days, H29)."""
    return F.floor((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 86400e6)


def midnights_between(start: Column, end: Column) -> Column:
    """T-SQL DATEDIFF(DAY, a, b): calendar day boundaries crossed."""
    return F.datediff(F.to_date(end), F.to_date(start))


def json_scalar(doc: Column, path: str) -> Column:
    """JSON_VALUE: scalar at path, NULL for objects/arrays."""
    v = F.get_json_object(doc, path)
    return F.when(F.substring(F.ltrim(v), 1, 1).isin("{", "["), F.lit(None)).otherwise(v)


def nan_to_num(x: Column, nan: float = 0.0, posinf: float | None = None, neginf: float | None = None) -> Column:
    """numpy.nan_to_num: NaN and +-inf replaced (NaN is a value in Spark, H22)."""
    big = 1.7976931348623157e308
    return (F.when(F.isnan(x), F.lit(nan))
            .when(x == float("inf"), F.lit(posinf if posinf is not None else big))
            .when(x == float("-inf"), F.lit(neginf if neginf is not None else -big))
            .otherwise(x))


def inverted(m: str | Column) -> Column:
    """A map with keys and values swapped; of several keys with one value the last entry's wins, a NULL value is left out."""
    entries = F.filter(F.map_entries(m), lambda e: e["value"].isNotNull())
    rest = lambda i: F.slice(entries, i + 2, F.size(entries))
    last = F.filter(entries, lambda e, i: ~F.exists(rest(i), lambda later: later["value"] == e["value"]))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["value"], e["key"])))


def rows_of(values: Column, width: int) -> Column:
    """An array cut into rows of ``width`` entries, the last one perhaps shorter; an empty array has no rows."""
    n = F.ceil(F.size(values) / F.lit(width)).cast("int")
    places = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.slice(values, i * width + 1, F.lit(width)))
