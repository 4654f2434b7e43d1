"""Side-by-side check of a catalogue query against its oracle SQL (DuckDB).

Mirrors the driver's gate: same row count, same column names, and equal
order-insensitive values (floats compared to 9 significant digits).
Usable as a script: ``python tests/oracle.py [sf_dir] [key ...]``.
"""
from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys

import duckdb
import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import BASE_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, (float, np.floating)):
        f = float(v)
        if math.isnan(f):
            return None
        if math.isinf(f):
            return f
        if f == 0:
            return 0.0
        return float(f"{f:.9g}")
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, np.datetime64):
        import pandas as pd
        return _norm(pd.Timestamp(v).to_pydatetime())
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dict):
        return tuple((k, _norm(x)) for k, x in v.items())
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, repr(type(x).__name__), repr(x)) for x in row)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


def spark_rows(df):
    pdf = df.toPandas()
    cols = list(pdf.columns)
    rows = [tuple(None if (not isinstance(x, (list, tuple, np.ndarray, dict)) and x is not None
                           and _isna(x)) else x for x in r)
            for r in pdf.itertuples(index=False, name=None)]
    return cols, rows


def _isna(x):
    try:
        import pandas as pd
        return bool(pd.isna(x))
    except (TypeError, ValueError):
        return False


def compare(spark, con, key, fn, sql, sf_dir):
    from quarry.session import Tables
    df = fn(Tables(spark, sf_dir))
    scols, srows = normalise(*spark_rows(df))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    dcols, drows = normalise(dcols, res.fetchall())
    problems = []
    if scols != dcols:
        problems.append(f"columns differ: spark={scols} oracle={dcols}")
    if len(srows) != len(drows):
        problems.append(f"rows differ: spark={len(srows)} oracle={len(drows)}")
    elif scols == dcols and srows != drows:
        bad = next(i for i in range(len(srows)) if srows[i] != drows[i])
        problems.append(f"values differ at sorted row {bad}: spark={srows[bad]} oracle={drows[bad]}")
    return len(srows), problems


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    from quarry.catalog import load_all
    from quarry.session import build_session
    reg = load_all()
    spark = build_session("local[8]")
    con = duck(sf_dir)
    failed = []
    for key in keys or sorted(reg):
        e = reg[key]
        if not e.sql:
            from quarry.session import Tables
            n = e.fn(Tables(spark, sf_dir)).count()
            print(f"ROWS  {key}: {n} rows (no oracle)")
            continue
        try:
            n, problems = compare(spark, con, key, e.fn, e.sql, sf_dir)
        except Exception as exc:  # report and continue
            n, problems = -1, [f"error: {str(exc)[:600]}"]
        status = "OK  " if not problems else "FAIL"
        print(f"{status}  {key}: {n} rows {'; '.join(problems)}", flush=True)
        if problems:
            failed.append(key)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
