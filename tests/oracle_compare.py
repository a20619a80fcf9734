"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]

Rows are compared as multisets of normalised tuples (columns sorted by
name); floats must agree exactly.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def norm(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        v = v.replace(tzinfo=None)
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows(df: pd.DataFrame) -> Counter:
    cols = sorted(df.columns)
    out = Counter()
    for tup in df[cols].astype(object).itertuples(index=False, name=None):
        out[tuple(norm(x) for x in tup)] += 1
    return out


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, str]:
    from shelfcast.plans.registry import ORACLE, QUERIES

    con = duck(sf_dir)
    results = {}
    for name in names or sorted(ORACLE):
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir).toPandas()
            ddf = con.execute(ORACLE[name]).df()
        except Exception as exc:  # noqa: BLE001
            results[name] = f"ERROR {type(exc).__name__}: {str(exc)[:300]}"
            if verbose:
                print(name, results[name][:400])
            continue
        msg = []
        if sorted(sdf.columns) != sorted(ddf.columns):
            msg.append(f"columns spark={sorted(sdf.columns)} duck={sorted(ddf.columns)}")
        elif len(sdf) != len(ddf):
            msg.append(f"rows spark={len(sdf)} duck={len(ddf)}")
        else:
            rs, rd = rows(sdf), rows(ddf)
            if rs != rd:
                only_s = list((rs - rd).elements())[:3]
                only_d = list((rd - rs).elements())[:3]
                msg.append(f"values differ ({sum((rs - rd).values())} rows) spark={only_s} duck={only_d}")
        results[name] = "; ".join(msg) or "ok"
        if verbose:
            print(f"{name:28s} {len(sdf):7d} rows {time.time() - t0:6.1f}s  {results[name][:400]}")
    return results


if __name__ == "__main__":
    from shelfcast.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v != "ok"}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
