"""Run registered queries on Spark and their SQL oracle on DuckDB; compare.

Usage: python -m tests.oracle_compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, names=None, con=None, verbose=True):
    sys.path.insert(0, ".")
    import __spark_entry__ as E

    qs, os_ = E.queries(), E.oracle_sql()
    con = con or duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
            ts = time.time() - t0
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK_ERR", str(e)[:300])
            if verbose:
                print(f"{name:32s} SPARK_ERR {str(e)[:300]}")
            continue
        if name not in os_:
            results[name] = ("NO_ORACLE", len(srows))
            if verbose:
                print(f"{name:32s} NO_ORACLE rows={len(srows)} spark={ts:.2f}s")
            continue
        t1 = time.time()
        try:
            cur = con.execute(os_[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("ORACLE_ERR", str(e)[:300])
            if verbose:
                print(f"{name:32s} ORACLE_ERR {str(e)[:300]}")
            continue
        to = time.time() - t1
        ok_cols = sorted(scols) == sorted(ocols)
        a, b = _rows(scols, srows), _rows(ocols, orows)
        ok = ok_cols and a == b
        results[name] = ("OK" if ok else "MISMATCH", len(srows), len(orows))
        if verbose:
            print(f"{name:32s} {'OK' if ok else 'MISMATCH'} rows={len(srows)}/{len(orows)} "
                  f"spark={ts:.2f}s duck={to:.2f}s")
            if not ok:
                if not ok_cols:
                    print("   cols", sorted(scols), sorted(ocols))
                diff_a = [r for r in a if r not in set(b)][:3]
                diff_b = [r for r in b if r not in set(a)][:3]
                print("   spark-only", diff_a)
                print("   oracle-only", diff_b)
    return results


if __name__ == "__main__":
    from roadlens.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO_ORACLE")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; bad: {sorted(bad)}")
