"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison: same column names, same row count, same multiset of rows after
sorting columns by name and rounding doubles to 6 places.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
               "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT",
               "float": "FLOAT", "date": "DATE"}


def rows_of_spark(df):
    cols = sorted(df.columns)
    types = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
             for f in df.schema.fields}
    data = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, data, [types[c] for c in cols]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    types = [str(t) for t in rel.types]
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    data = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    return cols, data, [types[i] for i in idx]


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            scols, srows, stypes = rows_of_spark(qs[name](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = f"rows-only {len(srows)} ({ts:.1f}s)"
            continue
        try:
            dcols, drows, dtypes = rows_of_duck(con, sqls[name])
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        if scols != dcols:
            results[name] = f"COLS differ spark={scols} duck={dcols}"
            continue
        if stypes != dtypes:
            diff = [(c, a, b) for c, a, b in zip(scols, stypes, dtypes) if a != b]
            results[name] = f"TYPES differ {diff}"
            continue
        key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
        if len(srows) != len(drows):
            results[name] = f"ROWS differ spark={len(srows)} duck={len(drows)}"
            continue
        a, b = sorted(srows, key=key), sorted(drows, key=key)
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        results[name] = (f"OK {len(srows)} rows ({ts:.1f}s)" if not bad
                         else f"VALUES differ ({len(bad)}): {bad[:2]}")
        if verbose:
            print(name, results[name], flush=True)
    return results


if __name__ == "__main__":
    from skyvane.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names, verbose=False)
    for k, v in res.items():
        print(f"{k:32s} {v}")
