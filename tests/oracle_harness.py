"""Run a registered query in Spark and its oracle SQL in DuckDB, and compare.

Compares row count, column names, column types (coarsely) and an
order-insensitive hash of the values, with columns sorted by name.
Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import hashlib
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    return str(v)


def _digest(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = sorted("|".join(_canon(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


_SPARK_KIND = {
    "int": "int32", "integer": "int32", "bigint": "int64", "long": "int64", "smallint": "int16",
    "string": "str", "double": "float", "float": "float", "boolean": "bool", "date": "date",
}
_DUCK_KIND = {
    "INTEGER": "int32", "BIGINT": "int64", "SMALLINT": "int16", "VARCHAR": "str", "DOUBLE": "float",
    "FLOAT": "float", "BOOLEAN": "bool", "DATE": "date", "HUGEINT": "int128",
}


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E

    q = E.queries()[name]
    sql = E.oracle_sql().get(name)
    t0 = time.time()
    df = q(spark, sf_dir)
    s_names = df.columns
    s_types = [_SPARK_KIND.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    d_names = [d[0] for d in rel.description]
    d_types = [_DUCK_KIND.get(str(d[1]), str(d[1])) for d in rel.description]
    d_rows = rel.fetchall()
    out["duck_rows"] = len(d_rows)
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"names spark={s_names} duck={d_names}")
    else:
        st = dict(zip(s_names, s_types))
        dt = dict(zip(d_names, d_types))
        bad = {n: (st[n], dt[n]) for n in s_names if st[n] != dt[n]}
        if bad:
            problems.append(f"types {bad}")
    if len(s_rows) != len(d_rows):
        problems.append("row count")
    elif _digest(s_names, s_rows) != _digest(d_names, d_rows):
        problems.append("values")
    out["status"] = "ok" if not problems else "FAIL: " + "; ".join(problems)
    return out


def main(argv):
    from tradeflow.session import local_session

    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)]
    spark = local_session()
    import __spark_entry__ as E

    con = duck(sf_dir)
    failed = 0
    for n in names or list(E.queries()):
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        failed += not (r["status"] in ("ok", "rows-only"))
        print(r, flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
