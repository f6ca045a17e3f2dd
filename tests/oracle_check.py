"""Run registered Spark queries next to their DuckDB oracle and compare.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.
Comparison is order-insensitive on rows, columns sorted by name, values
compared exactly (floats via repr) and column types mapped to DuckDB's.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
    "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(v):
    return (v is None, str(type(v)), str(v))


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple(_key(x) for x in t))
    return [columns[i] for i in order], out


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spark_secs = time.time() - t0
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    res = {"name": name, "spark_rows": len(rows), "spark_secs": round(spark_secs, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    sc, sr = canon(df.columns, rows)
    dc, dr = canon(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns {sc} vs {dc}")
    else:
        tdiff = {c: (s_types[c], d_types[c]) for c in sc if s_types[c] != d_types[c]}
        if tdiff:
            problems.append(f"types {tdiff}")
    if len(sr) != len(dr):
        problems.append(f"rowcount {len(sr)} vs {len(dr)}")
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b]
        problems.append(f"values differ in {len(bad)} rows, e.g. {bad[:2]}")
    res["status"] = "ok" if not problems else "FAIL"
    res["problems"] = problems
    return res


def main(argv):
    from shelfwise.session import build_session
    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = build_session()
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_connect(sf_dir)
    failed = 0
    for name in names or list(qs):
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls.get(name), con)
        except Exception as exc:  # noqa: BLE001
            r = {"name": name, "status": "ERROR", "problems": [repr(exc)[:800]]}
        failed += r["status"] in ("FAIL", "ERROR")
        print(r, flush=True)
    print(f"failed={failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
