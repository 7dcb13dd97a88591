"""Run registered queries on Spark and their DuckDB oracle text side by side.

Compares row count, column names, type family and an order-insensitive value
multiset (floats rounded to 6 places). Usable from pytest and as a script:

    python tests/oracle_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import json
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return json.dumps([_norm(x) for x in v], default=str)
    if isinstance(v, dict):
        return json.dumps({str(k): _norm(x) for k, x in sorted(v.items(), key=lambda kv: str(kv[0]))}, default=str)
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def _family(t: str) -> str:
    t = t.lower()
    if any(k in t for k in ("tinyint", "smallint", "integer", "bigint", "hugeint", "int", "long", "short", "byte")) and "interval" not in t:
        return "int"
    if any(k in t for k in ("double", "float", "real")):
        return "float"
    if "decimal" in t:
        return "decimal"
    if any(k in t for k in ("varchar", "string", "text")):
        return "string"
    if "timestamp" in t:
        return "timestamp"
    if "date" in t:
        return "date"
    if "bool" in t:
        return "bool"
    return t


def spark_rows(df):
    cols = df.columns
    rows = [tuple(_norm(r[i]) for i in range(len(cols))) for r in df.collect()]
    types = {f.name: _family(f.dataType.simpleString()) for f in df.schema.fields}
    return cols, types, rows


def duck_rows(con, sql):
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    types = {d[0]: _family(str(d[1])) for d in rel.description}
    rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    return cols, types, rows


def _sorted(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return sorted(out, key=lambda r: json.dumps(r, default=str))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    s_cols, s_types, s_rows = spark_rows(fn(spark, sf_dir))
    t_spark = time.time() - t0
    res = {"name": name, "rows": len(s_rows), "spark_s": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    d_cols, d_types, d_rows = duck_rows(con, sql)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    else:
        tdiff = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
        if tdiff:
            problems.append(f"types {tdiff}")
        if len(s_rows) != len(d_rows):
            problems.append(f"rowcount spark={len(s_rows)} duck={len(d_rows)}")
        a, b = _sorted(s_cols, s_rows), _sorted(d_cols, d_rows)
        if a != b:
            sa, sb = set(a), set(b)
            only_s = list(sa - sb)[:3]
            only_d = list(sb - sa)[:3]
            problems.append(f"values differ: spark-only {only_s} duck-only {only_d}")
    res["status"] = "ok" if not problems else "FAIL"
    if problems:
        res["problems"] = problems
    return res


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    from stardust.session import get_spark
    import __spark_entry__ as E
    spark = get_spark(master="local[8]")
    con = duck(a.sf)
    qs, sqls = E.queries(), E.oracle_sql()
    names = a.names or list(qs)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, qs[n], sqls.get(n), a.sf)
        except Exception as e:  # report and go on
            r = {"name": n, "status": "ERROR", "error": str(e)[:600]}
        bad += r["status"] in ("FAIL", "ERROR")
        print(json.dumps(r), flush=True)
    print(json.dumps({"total": len(names), "bad": bad}))
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
