"""Run registered queries beside their DuckDB twins and compare the results.

usage: check_oracle.py [--dir DIR] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from finecast.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def cell(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(str, map(cell, v))) + "]"
    return str(v)


def family(t: str) -> str:
    t = t.lower()
    if t in ("tinyint", "smallint", "int", "integer", "bigint", "hugeint", "long"):
        return "int"
    if t.startswith("decimal"):
        return "decimal"
    if t in ("double", "float"):
        return "double"
    if t in ("string", "varchar"):
        return "string"
    if t.startswith("timestamp"):
        return "timestamp"
    return t


def main() -> int:
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if "--dir" in args:
        i = args.index("--dir")
        sf = args[i + 1]
        del args[i : i + 2]
    from finecast.plans.catalog import ORACLES, QUERIES

    names = [n for n in QUERIES if not args or any(n.startswith(a) for a in args)]
    spark = local_session("check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = QUERIES[n](spark, sf)
            cols = sorted(df.columns)
            rows = [tuple(cell(x) for x in row) for row in df.select(*[f"`{c}`" for c in cols]).toLocalIterator()] if False else [
                tuple(cell(x) for x in row) for row in df.select(*[f"`{c}`" for c in cols]).collect()
            ]
            types = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields}
        except Exception as e:  # report and go on
            bad += 1
            print(f"ERROR {n}: {str(e)[:700]}", flush=True)
            continue
        t1 = time.time()
        if n not in ORACLES:
            print(f"rows  {n}: {len(rows)} rows {t1 - t0:.1f}s (no twin)", flush=True)
            continue
        try:
            rel = con.execute(ORACLES[n])
            dcols = [d[0] for d in rel.description]
            dtypes = {d[0]: family(str(d[1])) for d in rel.description}
            drows = rel.fetchall()
        except Exception as e:
            bad += 1
            print(f"ERROR {n} (sql): {str(e)[:600]}", flush=True)
            continue
        t2 = time.time()
        if sorted(dcols) != cols:
            bad += 1
            print(f"FAIL  {n}: columns {set(dcols) ^ set(cols)}", flush=True)
            continue
        at = [dcols.index(c) for c in cols]
        drows = [tuple(cell(row[i]) for i in at) for row in drows]
        key = lambda row: tuple("" if x is None else x for x in row)
        rows.sort(key=key)
        drows.sort(key=key)
        odd = {c: (types[c], dtypes[c]) for c in cols if types[c] != dtypes[c]}
        note = f" TYPES {odd}" if odd else ""
        if rows == drows:
            print(f"ok    {n}: {len(rows)} rows spark {t1 - t0:.1f}s duckdb {t2 - t1:.1f}s{note}", flush=True)
            if not rows:
                print(f"      {n} is EMPTY")
            continue
        bad += 1
        a, b = set(rows), set(drows)
        print(f"FAIL  {n}: {len(rows)} vs {len(drows)} rows, {len(a - b)} differ{note}", flush=True)
        only_a, only_b = sorted(a - b, key=key)[:2], sorted(b - a, key=key)[:2]
        print("   cols", cols)
        for x in only_a:
            print("   spark ", x)
        for x in only_b:
            print("   duckdb", x)
    print(f"{len(names)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
