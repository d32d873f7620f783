"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python tools/oracle_check.py [--sf DIR] [name ...]

Rows are compared as multisets after rounding floats to 6 places; column
names are compared sorted, as the driver does. Exit code 1 on any mismatch.
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "toArray"):
        return tuple(norm(float(x)) for x in v.toArray())
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                 "array<string>": "VARCHAR[]", "array<double>": "DOUBLE[]", "float": "FLOAT"}


def type_diff(schema, duck_rel) -> dict:
    """Columns whose Spark type and DuckDB type differ (after name mapping)."""
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in schema.fields}
    dt = {c: str(t) for c, t in zip(duck_rel.columns, duck_rel.types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def main():
    import duckdb

    from kiln.plans import catalog
    from kiln.session import local_session
    from kiln.sources.tables import TABLES

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", type=int, default=3)
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()

    spark = local_session(8, 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    names = a.names or sorted(catalog.QUERIES)
    bad = []
    for n in names:
        t0 = time.time()
        sdf = catalog.QUERIES[n](spark, a.sf)
        srows = sdf.collect()
        scols = sdf.columns
        ts = time.time() - t0
        sql = catalog.ORACLE.get(n)
        if sql is None:
            print(f"ROWS  {n:28s} spark={len(srows)} ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(sql)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"SQLERR {n}: {e}")
            bad.append(n)
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        tdiff = type_diff(sdf.schema, con.sql(sql))
        if tdiff:
            print(f"TYPES {n}: {tdiff}")
            bad.append(n)
        sr, dr = rows_of(scols, srows), rows_of(dcols, drows)
        ok = ok_cols and sr == dr
        tag = "OK   " if ok else "DIFF "
        print(f"{tag} {n:28s} spark={len(srows)} duck={len(drows)} ({ts:.1f}s)")
        if not ok:
            bad.append(n)
            if not ok_cols:
                print("   cols spark:", scols, "\n   cols duck: ", dcols)
            else:
                ds, dd = [r for r in sr if r not in set(dr)], [r for r in dr if r not in set(sr)]
                print("   spark-only:", ds[: a.show])
                print("   duck-only: ", dd[: a.show])
                print("   types spark:", [f.dataType.simpleString() for f in sdf.schema.fields])
    print("mismatches:", bad)
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
