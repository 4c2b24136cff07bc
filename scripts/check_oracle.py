"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python scripts/check_oracle.py [SF_DIR] [name ...]
Mirrors the driver's check: row count, column names, and an
order-insensitive comparison of values (doubles rounded to 6 places).
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

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None or v is getattr(__import__("pandas"), "NaT", None):
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return norm(v.item())
        except Exception:
            pass
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    from sightline.plans import ORACLE, QUERIES
    from sightline.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    names = names or sorted(QUERIES)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sdf = QUERIES[n](spark, sf)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
            stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {str(e)[:800]}")
            bad += 1
            continue
        ts = time.time() - t0
        if n not in ORACLE:
            print(f"SKIP {n}: no oracle, spark rows={len(srows)} ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(ORACLE[n])
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
            dtypes = {d[0]: str(d[1]) for d in cur.description}
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:800]}")
            bad += 1
            continue
        msgs = []
        if sorted(scols) != sorted(dcols):
            msgs.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
        if len(srows) != len(drows):
            msgs.append(f"rows spark={len(srows)} duck={len(drows)}")
        if not msgs:
            a, b = rows_of(scols, srows), rows_of(dcols, drows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                msgs.append(f"values differ, e.g. {diff}")
        tmap = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
                "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT", "binary": "BLOB"}
        tdiff = {c: (stypes[c], dtypes.get(c)) for c in stypes
                 if tmap.get(stypes[c], stypes[c]) != dtypes.get(c)}
        if msgs:
            bad += 1
            print(f"FAIL {n}: " + "; ".join(msgs)[:1500])
        else:
            print(f"OK   {n}: rows={len(srows)} ({ts:.1f}s)" + (f" TYPES {tdiff}" if tdiff else ""))
    print(f"{bad} failing of {len(names)}")
    spark.stop()


if __name__ == "__main__":
    main()
