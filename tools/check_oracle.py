"""Local correctness check: every registered query against its DuckDB SQL.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
Compares row count, column names and types, and an order-insensitive multiset
of rows.
"""
import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])
from veilset import registry, samples  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
                 "float": "FLOAT", "binary": "BLOB", "smallint": "SMALLINT",
                 "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_diff(sdf, con, sql):
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
          for f in sdf.schema}
    dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {k: (st[k], dt.get(k)) for k in st if st[k] != dt.get(k)}


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    con = duckdb.connect()
    for t in samples.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = 0
    for name, fn in registry.QUERIES.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            continue
        ts = time.time() - t0
        sql = registry.ORACLE.get(name)
        if sql is None:
            print(f"rows {name}: {len(srows)} rows (no oracle) {ts:.2f}s")
            continue
        try:
            cur = con.execute(sql)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: duckdb error {str(e)[:300]}")
            continue
        problems = []
        if sorted(scols) != sorted(dcols):
            problems.append(f"columns {sorted(scols)} vs {sorted(dcols)}")
        else:
            td = type_diff(sdf, con, sql)
            if td:
                problems.append(f"types {td}")
        if len(srows) != len(drows):
            problems.append(f"rows {len(srows)} vs {len(drows)}")
        if not problems:
            a, b = rows_of(scols, srows), rows_of(dcols, drows)
            if a != b:
                diff = list((a - b).items())[:3], list((b - a).items())[:3]
                problems.append(f"values differ: spark-only {diff[0]} duck-only {diff[1]}")
        if problems:
            bad += 1
            print(f"FAIL {name}: " + "; ".join(problems))
        else:
            print(f"ok   {name}: {len(srows)} rows {ts:.2f}s")
    print(f"{bad} failing")
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
