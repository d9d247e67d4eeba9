"""Run registered queries against their SQL on DuckDB and compare whole results.

    python tests/oracle_check.py [--sf 0.01] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

import __spark_entry__ as entry
from gaugeworks.session import build_session

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
         "date": "DATE", "float": "FLOAT"}


def _cell(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def connection(folder: str):
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def compare(spark, con, folder, name, make, sql) -> str:
    df = make(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows {len(got)}"
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    want = rows_of(cols, rel.fetchall())
    if sorted(cols) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} != {sorted(cols)}"
    if got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b][:3]
        return f"FAIL values: {len(got)} vs {len(want)} rows; {bad}"
    off = {c: (t, kinds[c]) for c, t in df.dtypes if TYPES.get(t, t) != kinds[c]}
    return f"ok {len(got)}" + (f" TYPES {off}" if off else "")


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session(master="local[8]", shuffle_partitions=8,
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connection(folder), entry.oracle_sql(), 0
    for name, make in entry.queries().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            said = compare(spark, con, folder, name, make, sql.get(name))
        except Exception as exc:  # noqa: BLE001
            said = f"FAIL {type(exc).__name__}: {str(exc)[:600]}"
        bad += said.startswith("FAIL")
        print(f"{name:42s} {time.time() - start:6.2f}s {said}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
