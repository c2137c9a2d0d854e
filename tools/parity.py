"""Run registry queries and compare each with its SQL in DuckDB.

    python tools/parity.py [--sf DIR] [--module NAME] [query ...]
"""

from __future__ import annotations

import argparse
import importlib
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from linegauge.registry.base import QUERIES  # noqa: E402
from linegauge.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(cell(x) for x in v) + "]"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark_cols, spark_rows, sql_cols, sql_rows) -> str | None:
    a, b = rows_of(spark_cols, spark_rows), rows_of(sql_cols, sql_rows)
    if a[0] != b[0]:
        return f"columns {a[0]} vs {b[0]}"
    if len(a[1]) != len(b[1]):
        return f"rows {len(a[1])} vs {len(b[1])}"
    bad = [(x, y) for x, y in zip(a[1], b[1]) if x != y]
    return f"{len(bad)} rows differ, columns {a[0]}, first {bad[0][0]} vs {bad[0][1]}" if bad else None


def types_differ(df, cur) -> str:
    """Column types that are of another kind on the two sides."""
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp": "TIMESTAMP"}
    sql = {d[0]: str(d[1]) for d in cur.description}
    return ", ".join(f"{f.name}:{f.dataType.simpleString()}/{sql[f.name]}" for f in df.schema.fields
                     if f.name in sql and kinds.get(f.dataType.simpleString()) != sql[f.name])


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--module", action="append")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    if args.module:
        for m in args.module:
            importlib.import_module(f"linegauge.registry.{m}")
    else:
        from linegauge.registry import load_all
        load_all()
    names = args.names or list(QUERIES)
    spark = build_session("parity", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    failed = 0
    for name in names:
        q = QUERIES[name]
        start = time.time()
        try:
            df = q.run(spark, args.sf)
            rows = df.collect()
            took = time.time() - start
            if q.oracle is None:
                print(f"rows  {name:32s} {took:6.2f}s {len(rows)} rows", flush=True)
                continue
            t1 = time.time()
            cur = con.execute(q.oracle)
            extra = types_differ(df, cur)
            cols = [d[0] for d in cur.description]
            problem = compare(df.columns, rows, cols, cur.fetchall())
            sql_took = time.time() - t1
        except Exception as err:  # report and go on
            print(f"ERROR {name}: {type(err).__name__} {str(err)[:900]}", flush=True)
            failed += 1
            continue
        failed += problem is not None
        print(f"{'ok   ' if problem is None else 'DIFF '} {name:32s} {took:6.2f}s sql {sql_took:5.2f}s {len(rows)} rows"
              f" {('types ' + extra) if extra else ''} {problem or ''}", flush=True)
    print(f"{failed} failed of {len(names)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
