"""Run registered queries and their SQL side by side and compare all values.

``python tests/compare.py [sf_dir] [query ...]``
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as contract  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def sql_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).to_arrow_table()


def canonical(table):
    """Columns by name, rows sorted, types loosened to families."""
    table = table.select(sorted(table.column_names))
    rows = [tuple(r.values()) for r in table.to_pylist()]
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def family(t) -> str:
    s = str(t)
    for name, prefixes in {"text": ("string", "large_string"), "time": ("timestamp",),
                           "whole": ("int", "uint"), "real": ("double", "float"),
                           "flag": ("bool",), "date": ("date",)}.items():
        if s.startswith(prefixes):
            return name
    return s


def differences(spark, name: str, sf_dir: str) -> list[str]:
    left = contract.queries()[name](spark, sf_dir).toArrow()
    right = sql_rows(sf_dir, contract.oracle_sql()[name])
    found = []
    if sorted(left.column_names) != sorted(right.column_names):
        return [f"columns {sorted(left.column_names)} / {sorted(right.column_names)}"]
    for c in left.column_names:
        a, b = left.schema.field(c).type, right.schema.field(c).type
        if str(a).replace("large_", "") != str(b).replace("large_", ""):
            found.append(f"type of {c}: {a} / {b}")
    a, b = canonical(left), canonical(right)
    if len(a) != len(b):
        found.append(f"rows {len(a)} / {len(b)}")
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        found.append(f"{len(bad)} rows differ, first {bad[0]}")
    return found


if __name__ == "__main__":
    from plumelake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", conf={
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[2:] or list(contract.queries())
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in contract.oracle_sql():
                found = differences(spark, name, sf_dir)
            else:
                n = contract.queries()[name](spark, sf_dir).count()
                found = [] if n else ["no rows"]
        except Exception as e:  # report and go on
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {time.time() - start:6.2f}s {name} {found or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
