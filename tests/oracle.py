"""Run registered queries in Spark and their SQL in DuckDB and compare rows, column names and types."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (bool, str, dt.date)):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return float(f"{float(v):.9g}") + 0.0
    return str(v)


def _rows(names, rows, floats):
    order = sorted(range(len(names)), key=lambda i: (names[i] in floats, names[i]))
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is not None, str(x)) for x in t))


def _same(a, b, tolerance: float) -> bool:
    return len(a) == len(b) and all(x == y or (isinstance(x, float) and isinstance(y, float)
                                               and math.isclose(x, y, rel_tol=tolerance, abs_tol=tolerance)) for x, y in zip(a, b))


def compare(con, df, sql: str, tolerance: float = 0.0) -> list[str]:
    """Differences between a Spark result and an SQL result, empty when they agree."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    floats = {n for n, kind in df.dtypes if kind == "double"}
    theirs = _rows(names, found.fetchall(), floats)
    described = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    ours = _rows(df.columns, [tuple(r) for r in df.collect()], floats)
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if TYPES.get(kind, kind) != described[name]:
            out.append(f"type of {name}: {kind} != {described[name]}")
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} != {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs) if not _same(a, b, tolerance)]
    if bad:
        out.append(f"{len(bad)} rows differ, first: {bad[0]}")
    if not ours:
        out.append("no rows")
    return out


def main(sf: str, names: list[str]) -> int:
    from panelkit.session import build_session
    from workload.queries import ORACLE, QUERIES
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("oracle", "local[8]", 8, **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name, fn in QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            diff = compare(con, df, ORACLE[name]) if name in ORACLE else ([] if df.collect() else ["no rows"])
        except Exception as e:  # report and go on
            diff = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {time.time() - start:6.2f}s {name}{' (rows only)' if name not in ORACLE else ''}",
              *[f"\n       {d}" for d in diff], flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
