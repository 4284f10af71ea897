"""Compare registered queries with their SQL: python tools/check.py [sf_dir] [name ...]."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from cartlake.catalog import ORACLES, QUERIES  # noqa: E402
from cartlake.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return columns, cur.fetchall()


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = [tuple(repr(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(text)


def compare(spark, sf_dir: str, name: str) -> str:
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return f"rows-only ({len(rows)})" if rows else "EMPTY"
    got = canonical(df.columns, rows)
    want = canonical(*oracle_rows(sf_dir, ORACLES[name]))
    if got[0] != want[0]:
        return f"COLUMNS differ: {sorted(set(got[0]) ^ set(want[0]))}"
    if len(got[1]) != len(want[1]):
        return f"ROWS differ: spark {len(got[1])} sql {len(want[1])}"
    for mine, theirs in zip(got[1], want[1]):
        if mine != theirs:
            bad = [(c, a, b) for c, a, b in zip(got[0], mine, theirs) if a != b]
            return f"VALUES differ: {bad[:4]}"
    return f"ok ({len(rows)})" if rows else "EMPTY"


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.001"
    spark = build_session(
        "check", "local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in QUERIES:
        if args and not any(name.startswith(a) for a in args):
            continue
        began = time.time()
        try:
            verdict = compare(spark, sf_dir, name)
        except Exception as exc:  # report and go on with the next query
            traceback.print_exc(limit=3) if len(args) else None
            verdict = f"ERROR {type(exc).__name__}: {str(exc)[:600]}"
        failed += not verdict.startswith(("ok", "rows-only"))
        print(f"{name:34s} {time.time() - began:6.2f}s  {verdict}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
