"""Run registered queries next to their SQL and compare the rows.

    python tests/compare.py <sf_dir> [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, decimal.Decimal):
        return ("n", round(float(v), 9))
    if isinstance(v, (int, float, np.integer, np.floating)):
        return None if isinstance(v, float) and math.isnan(v) else ("n", round(float(v), 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    return v


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """What differs, or None."""
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} vs {sorted(names)}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} vs {sum(want.values())} rows; "
            f"only here {list(extra)[:2]}; only SQL {list(missing)[:2]}"
        )
    return None if got or name == "write_empty" else "no rows"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from tierwright.session import build_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql, failed = oracle_sql(), 0
    for name, query in queries().items():
        if (chosen and name not in chosen) or name not in sql:
            continue
        started = time.time()
        try:
            problem = compare(spark, con, name, query, sql[name], sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:24s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
