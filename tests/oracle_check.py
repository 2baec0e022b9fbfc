"""Compare registered queries with their DuckDB statements.

    python tests/oracle_check.py <data folder> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted(
        (tuple(_plain(r[i]) for i in at) for r in rows), key=repr
    )


def compare(spark, con, folder: str, name: str, make, sql: str) -> str | None:
    """None when equal, else what differs."""
    frame = make(spark, folder)
    got_cols, got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w or list(map(type, g)) != list(map(type, w))]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0][0]} != {bad[0][1]}"
    return None


def main() -> int:
    import __spark_entry__ as entry

    from tillwise.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracle:
                found = compare(spark, con, folder, name, queries[name], oracle[name])
                verdict = found or "equal"
                failed += found is not None
            else:
                verdict = f"rows only: {len(queries[name](spark, folder).collect())}"
        except Exception as error:  # noqa: BLE001
            failed += 1
            verdict = "ERROR " + str(error).split("JVM stacktrace")[0][:900]
            if names:
                traceback.print_exc()
        print(f"{name:28s} {time.time() - start:6.1f}s {verdict}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    raise SystemExit(main() > 0)
