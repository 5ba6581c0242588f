"""Run a query and its SQL side by side and compare schema, row count and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if hasattr(value, "asDict"):
        return tuple(value)
    if isinstance(value, list):
        return tuple(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame, connection, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    cursor = connection.execute(sql)
    theirs_names = [d[0] for d in cursor.description]
    theirs_types = {d[0]: str(d[1]) for d in cursor.description}
    theirs = _rows(theirs_names, cursor.fetchall())
    ours = _rows(frame.columns, frame.collect())
    if sorted(frame.columns) != sorted(theirs_names):
        return f"columns {sorted(frame.columns)} != {sorted(theirs_names)}"
    kinds = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP",
    }
    wrong = [
        f"{c}: {t} != {theirs_types[c]}" for c, t in frame.dtypes if kinds.get(t, t) != theirs_types[c]
    ]
    if ours != theirs:
        return (
            f"rows {ours.total()} != {theirs.total()}; only here "
            f"{list((ours - theirs).items())[:3]}; only there {list((theirs - ours).items())[:3]}"
        )
    return f"types {wrong}" if wrong else None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from refinery.session import local_session

    folder = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    chosen = sys.argv[2:]
    spark, oracle = local_session(), open_oracle(folder)
    sqls, bad = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            frame = build(spark, folder)
            found = difference(frame, oracle, sqls[name]) if name in sqls else f"rows {frame.count()}"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__} {str(error)[:600]}"
        ok = found is None or name not in sqls
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print("bad:", bad)
