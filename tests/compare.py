"""Row comparison of the registered queries with their SQL."""

from __future__ import annotations

import math
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_tables(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return str(value)
    return f"{type(value).__name__}:{value}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, con, build, sql, folder) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    frame = build(spark, folder)
    mine = frame.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    a, b = rows_of(frame.columns, mine), rows_of(names, theirs)
    if a != b:
        known_a, known_b = set(a), set(b)
        only_a = [r for r in a if r not in known_b][:3]
        only_b = [r for r in b if r not in known_a][:3]
        return f"{len(a)} against {len(b)} rows; only Spark {only_a}; only SQL {only_b}"
    return None
