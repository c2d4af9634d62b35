"""Runs queries against their SQL twins: python tests/compare.py [sf] [name …]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float) and not math.isnan(v):
        return round(v, 9)
    return v


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same rows, else what differs."""
    got_rows = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = _rows(df.columns, got_rows), _rows(names, cur.fetchall())
    if got == want:
        return None
    extra = [r for r in got if r not in set(want)][:2] if len(got) < 5000 else []
    lack = [r for r in want if r not in set(got)][:2] if len(got) < 5000 else []
    return f"{len(got)} rows, expected {len(want)}; only here {str(extra)[:600]}; only there {str(lack)[:600]}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from feedmill.session import build_session

    sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(sf), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            df = run(spark, sf)
            told = difference(df, con, oracles[name]) if name in oracles else f"no oracle, {df.count()} rows"
        except Exception as error:
            told = f"{type(error).__name__}: {str(error)[:700]}"
        bad += told is not None
        print(f"{name:28} {time.time() - began:6.2f}s {told or 'ok'}", flush=True)
    print("different:", bad)
