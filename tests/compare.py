"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(round(value, 9) + 0.0)
    if isinstance(value, (bytearray, bytes)):
        return bytes(value).hex()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """None if equal, else a text that says what differs."""
    df = query(spark, sf_dir)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    right = rows_of([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows / {len(right[1])}"
    if not left[1]:
        return "no rows"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"{left[0]}\n   spark {a}\n   sql   {b}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from harkline.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = duck(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted or name not in oracle:
            continue
        began = time.time()
        try:
            problem = compare(spark, con, name, query, oracle[name], sf_dir)
        except Exception as failure:
            problem = f"{type(failure).__name__}: {str(failure)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
