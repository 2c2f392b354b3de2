"""Run registered queries and their SQL side by side: python tests/compare.py [sf] [name ...]."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if value != value else (0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(con, df, sql: str) -> str | None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    want = rows_of(names, result.fetchall())
    have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(have):
        return f"{len(have)} rows / {len(want)} rows"
    bad = [(h, w) for h, w in zip(have, want) if h != w]
    return f"{len(bad)} of {len(want)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    from pyspark.sql import SparkSession

    from tabveil.catalog import registered

    args = sys.argv[1:]
    sf = args.pop(0) if args else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    for name, (run, sql) in registered().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if sql is None:
                verdict = f"{df.count()} rows, no SQL"
            else:
                verdict = difference(con, df, sql) or "equal"
        except Exception as e:  # noqa: BLE001
            verdict = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.1f} s  {verdict}", flush=True)


if __name__ == "__main__":
    main()
