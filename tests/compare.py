"""Run catalog queries beside their SQL twins and compare the whole results."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cur = con.execute(sql)
    return canonical([d[0] for d in cur.description], cur.fetchall())


def difference(got, want):
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return None
    want_set, got_set = set(want[1]), set(got[1])
    extra = [str(r) for r in got[1] if r not in want_set][:1] or [""]
    missing = [str(r) for r in want[1] if r not in got_set][:1] or [""]
    same = len(os.path.commonprefix([extra[0], missing[0]]))
    start = max(0, same - 60)
    return (
        f"rows {len(got[1])} vs {len(want[1])}\n   spark: ...{extra[0][start : start + 250]!r}"
        f"\n   sql:   ...{missing[0][start : start + 250]!r}"
    )


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry_module

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    failed = []
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        started = time.time()
        try:
            got = spark_result(fn(spark, sf_dir))
            took = time.time() - started
            verdict = f"rows-only {len(got[1])} {got[0]}"
            if name in oracles:
                diff = difference(got, duck_result(con, oracles[name]))
                verdict = f"ok {len(got[1])}" if diff is None else "DIFF " + diff
        except Exception as error:  # report and go on with the next query
            took, verdict = time.time() - started, "ERROR " + str(error)[:1500]
        if verdict.startswith(("DIFF", "ERROR")):
            failed.append(name)
        print(f"{name:28s} {took:6.2f}s  {verdict}", flush=True)
    print("FAILED:", failed)


if __name__ == "__main__":
    main()
