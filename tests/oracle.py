"""Run registered queries beside their SQL in DuckDB. ``python -m tests.oracle SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(os.path.join(sf, "*.parquet"))):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.12g}") + 0.0
    if hasattr(value, "to_integral_value"):
        return int(value) if value == value.to_integral_value() else float(value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, sf, name, fn, sql):
    df = fn(spark, sf)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = sorted_rows([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for g, w in zip(got[1], want[1]):
        if g != w or [type(v) for v in g] != [type(v) for v in w]:
            return f"row {g} != {w}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    wanted = sys.argv[2:]
    queries, sqls = entry.queries(), entry.oracle_sql()
    con = connect(sf)
    bad = 0
    for name, fn in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, sf, name, fn, sqls[name])
                note = "ok" if problem is None else f"MISMATCH {problem}"
                rows = con.execute(f"SELECT COUNT(*) FROM ({sqls[name]})").fetchone()[0]
            else:
                rows = len(fn(spark, sf).collect())
                note = "rows only"
        except Exception as error:  # report and go on with the next query
            note, rows = f"ERROR {type(error).__name__}: {' '.join(str(error).split())[:300]}", -1
        bad += note.startswith(("MISMATCH", "ERROR"))
        print(f"{name:28s} {time.time() - start:6.2f}s rows={rows} {note}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
