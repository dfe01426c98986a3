"""Run queries on Spark and DuckDB over the same files and compare all values."""

from __future__ import annotations

import argparse
import math
import time

import duckdb

from workload.queries import QUERIES
from workload.retail_views import BASE

VIEWS = (*BASE, "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in VIEWS:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if hasattr(value, "isoformat"):
        text = value.isoformat().replace("T", " ")
        return text[:-9] if text.endswith(" 00:00:00") else text
    if isinstance(value, (int, float)) or value.__class__.__name__ == "Decimal":
        return f"{float(value) + 0.0:.6f}"
    return str(value)


def rows_of(columns, records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in records)


def compare(spark, con, folder: str, name: str) -> tuple[str, int, float]:
    query = QUERIES[name]
    start = time.time()
    frame = query.frame(spark, folder)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    took = time.time() - start
    statement = query.statement()
    if statement is None:
        return "rows-only", len(got), took
    cursor = con.execute(statement)
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"COLUMNS {sorted(set(frame.columns) ^ set(columns))}", len(got), took
    if len(got) != len(want):
        return f"ROWS {len(got)} != {len(want)}", len(got), took
    different = [(g, w) for g, w in zip(got, want) if g != w]
    if different:
        g, w = different[0]
        cols = sorted(frame.columns)
        detail = [(c, a, b) for c, a, b in zip(cols, g, w) if a != b]
        return f"VALUES {len(different)} rows, first: {detail[:4]}", len(got), took
    return "ok", len(got), took


def main() -> None:
    from stocktally import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--folder", default="/root/testdata/sf0.001")
    parser.add_argument("--only", default="")
    args = parser.parse_args()
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.folder)
    bad = 0
    wanted = [n for n in QUERIES if not args.only or any(n.startswith(p) for p in args.only.split(","))]
    for name in wanted:
        try:
            status, rows, took = compare(spark, con, args.folder, name)
        except Exception as error:  # report and go on
            status, rows, took = "ERROR " + str(error).replace("\n", " ")[:700], 0, 0.0
        bad += status not in ("ok", "rows-only")
        print(f"{name:45s} {rows:7d} {took:6.1f}s {status}", flush=True)
    print(f"{len(wanted)} queries, {bad} not ok")


if __name__ == "__main__":
    main()
