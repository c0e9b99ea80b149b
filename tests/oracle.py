"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time
from collections import Counter

import duckdb


SPARK_SECONDS: list[float] = []


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = int(value) if value == int(value) else float(value)
    if isinstance(value, float) and value == int(value):
        return int(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, folder: str, run, sql: str) -> str | None:
    begin = time.time()
    df = run(spark, folder)
    ours = rows_of(df.columns, df.collect())
    SPARK_SECONDS.append(time.time() - begin)
    cursor = duck(folder).execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if ours == theirs:
        return None
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{sorted(names)}: {sum(ours.values())} against {sum(theirs.values())} rows; "
        f"{sum(extra.values())} only here, e.g. {str(next(iter(extra), None))[:400]}; "
        f"{sum(missing.values())} only in SQL, e.g. {str(next(iter(missing), None))[:400]}"
    )


def main() -> None:
    from corpusflow.checks import ORACLES, QUERIES
    from corpusflow.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session(master="local[8]", **settings)
    spark.sparkContext.setLogLevel("OFF")
    for name, run in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        begin = time.time()
        try:
            if name in ORACLES:
                verdict = difference(spark, folder, run, ORACLES[name]) or "equal"
            else:
                verdict = f"rows {run(spark, folder).count()}"
        except Exception as failure:
            verdict = f"FAILED {str(failure)[:700]}"
        print(f"{name:24s} {time.time() - begin:6.1f}s spark {sum(SPARK_SECONDS[-1:]):6.1f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
