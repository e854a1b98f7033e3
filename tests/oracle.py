"""Run a registered query and its SQL side by side and compare all rows."""

from __future__ import annotations

import datetime as dt
import glob
import os
import sys
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def kind(value):
    return type(value).__name__


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=repr
    )


def differences(spark, con, build, sql, sf_dir) -> list[str]:
    df = build(spark, sf_dir)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = canonical(names, result.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} vs {theirs[0]}"]
    found = []
    if len(ours[1]) != len(theirs[1]):
        found.append(f"rows {len(ours[1])} vs {len(theirs[1])}")
    for a, b in zip(ours[1], theirs[1]):
        if a != b or [kind(x) for x in a] != [kind(x) for x in b]:
            found.append(f"{a} vs {b}")
            if len(found) > 3:
                break
    return found


def main(sf_dir: str, only: list[str]) -> None:
    import time

    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls, bad = oracle_sql(), 0
    for key, build in queries().items():
        if only and key not in only:
            continue
        began = time.time()
        try:
            found = differences(spark, con, build, sqls[key], sf_dir)
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:900]}"]
        bad += bool(found)
        print("FAIL" if found else "ok", key, round(time.time() - began, 2), *found, sep="\n    " if found else " ", flush=True)
    print("failed:", bad, "of", len(only or queries()))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
