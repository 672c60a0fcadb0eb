"""Run registered queries next to their SQL in DuckDB and compare all rows.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import queries
from checks.oracles import oracle_sql
from checks.views import TABLES

ALLOWED = {"BIGINT", "DOUBLE", "VARCHAR"}


def normal(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return db


def compare(spark: SparkSession, db: duckdb.DuckDBPyConnection, folder: str, name: str) -> str:
    """'' when equal, else what differs."""
    result = queries()[name](spark, folder)
    ours = rows_of(result.columns, [tuple(r) for r in result.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        return ""
    answer = db.execute(sql)
    columns = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    theirs = rows_of(columns, answer.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(columns)}"
    odd = {c: k for c, k in kinds.items() if k not in ALLOWED and not _known(k)}
    if odd:
        return f"types {odd}"
    if ours != theirs:
        left, right = list((ours - theirs).elements()), list((theirs - ours).elements())
        return (
            f"rows {sum(ours.values())} vs {sum(theirs.values())}, only ours {len(left)} {left[:2]}, "
            f"only sql {len(right)} {right[:2]}; columns {sorted(columns)}"
        )
    if not ours:
        return "both empty"
    return ""


def _known(kind: str) -> bool:
    return kind.upper() in ALLOWED or kind.upper() in ("NUMBER", "STRING")


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("tallyhouse")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark, db, failed = session(), connect(folder), 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, db, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.2f}s {problem}", flush=True)
    missing = set(queries()) - set(oracle_sql())
    print(f"{len(names) - failed}/{len(names)} equal; without SQL: {sorted(missing)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
