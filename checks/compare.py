"""Run queries next to their SQL and compare whole results: ``python -m checks.compare [sf_dir] [query ...]``."""

import math
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES
from placetally.session import build_session

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "" if value is None else f"{type(value).__name__}:{value}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_normal(row[i]) for i in order) for row in rows), sorted(columns)


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """None when both results are equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got, got_columns = _rows(df.columns, df.collect())
    cursor = connection.execute(ORACLES[name])
    want_columns = [d[0] for d in cursor.description]
    want, want_columns = _rows(want_columns, cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}: {set(got) ^ set(want)!s:.300}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ: {wrong[:2]}" if wrong else None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("compare", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                                        "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="placetally-"),
                                        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            problem = difference(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {error!s:.600}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
