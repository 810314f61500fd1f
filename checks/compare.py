"""Compare every registered query with its SQL: ``python -m checks.compare [folder] [name ...]``.

``CHECK_CONF`` may hold further session settings, ``name=value,name=value``.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def oracle_frame(sf_dir: str, sql: str) -> pd.DataFrame:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection.execute(sql).df()


def spark_frame(df: DataFrame) -> pd.DataFrame:
    """The rows of ``df``; whole numbers stay whole where some are null."""
    frame = df.toPandas()
    return frame.astype({name: "Int64" for name, kind in df.dtypes if kind in ("bigint", "int") and frame[name].isna().any()})


def _cell(value):
    if value is None or value is pd.NA or value is pd.NaT or value != value:
        return None
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return repr(value)
    return value


def normal_rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(_cell(v) for v in row) for row in frame.itertuples(index=False, name=None)), key=repr)


def differences(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """What is wrong with ``actual``, or None when it equals ``expected`` to the last bit."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} / {sorted(expected.columns)}"
    kinds = [
        (c, str(actual[c].dtype), str(expected[c].dtype))
        for c in sorted(actual.columns)
        if actual[c].dtype.kind != expected[c].dtype.kind and "O" not in (actual[c].dtype.kind, expected[c].dtype.kind)
    ]
    if kinds:
        return f"types {kinds}"
    got, want = normal_rows(actual), normal_rows(expected)
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    builder = SparkSession.builder.master("local[8]")
    for setting in filter(None, os.environ.get("CHECK_CONF", "").split(",")):
        builder = builder.config(*setting.split("=", 1))
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            actual = spark_frame(QUERIES[name](spark, sf_dir))
            took = time.time() - start
            problem = differences(actual, oracle_frame(sf_dir, ORACLE[name])) if name in ORACLE else None
            note = "rows only" if name not in ORACLE else "equal"
        except Exception as error:
            actual, took, problem, note = [], time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += problem is not None
        print(f"{name:24s} {len(actual):7d} rows {took:6.2f}s  {problem or note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(main(arguments[0] if arguments else "/root/testdata/sf0.01", arguments[1:]) > 0)
