"""One atomic write per table; Spark retries lost tasks itself."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RECORDS_PER_FILE = 5_000_000


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(*partition_by).parquet(path)


def sorted_layout(df: DataFrame, partition: str, key: tuple[str, ...], newest: tuple[str, ...]) -> DataFrame:
    """Rows gathered by folder, newest first within a key.

    REBALANCE lets adaptive execution split a folder that holds most of the rows
    over several tasks and merge small ones, which a plain repartition would not.
    """
    order = [F.asc(partition), *[F.asc(c) for c in key], *[F.desc(c) for c in newest]]
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(*order)


def write_with_fallback(write: Callable[[], None], fallback: Callable[[], None]) -> str:
    """Run ``write``; if the store refuses it as a whole, run ``fallback``.  Errors of the program itself are raised."""
    try:
        write()
        return "primary"
    except (PySparkException, Py4JJavaError, OSError):
        fallback()
        return "fallback"


def write_store(df: DataFrame, fmt: str, mode: str = "append", **options: str) -> None:
    """Write through an external store's connector."""
    df.write.format(fmt).options(**options).mode(mode).save()
