"""Writes to an external store that can be resumed: rows in chunks, a ledger of the chunks that are stored, bounded retries.

What the store raises is told from what this program gets wrong: only the former is tried again or leads to the fallback.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.sinks.files import write_parquet, write_store
from cardlens.workspace import list_files, path_exists, put_text, remove_path

ATTEMPTS = 3
WAIT = 1.0
CHUNKS = 16
CHUNK = "_chunk"
NOT_FOUND = "DATA_SOURCE_NOT_FOUND"
STORE_ERRORS = (PySparkException, Py4JJavaError, OSError)


def with_retries(write: Callable[[], None], attempts: int = ATTEMPTS, wait: float = WAIT, sleep: Callable[[float], None] = time.sleep) -> int:
    """Run ``write`` until it succeeds, at most ``attempts`` times, with waits that double; returns how many tries it took.

    A write that Spark refuses to plan, as for a connector that is not there, will not do better the next time and is not repeated.
    """
    for attempt in range(1, attempts + 1):
        try:
            write()
            return attempt
        except STORE_ERRORS as error:
            if attempt == attempts or isinstance(error, AnalysisException) or NOT_FOUND in str(error):
                raise
            sleep(wait * 2 ** (attempt - 1))
    raise ValueError("attempts must be at least 1")


def write_chunks(
    df: DataFrame,
    ledger: str,
    write_chunk: Callable[[DataFrame, int], None],
    chunks: int = CHUNKS,
    key: tuple[str, ...] = (),
    attempts: int = ATTEMPTS,
    wait: float = WAIT,
) -> list[int]:
    """Write ``df`` by ``write_chunk(rows, number)``, chunk by chunk; returns the numbers of the chunks that this run wrote.

    Rows are dealt out by a hash of ``key`` (of all columns without one) and put down below ``ledger`` first, without a shuffle, so that a
    run that goes on after a failure writes the same rows; ``df`` is then not looked at again.  A chunk in the ledger is not written again.
    One that failed is, as a whole: where the store's connector commits a write at once, every row is there once, else the store must
    replace rows by key.  When all chunks are stored the rows put down are removed; the ledger stays, and a write with it does nothing.
    """
    spark, rows, done = df.sparkSession, f"{ledger}/rows", f"{ledger}/done"
    if not path_exists(spark, f"{ledger}/planned"):
        number = F.pmod(F.xxhash64(*(key or df.columns)), F.lit(chunks)).cast("int")
        df.withColumn(CHUNK, number).write.mode("overwrite").partitionBy(CHUNK).parquet(rows)
        put_text(spark, f"{ledger}/planned", str(chunks))
    chunks = int(spark.read.text(f"{ledger}/planned").head()[0])
    stored = {path.rsplit("/", 1)[-1] for path in list_files(spark, done)}
    written = []
    for number in range(chunks):
        name, path = f"{number:05d}", f"{rows}/{CHUNK}={number}"
        if name in stored:
            continue
        if path_exists(spark, path):
            part = spark.read.schema(df.schema).parquet(path)
            with_retries(lambda part=part, number=number: write_chunk(part, number), attempts, wait)
            written.append(number)
        put_text(spark, f"{done}/{name}", "")
    remove_path(spark, rows)
    return written


def export_table(
    df: DataFrame, name: str, root: str, fmt: str, chunks: int = CHUNKS, attempts: int = ATTEMPTS, wait: float = WAIT, **options: str
) -> str:
    """Append a table to an external store, and to ``root/fallback/name`` as Parquet if the store refuses; returns which of them it was.

    Each table has a ledger of its own below ``root``, so one that is refused does not stop the others, and running again
    goes on where the store failed.  The fallback holds the whole table.
    """
    try:
        write_chunks(df, f"{root}/ledger/{name}", lambda rows, _: write_store(rows, fmt, **options), chunks, attempts=attempts, wait=wait)
        return "primary"
    except STORE_ERRORS:
        write_parquet(df, f"{root}/fallback/{name}")
        return "fallback"
