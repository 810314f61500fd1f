"""Transactions from CSV and Parquet files."""

from __future__ import annotations

import csv as csv_text

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens.operators.features import drop_index_columns
from cardlens.operators.keyed import union_all
from cardlens.schema import INDEX_COLUMNS, STRING, TRANSACTION_FIELDS
from cardlens.workspace import snapshot

CORRUPT = "_corrupt_record"
CSV_FOLDERS = ("dataset", "data")  # fixed values: where the files are looked for


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line alone; types are never inferred from the data."""
    first = spark.read.text(path).head()
    return next(csv_text.reader([first.value])) if first else []


def read_transactions_csv(
    spark: SparkSession, *paths: str, strict_header: bool = True, keep_corrupt: bool = False
) -> DataFrame:
    """CSV with a header and the record's fixed types, any column order, files unioned by name.

    Fixed types keep leading zeros of ``zip`` and spare the pass that inference
    takes.  Columns are read by place under the first file's header; Spark checks every
    file's header against it, so that a folder of files in different orders is an error
    and not swapped columns (name such files as paths of their own).  Without
    ``strict_header`` that check is left out.  ``keep_corrupt`` adds ``_corrupt_record``, NULL for good lines.
    """
    return union_all(*[_read_one(spark, path, strict_header, keep_corrupt) for path in paths])


def _read_one(spark: SparkSession, path: str, strict_header: bool, keep_corrupt: bool) -> DataFrame:
    return drop_index_columns(read_under_header(spark, _header(spark, path), path, strict_header, keep_corrupt))


def read_under_header(
    spark: SparkSession, names: list[str], path: str | list[str], strict_header: bool, keep_corrupt: bool
) -> DataFrame:
    """Files that have ``names`` as their header, with the record's types and text for what the record does not know."""
    unnamed = {"": INDEX_COLUMNS[0]}
    as_named = names if strict_header else [unnamed.get(name, name) for name in names]
    fields = [T.StructField(name, TRANSACTION_FIELDS.get(name, STRING), True) for name in as_named]
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", not strict_header)
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT, STRING, True))
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.schema(T.StructType(fields)).csv(path)
    return df.withColumnsRenamed({name: known for name, known in unnamed.items() if name in df.columns})


def csv_sources(spark: SparkSession, *names: str):
    """Loaders that try the same file names under each known folder."""
    return [lambda folder=folder: read_transactions_csv(spark, *[f"{folder}/{n}" for n in names]) for folder in CSV_FOLDERS]


def split_corrupt(df: DataFrame, *origin: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the raw text of lines that did not fit the schema, with the columns in ``origin`` that say where they are from.

    The parsed rows are written once and both sides read that copy: Spark parses only
    the columns a query asks for, and which lines are bad must not depend on the query.
    """
    df = snapshot(df)
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT, *origin)
    bad = df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, *origin)
    return good, bad


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def register(df: DataFrame, name: str = "transactions") -> DataFrame:
    """Name the table for SQL text."""
    df.createOrReplaceTempView(name)
    return df
