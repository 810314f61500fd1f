"""Keyed tables on Parquet: a write with an existing key replaces the row."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.operators.keyed import latest_in_ranges, latest_per_key
from cardlens.schema import KeyedTable
from cardlens.sinks.files import MAX_RECORDS_PER_FILE, sorted_layout
from cardlens.sources.keyed import read_keyed
from cardlens.workspace import passing_shuffles, path_exists, remove_path, scratch_path, snapshot

NO_DAY = "unknown"


def keyless(table: KeyedTable) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in table.key])


def partition_value(table: KeyedTable) -> Column:
    if table.time:
        return F.coalesce(F.date_format(table.time, table.time_format), F.lit(NO_DAY))
    spread = F.when(keyless(table), F.xxhash64(*table.fields)).otherwise(F.xxhash64(*table.key))
    return F.pmod(spread, F.lit(table.buckets)).cast("int")


def winner_order(table: KeyedTable) -> list[Column]:
    return [F.desc_nulls_last(c) for c in table.newest]


def one_per_key(df: DataFrame, table: KeyedTable, newest: list[Column]) -> DataFrame:
    """One row per key; a row that lacks a part of its key equals only rows with the same fields throughout.

    So no row is lost to another whose key is as unknown as its own, and such rows are
    dealt out by their content, not all to one task.
    """
    content = F.when(keyless(table), F.struct(*table.fields))
    return latest_per_key(df.withColumn("_content", content), (*table.key, "_content"), newest).drop("_content")


def upsert_keyed(df: DataFrame, table: KeyedTable, root: str, copied: bool = False) -> list:
    """Merge ``df`` into ``root/table``; rows of ``df`` win over stored ones.

    After the first write only folders that ``df`` touches are read and rewritten.  Spark writes the new folders beside the
    old ones and puts them in their place when all are written, so a run that fails before that leaves the table as it
    was, and running again gives the same table.  ``df`` is read more than once; it is copied to the shared folder first
    unless ``copied`` says that it reads a stored copy already.  Returns the touched folders' values.
    """
    spark = df.sparkSession
    typed = df.select([F.col(name).try_cast(kind).alias(name) for name, kind in table.fields.items()])
    placed = typed.withColumn(table.partition, partition_value(table))
    newest = winner_order(table)
    if not path_exists(spark, f"{root}/{table.name}"):
        _write(placed, table, root, newest)
        return _folders(read_keyed(spark, table, root), table)
    incoming_path = scratch_path(spark, "incoming")
    incoming = placed if copied else snapshot(placed, incoming_path)
    touched = _folders(incoming, table)
    stored = read_keyed(spark, table, root).where(F.col(table.partition).isin(touched))
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    _write(both, table, root, [F.desc("_new"), *newest])
    if not copied:
        remove_path(spark, incoming_path)
    return touched


def _folders(df: DataFrame, table: KeyedTable) -> list:
    """One value per folder: bounded by the calendar, or by the buckets, of the table."""
    return sorted(row[0] for row in df.select(table.partition).distinct().collect())


def _write(df: DataFrame, table: KeyedTable, root: str, newest: list[Column]) -> None:
    """The first row by ``newest`` of every key, into the folders that ``df`` has rows of; other folders stay."""
    laid = _by_time(df, table, newest) if table.time in table.key else _by_bucket(df, table, newest)
    writer = laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    with passing_shuffles(df.sparkSession):
        writer.option("compression", "zstd").partitionBy(table.partition).parquet(f"{root}/{table.name}")


def _by_bucket(df: DataFrame, table: KeyedTable, newest: list[Column]) -> DataFrame:
    """Many rows a key: every task sends one row of each, and the few that are left are gathered by folder."""
    key = tuple(c for c in table.key if c != table.partition)
    return sorted_layout(one_per_key(df, table, newest).drop("_new"), table.partition, key, ())


def _by_time(df: DataFrame, table: KeyedTable, newest: list[Column]) -> DataFrame:
    """Few rows a key: one shuffle by ranges of folder and key, in which copies meet, folders lie together and a large one is split."""
    key = [c for c in table.key if c not in (table.partition, table.time)]
    content = F.when(keyless(table), F.struct(*table.fields))
    spread = F.when(keyless(table), F.xxhash64(*table.fields))
    # newest first within a key, also where a range is sorted for ranking its copies
    marked = df.withColumns({"_spread": spread, "_back": -F.unix_micros(table.time)})
    ranges = [table.partition, *key, "_back", *(["_spread"] if any(df.schema[c].nullable for c in table.key) else [])]
    laid = latest_in_ranges(marked, ranges, [], [content], newest)
    names = list(dict.fromkeys([*table.fields, table.partition]))
    return laid.select(*names)
