"""Set operations and last-write-wins rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.schema import CUSTOMER_COLUMNS


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column absent from one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def customer_rows(df: DataFrame, columns: tuple[str, ...] = CUSTOMER_COLUMNS) -> DataFrame:
    """The cardholder's columns of every row."""
    casts = {"zip": F.col("zip").cast("string"), "dob": F.col("dob").try_cast("timestamp")}
    return df.select([casts.get(c, F.col(c)).alias(c) for c in columns])


def customer_dim(df: DataFrame, columns: tuple[str, ...] = CUSTOMER_COLUMNS) -> DataFrame:
    """Distinct cardholder rows; a card whose details differ between rows appears several times."""
    return customer_rows(df, columns).distinct()


def latest_per_key(df: DataFrame, key: tuple[str, ...], newest: list[Column]) -> DataFrame:
    """One row per key, the first by ``newest``.

    The rank filter becomes a group limit on both sides of the shuffle: every task
    sends at most one row per key, however many copies it holds.
    """
    order = Window.partitionBy(*key).orderBy(*newest)
    return df.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def latest_in_ranges(df: DataFrame, ranges: list[str], places: list[str], identity: list[Column], newest: list[Column]) -> DataFrame:
    """One row per key, the first by ``newest``, dealt out by ranges of the key and sorted by ``places``, or by the ranges: one shuffle for both.

    ``ranges`` are columns that are equal for rows of one key, so those meet in one range; ``places`` are columns that follow from
    them, and ``identity`` is what else tells keys apart.  For keys with few copies each: copies meet after the shuffle only.
    """
    dealt = df.repartitionByRange(*ranges)
    order = Window.partitionBy(*places, *ranges, *identity).orderBy(*newest)
    return dealt.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place").sortWithinPartitions(*places or ranges)
