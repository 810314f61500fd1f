"""Data quality: missing values, modes, value counts, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Columns of the missing-value report.
REPORTED_COLUMNS = ("cc_num", "merchant", "category", "amt", "city", "state")


def describe(df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, col_name string, data_type string")


def preview(df: DataFrame, n: int, *order_by) -> DataFrame:
    """The first ``n`` rows in a stated order, so that the answer is the same every time."""
    return df.orderBy(*order_by).limit(n)


def missing_values(df: DataFrame, columns: tuple[str, ...] = REPORTED_COLUMNS) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])


def _counted_values(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(column, value, n) for several columns from one scan."""
    return (
        df.select([F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def column_modes(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Most frequent value per column; the smaller value wins a tie.

    A column in which NULL is the most frequent is left out.
    """
    place = F.struct((-F.col("n")).alias("fewer"), F.col("value").isNull().alias("missing"), F.col("value"))
    return (
        _counted_values(df, columns)
        .groupBy("column")
        .agg(F.min(place).alias("top"))
        .select("column", F.col("top.value").alias("value"), (-F.col("top.fewer")).alias("n"))
        .where(F.col("value").isNotNull())
    )


def impute_modes(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Fill NULLs with each column's mode.

    The modes enter as one scalar subquery, computed once for all columns; there
    is no join and nothing passes through the driver.
    """
    modes = column_modes(df, columns).agg(
        F.struct(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns]).alias("modes")
    )
    found = modes.scalar()
    return df.withColumns({c: F.coalesce(F.col(c), found[c].cast(df.schema[c].dataType)) for c in columns})


def value_counts(df: DataFrame, columns: tuple[str, ...], k: int = 10) -> DataFrame:
    """The ``k`` most frequent values per column.

    Spark cuts each task's rows to ``k`` per column before the shuffle
    (WindowGroupLimit), so a column of many values does not meet in one task.
    """
    best_first = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return (
        _counted_values(df, columns)
        .where(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
    )


def table_profile(df: DataFrame) -> DataFrame:
    """Rows and NULLs per column, from one aggregation."""
    columns = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counts.unpivot("_rows", columns, "column", "nulls").select("column", F.col("_rows").alias("rows"), "nulls")


def approx_distinct(df: DataFrame, column: str = "cc_num", rsd: float = 0.02) -> DataFrame:
    """Cheap estimate of the number of keys; a fixed-size sketch per task."""
    return df.agg(F.approx_count_distinct(column, rsd).alias(f"approx_{column}"))


def table_counts(df: DataFrame) -> DataFrame:
    """Total, fraud and non-fraud rows in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud_rows"),
        F.count_if(F.col("is_fraud") == 0).alias("non_fraud_rows"),
    )
