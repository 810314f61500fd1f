"""Cleaning, conforming and feature columns, shared by training and serving."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens.functions import age_years, euclid_deg, haversine_km, parse_date, parse_time, trans_hour
from cardlens.schema import DOUBLE, HISTORY_FIELDS, INDEX_COLUMNS, TIME_FORMAT, TRANSACTION_FIELDS

# What a missing column or a missing number is replaced with.
DEFAULTS = {
    "amt": 0.0,
    "city_pop": 0.0,
    "lat": 0.0,
    "long": 0.0,
    "merch_lat": 0.0,
    "merch_long": 0.0,
    "age": 30.0,
    "trans_hour": 0.0,
    "label": 0.0,
}
RAW_NUMERICS = ("amt", "city_pop", "lat", "long", "merch_lat", "merch_long")
MODEL_NUMERICS = ("amt", "distance", "age", "trans_hour", "city_pop", "lat", "long")
MODEL_CATEGORICALS = ("category", "gender")


def drop_index_columns(df: DataFrame) -> DataFrame:
    return df.drop(*INDEX_COLUMNS)


def conform(
    df: DataFrame,
    types: dict[str, T.DataType] | None = None,
    defaults: dict[str, float] | None = None,
) -> DataFrame:
    """Cast present columns to ``types`` and add absent ones with their default.

    A value that does not fit its type becomes NULL.  Absent columns without a
    default are added as NULL; ``defaulted_columns`` tells which were absent.
    """
    types = TRANSACTION_FIELDS if types is None else types
    defaults = DEFAULTS if defaults is None else defaults
    present = {name: _as_type(df, name, kind) for name, kind in types.items() if name in df.columns}
    absent = {name: F.lit(defaults.get(name)).cast(types[name]) for name in defaulted_columns(df, types)}
    return df.withColumns({**present, **absent})


def _as_type(df: DataFrame, name: str, kind: T.DataType) -> Column:
    column, found = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(found, (T.TimestampType, T.TimestampNTZType)) and isinstance(kind, T.StringType):
        return F.date_format(column, TIME_FORMAT)  # a cast would keep fractions that the format does not have
    return column.try_cast(kind)


def defaulted_columns(df: DataFrame, types: dict[str, T.DataType] | None = None) -> list[str]:
    types = TRANSACTION_FIELDS if types is None else types
    return [name for name in types if name not in df.columns]


def _as_time(df: DataFrame, name: str, parse) -> Column:
    """Parse ``name`` where it is text; a date or timestamp column is used as it is."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse(F.col(name))
    return F.col(name).cast("timestamp")


def with_trans_time(df: DataFrame) -> DataFrame:
    if "trans_time" in df.columns or "trans_date_trans_time" not in df.columns:
        return df
    return df.withColumn("trans_time", _as_time(df, "trans_date_trans_time", parse_time))


def enrich(df: DataFrame, as_of: datetime.date | str | None = None) -> DataFrame:
    """Import-side derivation: parsed times, whole-year age, great-circle km."""
    df = with_trans_time(drop_index_columns(df))
    return df.withColumn("dob_parsed", _as_time(df, "dob", parse_date)).withColumns(
        {
            "age": age_years(F.col("dob_parsed"), as_of),
            "distance": haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long")),
        }
    )


def history_rows(enriched: DataFrame) -> DataFrame:
    """The columns and types of the two history tables."""
    return enriched.select([F.col(name).try_cast(kind).alias(name) for name, kind in HISTORY_FIELDS.items()])


def fraud_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_fraud") == 1)


def non_fraud_rows(df: DataFrame) -> DataFrame:
    """Rows labelled 0.  A missing label belongs to neither side."""
    return df.where(F.col("is_fraud") == 0)


def model_features(df: DataFrame, as_of: datetime.date | str | None = None) -> DataFrame:
    """Feature columns of the classifier, for a batch or a stream alike.

    Missing numbers take the same defaults as missing columns, so that assembling
    the vector never meets a NULL and no row is lost.
    """
    df = with_trans_time(df)
    born = age_years(_as_time(df, "dob", parse_date), as_of) if "dob" in df.columns else F.lit(None)
    hour = trans_hour(F.col("trans_time")) if "trans_time" in df.columns else F.lit(None)
    flag = F.col("is_fraud") if "is_fraud" in df.columns else F.lit(DEFAULTS["label"])
    raw = {name: F.col(name).try_cast(DOUBLE) if name in df.columns else F.lit(None) for name in RAW_NUMERICS}
    derived = {
        "distance": euclid_deg(raw["lat"], raw["long"], raw["merch_lat"], raw["merch_long"], null_as=None),
        "age": born,
        "trans_hour": hour,
    }
    filled = {
        name: F.coalesce(F.nanvl(value.cast(DOUBLE), F.lit(None).cast(DOUBLE)), F.lit(DEFAULTS.get(name, 0.0)))
        for name, value in {**raw, **derived}.items()
    }
    return df.withColumns({**filled, "label": flag.try_cast(DOUBLE)})
