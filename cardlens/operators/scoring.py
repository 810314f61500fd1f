"""Scores to alerts, the same for a batch and a stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.functions import trans_day
from cardlens.schema import ALERT_FIELDS

LABEL_SCORE = 0.95  # fixed value: score of an alert raised without a model


def positive_probability(df: DataFrame) -> Column:
    """Probability of class 1, or 0.0 where the model gives none."""
    if "probability" not in df.columns:
        return F.lit(0.0)
    return vector_to_array("probability")[1]


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    scored = model.transform(df)
    return scored.withColumn("prediction_score", positive_probability(scored))


def _alert_rows(df: DataFrame) -> DataFrame:
    columns = df.withColumn("trans_day", trans_day(F.col("trans_time")))
    return columns.select([F.col(name).cast(kind).alias(name) for name, kind in ALERT_FIELDS.items()])


def model_alerts(scored: DataFrame) -> DataFrame:
    """Rows the model calls fraud."""
    return _alert_rows(scored.where(F.col("prediction") == 1.0).withColumn("is_fraud", F.lit(1.0)))


def label_alerts(df: DataFrame) -> DataFrame:
    """Rows labelled fraud, for running without a model."""
    return _alert_rows(df.where(F.col("is_fraud") == 1).withColumn("prediction_score", F.lit(LABEL_SCORE)))


def alerts(df: DataFrame, model: PipelineModel | None) -> DataFrame:
    return label_alerts(df) if model is None else model_alerts(score(df, model))
