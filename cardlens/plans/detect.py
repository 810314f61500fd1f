"""Live detection from a topic, with a trained model or the labels."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from cardlens.operators.classifier import load_model
from cardlens.schema import FRAUD_ALERT
from cardlens.sinks.keyed import upsert_keyed
from cardlens.sources.messages import read_topic
from cardlens.streaming.detector import read_alerts, start_detector


def detect(
    spark: SparkSession, brokers: str, topic: str, root: str, checkpoint: str, model_path: str | None = None, **options
) -> StreamingQuery:
    """Alerts of ``topic`` below ``root``; a named model that cannot be loaded is an error."""
    model = load_model(model_path) if model_path else None
    return start_detector(read_topic(spark, brokers, topic), root, checkpoint, model, **options)


def merge_alerts(spark: SparkSession, root: str, tables: str, day: str | None = None) -> list:
    """Fold the stream's small files into the keyed alert table below ``tables``.

    To be run now and then, by day; running it again changes nothing.
    """
    return upsert_keyed(read_alerts(spark, root, day), FRAUD_ALERT, tables)
