"""JSON messages to a topic or to text files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cardlens.sources.messages import encode_json


def write_topic(df: DataFrame, brokers: str, topic: str, **options: str) -> None:
    settings = {"kafka.bootstrap.servers": brokers, "topic": topic, **options}
    encode_json(df).write.format("kafka").options(**settings).save()


def write_message_files(df: DataFrame, folder: str, mode: str = "append") -> None:
    encode_json(df).write.mode(mode).text(folder)
