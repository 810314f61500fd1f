"""Live scoring of a transaction stream into an alert table.

Scoring is a stateless map, so a late record is scored like any other and never
dropped.  Each micro-batch owns the folders of its query and batch id, one below every
day it has alerts of, and overwrites them when Spark replays the batch: a retry leaves
no duplicates, and a query with a new checkpoint cannot touch what an earlier one
stored.  A batch without alerts writes none.  A batch that fails fails the query;
nothing is committed that was not written.  Every so many batches the committed ones are folded into few files
(``cardlens.streaming.store``).
"""

from __future__ import annotations

from functools import cache

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardlens.operators.features import model_features, with_trans_time
from cardlens.operators.scoring import alerts
from cardlens.schema import ALERT_FIELDS, FRAUD_ALERT, STRING, TRANSACTION_FIELDS, struct_of
from cardlens.sinks.keyed import one_per_key, winner_order
from cardlens.sources.messages import decode_json, encode_json, malformed, well_formed
from cardlens.streaming.store import FOLD_EVERY, fold_batches, read_merged, stored_schema
from cardlens.workspace import path_exists

TRIGGER = "5 seconds"  # fixed value


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def query_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query on its first start; it lasts as long as the checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").head().id


def write_batch(df: DataFrame, path: str, query_id: str, batch_id: int, *folders: str) -> None:
    """Write ``df`` below ``path`` into this batch's own folders, in place of what an earlier try left there."""
    owner = {"query_id": F.lit(query_id), "batch_id": F.lit(batch_id)}
    (
        df.withColumns(owner)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders, *owner)
        .parquet(path)
    )


def complete(decoded: DataFrame) -> DataFrame:
    """The records that have what an alert is told apart by: a number and a readable time."""
    return with_trans_time(decoded).where(F.col("trans_num").isNotNull() & F.col("trans_time").isNotNull())


def unusable(decoded: DataFrame) -> DataFrame:
    """Text of the records that are not scored: malformed ones, and those without number or readable time."""
    timed = with_trans_time(well_formed(decoded))
    lacking = timed.where(F.col("trans_num").isNull() | F.col("trans_time").isNull()).select(*TRANSACTION_FIELDS)
    return malformed(decoded).unionByName(encode_json(lacking).withColumnRenamed("value", "record"))


def start_detector(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    model: PipelineModel | None = None,
    as_of: str | None = None,
    available_now: bool = False,
    interval: str = TRIGGER,
    fold_every: int | None = FOLD_EVERY,
) -> StreamingQuery:
    """Decode, score and store: alerts below ``root/fraud_alert``, unusable records below ``root/malformed``.

    Before every ``fold_every``-th batch is done, the batches before it are folded; with None they stay as they are.
    """
    decoded = decode_json(messages)
    identity = cache(lambda: query_identity(messages.sparkSession, checkpoint))  # there once the query runs

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read twice; what an executor loses is read again from the source
        try:
            found = alerts(model_features(complete(well_formed(batch)), as_of), model)
            write_batch(found, f"{root}/fraud_alert", identity(), batch_id, "trans_day")
            write_batch(unusable(batch), f"{root}/malformed", identity(), batch_id)
            if fold_every and batch_id and batch_id % fold_every == 0:
                fold_batches(batch.sparkSession, root, identity(), batch_id)
        finally:
            batch.unpersist()

    writer = decoded.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(store)
    return _trigger(writer, available_now, interval).start()


def scored_stream(messages: DataFrame, model: PipelineModel | None = None, as_of: str | None = None) -> DataFrame:
    """The alerts as a stream, for further streaming operators."""
    return alerts(model_features(complete(well_formed(decode_json(messages))), as_of), model)


def read_alerts(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """The stored alerts, one per key however often a record was delivered.

    With ``day`` only that day's folder is listed and read, and of the folded files those with times around it.
    Batches are listed before the folded files: what is folded in between is found in both places, not in none.
    """
    top = f"{root}/fraud_alert"
    stored = _stored(spark, top, stored_schema(), top if day is None else f"{top}/trans_day={day}")
    for folded in read_merged(spark, root, day):
        stored = stored.unionByName(folded)
    newest = [F.desc("batch_id"), *winner_order(FRAUD_ALERT), F.desc("query_id")]
    return one_per_key(stored, FRAUD_ALERT, newest).select(*ALERT_FIELDS)


def read_malformed(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, f"{root}/malformed", struct_of({"record": STRING}), f"{root}/malformed")


def _stored(spark: SparkSession, top: str, schema: T.StructType, path: str) -> DataFrame:
    """Rows below ``path``, none where nothing was stored yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", top).parquet(path)
