"""Running counters and notifications over a transaction or alert stream."""

from __future__ import annotations

import datetime
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardlens.operators.serving import NOTIFIED, alert_windows, feed_rows, newest_first, running_totals
from cardlens.schema import ALERT_FIELDS, FRAUD_ALERT
from cardlens.sinks.keyed import one_per_key, winner_order
from cardlens.sinks.segments import SegmentTable, read_segments
from cardlens.streaming.detector import TRIGGER, _trigger, query_identity, read_alerts, write_batch
from cardlens.streaming.state import QUIET, REMEMBERED, WINDOW_COUNTS, first_deliveries, keyed_state, window_counts
from cardlens.streaming.store import KEPT_VERSIONS, MINUTE_TOTALS

LATE = "10 minutes"
RECENT_MINUTES = 5


def unique_alerts(alerts: DataFrame, late: str = LATE) -> DataFrame:
    """Drops a record delivered twice, keeping state for ``late`` of event time only."""
    return alerts.withWatermark("trans_time", late).dropDuplicatesWithinWatermark(["trans_num"])


def start_totals(
    transactions: DataFrame, name: str, checkpoint: str, available_now: bool = False, interval: str = TRIGGER
) -> StreamingQuery:
    """One row of running totals in the in-memory table ``name``."""
    writer = (
        running_totals(transactions)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, available_now, interval).start()


def minute_totals(transactions: DataFrame) -> DataFrame:
    """Transactions, fraud, first and last time per minute of event time; records without a time make a minute of their own."""
    minute = F.coalesce(F.date_format("trans_time", "yyyy-MM-dd HH:mm"), F.lit("unknown"))
    return transactions.groupBy(minute.alias("minute")).agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud"),
        F.min("trans_time").alias("first_time"),
        F.max("trans_time").alias("last_time"),
    )


def start_stored_totals(transactions: DataFrame, root: str, checkpoint: str, available_now: bool = False, interval: str = TRIGGER) -> StreamingQuery:
    """Running totals kept below ``root`` by minute; read with ``read_totals``, also while the stream runs and after it has ended.

    A batch writes the minutes it changes and nothing else, as one version of a keyed table, so a batch that is played again
    counts once and a restart goes on from the checkpoint.  There is no watermark: late records count.  The state is one
    row a minute.  A query with a new checkpoint has rows of its own, which add to those of the others.
    """
    identity = cache(lambda: query_identity(transactions.sparkSession, checkpoint))

    def store(batch: DataFrame, batch_id: int) -> None:
        table = SegmentTable(batch.sparkSession, MINUTE_TOTALS, root)
        table.upsert(batch.withColumn("query_id", F.lit(identity())))
        table.vacuum(KEPT_VERSIONS)

    writer = minute_totals(transactions).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(store)
    return _trigger(writer, available_now, interval).start()


def read_totals(spark: SparkSession, root: str, minutes: int = RECENT_MINUTES) -> DataFrame:
    """One row: all transactions and fraud, their rate per second of event time, and the same of the last ``minutes`` minutes.

    The last minutes are whole ones and the open one; their rate is per second from the first of them to the last record.
    """
    rows = read_segments(spark, MINUTE_TOTALS, root)
    ends = rows.agg(F.max("last_time").alias("last_time")).select(
        "last_time", (F.date_trunc("minute", "last_time") - F.make_dt_interval(mins=F.lit(minutes - 1))).alias("since")
    )
    recent = F.col("first_time") >= ends.select("since").scalar()
    seconds = lambda start: F.unix_micros(F.max("last_time")) - F.unix_micros(start)
    rate = lambda count, start: F.coalesce(F.try_divide(count * F.lit(1e6), seconds(start)), F.lit(0.0))
    of_recent = F.coalesce(F.sum(F.when(recent, F.col("processed"))), F.lit(0))
    return rows.agg(
        F.coalesce(F.sum("processed"), F.lit(0)).alias("total_processed"),
        F.coalesce(F.sum("fraud"), F.lit(0)).alias("fraud_count"),
        rate(F.sum("processed"), F.min("first_time")).alias("per_second"),
        of_recent.alias("recent_processed"),
        rate(of_recent, F.date_trunc("minute", F.max("last_time")) - F.make_dt_interval(mins=F.lit(minutes - 1))).alias("recent_per_second"),
    )


def start_alert_windows(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    step: str = "5 minutes",
    late: str = LATE,
    available_now: bool = False,
    interval: str = TRIGGER,
) -> StreamingQuery:
    """New alerts per closed event-time window, appended as Parquet; ``start_window_counts`` has the open ones too."""
    writer = (
        alert_windows(alerts, step, late)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, available_now, interval).start()


def notification(new_alerts: DataFrame, known: DataFrame, k: int = NOTIFIED) -> DataFrame:
    """One row: new alerts, all alerts of the newest day among them, and the ``k`` newest for display.

    An alert delivered twice counts once.  What ``known`` does not hold yet of the new
    alerts is counted with it, so the result does not hang on how far the detector is.
    """
    new = _once(new_alerts)
    of_today = F.col("trans_day") == new.agg(F.max("trans_day")).scalar()
    today = _once(known.where(of_today).unionByName(new.where(of_today)))
    newest = feed_rows(new.orderBy(*newest_first()).limit(k)).drop("clock", "merchant_short", "amount_text")
    shown = newest.agg(F.sort_array(F.collect_list(F.struct("time", *[c for c in newest.columns if c != "time"])), False))
    return new.agg(F.count(F.lit(1)).alias("new")).select(
        today.agg(F.count(F.lit(1))).scalar().alias("count"),
        "new",
        shown.scalar().alias("recent"),
    )


def _once(alerts: DataFrame) -> DataFrame:
    return one_per_key(alerts.select(*ALERT_FIELDS), FRAUD_ALERT, winner_order(FRAUD_ALERT))


def start_notifications(
    alerts: DataFrame,
    alert_root: str,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = TRIGGER,
    remember: datetime.timedelta = REMEMBERED,
) -> StreamingQuery:
    """A notification row per micro-batch that brought alerts; one that was delivered before, within ``remember``, is not new."""
    identity = cache(lambda: query_identity(alerts.sparkSession, checkpoint))

    def notify(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            day = batch.agg(F.max("trans_day")).head()[0]
            if day is not None:  # the stored alerts of that day alone are listed and read
                write_batch(notification(batch, read_alerts(batch.sparkSession, alert_root, day)), path, identity(), batch_id)
        finally:
            batch.unpersist()

    with keyed_state(alerts.sparkSession, available_now):
        writer = first_deliveries(alerts, remember).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(notify)
        return _trigger(writer, available_now, interval).start()


def start_window_counts(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    step: str = "5 minutes",
    quiet: datetime.timedelta = QUIET,
    remember: datetime.timedelta = REMEMBERED,
    available_now: bool = False,
    interval: str = TRIGGER,
) -> StreamingQuery:
    """Alerts per event-time window, with every batch that adds some and once more when the window closes; read with ``read_window_counts``."""
    identity = cache(lambda: query_identity(alerts.sparkSession, checkpoint))
    with keyed_state(alerts.sparkSession, available_now):
        writer = (
            window_counts(alerts, step, quiet, remember)
            .writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, batch_id: write_batch(batch, path, identity(), batch_id))
        )
        return _trigger(writer, available_now, interval).start()


def read_window_counts(spark: SparkSession, path: str) -> DataFrame:
    """The last known state of every window: each update counts on from the one before."""
    rows = spark.read.schema(WINDOW_COUNTS + ", query_id string, batch_id int").parquet(path)
    names = [c for c in rows.columns if c not in ("window_start", "query_id", "batch_id")]
    last = F.max_by(F.struct(*names), F.struct("revision", "batch_id"))
    return rows.groupBy("window_start").agg(last.alias("w")).select("window_start", "w.window_end", "w.new_alerts", "w.late_alerts", "w.closed")
