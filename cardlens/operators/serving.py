"""Serving queries over the history and alert tables.

Top-k queries use ORDER BY with LIMIT, which Spark runs as a per-task top-k
followed by a merge of k rows per task, and every order ends in a unique column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.functions import (
    amount_text,
    category_label,
    clock_time,
    mask_card,
    or_default,
    percent,
    status_label,
    truncate,
)
from cardlens.schema import DATE_FORMAT, TIME_FORMAT

FEED_LENGTH = 20  # fixed values: lengths of the lists and texts that are served
NOTIFIED = 5
MAP_POINTS = 1000
TOP_CATEGORIES = 6
MERCHANT_LENGTH = 18
LOG_LENGTH = 15
LOG_MERCHANT_LENGTH = 20
SERIES_POINTS = 60

NEWEST = (F.desc_nulls_last, "trans_time"), (F.asc, "trans_num")


def newest_first() -> list[Column]:
    return [direction(name) for direction, name in NEWEST]


def live_stats(fraud: DataFrame, non_fraud: DataFrame, customers: DataFrame, alerts: DataFrame) -> DataFrame:
    """Fraud (history and alerts), normal and customer counts with the fraud rate."""

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    counted = fraud.agg(F.count(F.lit(1)).alias("history")).select(
        (F.col("history") + rows(alerts)).alias("fraud_count"),
        rows(non_fraud).alias("non_fraud_count"),
        rows(customers).alias("customer_count"),
    )
    total = F.col("fraud_count") + F.col("non_fraud_count")
    return counted.withColumn("fraud_rate", F.coalesce(percent(F.col("fraud_count"), total, 2), F.lit(0.0)))


def feed_rows(df: DataFrame, also: dict[str, str] | None = None) -> DataFrame:
    """The display form of transactions: masked card, formatted time, no NULL texts; ``also`` names columns shown as they are."""
    time_text = F.date_format("trans_time", TIME_FORMAT)
    return df.select(
        or_default(F.col("trans_num"), "").alias("trans_num"),
        mask_card(F.col("cc_num")).alias("cc_num"),
        or_default(time_text, "").alias("time"),
        clock_time(time_text).alias("clock"),
        or_default(F.col("merchant"), "").alias("merchant"),
        truncate(or_default(F.col("merchant"), ""), MERCHANT_LENGTH).alias("merchant_short"),
        or_default(F.col("amt").cast("double"), 0.0).alias("amount"),
        amount_text(or_default(F.col("amt").cast("double"), 0.0)).alias("amount_text"),
        or_default(F.col("category"), "").alias("category"),
        *[F.col(c).alias(name) for name, c in (also or {}).items()],
    )


def recent_fraud(alerts: DataFrame, history: DataFrame, k: int = FEED_LENGTH) -> DataFrame:
    """The newest alerts, or the newest historical fraud while there are no alerts, with the merchant's place if known.

    Whether there are alerts is looked up when the query is built, at the price of one
    row: the history is not read as long as there are some.
    """
    columns = ["trans_num", "cc_num", "trans_time", "merchant", "amt", "category"]
    place = {"lat": "merch_lat", "long": "merch_long"}
    source = history if alerts.isEmpty() else alerts
    known = [F.col(c) if c in source.columns else F.lit(None).cast("double").alias(c) for c in place.values()]
    return feed_rows(source.select(*columns, *known).orderBy(*newest_first()).limit(k), place)


def alerts_of_day(alerts: DataFrame, day: str, k: int = NOTIFIED) -> DataFrame:
    """The newest ``k`` alerts of one day; on the stored table only that day's folder is read."""
    return feed_rows(alerts.where(F.col("trans_day") == day).orderBy(*newest_first()).limit(k))


def alerts_by_day(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("trans_day").agg(F.count(F.lit(1)).alias("alerts")).orderBy("trans_day")


def transaction_log(df: DataFrame, k: int = LOG_LENGTH) -> DataFrame:
    """The newest ``k`` transactions with a status text."""
    return (
        df.orderBy(*newest_first())
        .limit(k)
        .select(
            "trans_num",
            F.date_format("trans_time", TIME_FORMAT).alias("time"),
            mask_card(F.col("cc_num")).alias("card"),
            F.col("amt").alias("amount"),
            truncate(or_default(F.col("merchant"), "Unknown"), LOG_MERCHANT_LENGTH).alias("merchant"),
            status_label(F.col("is_fraud")).alias("status"),
        )
    )


def category_top(history: DataFrame, alerts: DataFrame, k: int = TOP_CATEGORIES) -> DataFrame:
    """Fraud per category over history and alerts together.

    Rows are counted per raw category first, so the label is built once per
    distinct category and not once per row.
    """
    raw = history.select("category").unionByName(alerts.select("category"))
    return (
        raw.groupBy("category")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(category_label(F.col("category")).alias("label"))
        .agg(F.sum("n").alias("fraud_count"))
        .orderBy(F.desc("fraud_count"), F.asc("label"))
        .limit(k)
    )


def fraud_points(history: DataFrame, k: int = MAP_POINTS) -> DataFrame:
    """Places of the newest fraud; a coordinate of exactly 0.0 is a place too."""
    return (
        history.where(F.col("merch_lat").isNotNull() & F.col("merch_long").isNotNull())
        .orderBy(*newest_first())
        .limit(k)
        .select("trans_num", F.col("merch_lat").alias("lat"), F.col("merch_long").alias("long"), "merchant", "amt")
    )


def detection_series(alerts: DataFrame, step: str = "5 minutes", points: int = SERIES_POINTS) -> DataFrame:
    """New alerts in each of the last ``points`` intervals, quiet intervals as zero."""
    gap = F.expr(f"INTERVAL {step}")
    last = alerts.agg(F.max(F.window("trans_time", step)["start"]).alias("last"))
    first_start = last.select(F.col("last") - gap * F.lit(points - 1)).scalar()
    recent = F.col("trans_time") >= first_start
    if "trans_day" in alerts.columns:  # the stored table's folders: older days are not read
        recent &= F.col("trans_day") >= F.date_format(first_start, DATE_FORMAT)
    counted = (
        alerts.where(recent)
        .groupBy(F.window("trans_time", step)["start"].alias("window_start"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    axis = last.where(F.col("last").isNotNull()).select(
        F.explode(F.sequence(F.col("last") - gap * F.lit(points - 1), F.col("last"), gap)).alias("window_start")
    )
    return axis.join(F.broadcast(counted), "window_start", "left").select(  # at most ``points`` rows a side
        "window_start", F.coalesce("n", F.lit(0)).alias("new_alerts")
    )


def running_totals(df: DataFrame) -> DataFrame:
    """Transactions, fraud and rate per second of event time; works on a batch or a stream."""
    seconds = F.unix_micros(F.max("trans_time")) - F.unix_micros(F.min("trans_time"))
    return df.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud_count"),
        F.coalesce(F.try_divide(F.count(F.lit(1)) * F.lit(1e6), seconds), F.lit(0.0)).alias("per_second"),
    )


def alert_windows(alerts: DataFrame, step: str = "5 minutes", late: str | None = None) -> DataFrame:
    """Alerts per event-time window.

    On a stream, ``late`` sets the watermark: each window is emitted once, when it
    closes, and is the number of new alerts since the window before.
    """
    if late is not None:
        alerts = alerts.withWatermark("trans_time", late)
    return (
        alerts.groupBy(F.window("trans_time", step).alias("w"))
        .agg(F.count(F.lit(1)).alias("new_alerts"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "new_alerts")
    )
