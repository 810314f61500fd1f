"""Windows and first deliveries in keyed state: redelivery in later batches and runs, timers, late alerts."""

import datetime

from pyspark.sql import functions as F

from cardlens.operators.serving import alert_windows
from cardlens.schema import ALERT_FIELDS, FRAUD_ALERT, struct_of
from cardlens.streaming import monitor
from cardlens.streaming.state import PROVIDER, keyed_state

NOW = datetime.timedelta(milliseconds=1)


def alerts(spark, *rows):
    """(number, minute, score) as alerts of one day."""
    df = spark.createDataFrame(list(rows), "trans_num string, minute long, prediction_score double")
    df = df.withColumn("trans_time", F.expr("timestamp_seconds(1704240000 + 60 * minute)")).withColumn("trans_day", F.lit("2024-01-03"))
    return df.select([(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in ALERT_FIELDS.items()])


def feed(df, path):
    df.coalesce(1).write.mode("append").parquet(f"{path}/in")


def stream(spark, path):
    return spark.readStream.schema(struct_of(ALERT_FIELDS)).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def count(spark, path, quiet=monitor.QUIET):
    monitor.start_window_counts(stream(spark, path), f"{path}/rows", f"{path}/cp", quiet=quiet, available_now=True).awaitTermination()
    return {r.window_start.minute: (r.new_alerts, r.late_alerts, r.closed) for r in monitor.read_window_counts(spark, f"{path}/rows").collect()}


def test_an_alert_counts_once_across_batches_and_runs(spark, tmp_path):
    first = alerts(spark, ("a", 0, 0.9), ("b", 1, 0.9), ("c", 7, 0.9))
    feed(first, tmp_path)
    feed(first.where("trans_num <> 'b'"), tmp_path)
    assert count(spark, tmp_path) == {0: (2, 0, False), 5: (1, 0, False)}
    feed(alerts(spark, ("a", 0, 0.9), ("d", 2, 0.9), ("a", 12, 0.9)), tmp_path)  # the same number at another time is another alert
    assert count(spark, tmp_path) == {0: (3, 0, False), 5: (1, 0, False), 10: (1, 0, False)}
    assert spark.conf.get(PROVIDER).endswith("HDFSBackedStateStoreProvider")


def test_windows_are_the_batch_form(spark, tmp_path):
    rows = alerts(spark, *[(f"n{i}", (i * 37) % 240, 0.5) for i in range(120)])
    feed(rows, tmp_path)
    feed(rows.where("trans_num LIKE '%1'"), tmp_path)
    monitor.start_window_counts(stream(spark, tmp_path), f"{tmp_path}/rows", f"{tmp_path}/cp", available_now=True).awaitTermination()
    got = monitor.read_window_counts(spark, f"{tmp_path}/rows").select("window_start", "window_end", "new_alerts")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, alert_windows(rows).collect()))


def test_a_timer_closes_a_window_and_later_alerts_are_late(spark, tmp_path):
    feed(alerts(spark, ("a", 0, 0.9), ("b", 6, 0.9)), tmp_path)
    assert count(spark, tmp_path, NOW) == {0: (1, 0, False), 5: (1, 0, False)}
    feed(alerts(spark, ("c", 11, 0.9)), tmp_path)
    assert count(spark, tmp_path, NOW) == {0: (1, 0, True), 5: (1, 0, True), 10: (1, 0, False)}
    feed(alerts(spark, ("d", 1, 0.9), ("a", 0, 0.9)), tmp_path)  # one is late, one was delivered before
    assert count(spark, tmp_path, NOW) == {0: (2, 1, True), 5: (1, 0, True), 10: (1, 0, True)}


def test_a_notification_names_an_alert_once(spark, tmp_path):
    first = alerts(spark, ("a", 0, 0.5), ("a", 0, 0.9), ("b", 1, 0.9))
    for batch in (first, first, alerts(spark, ("a", 0, 0.9), ("c", 2, 0.9))):
        feed(batch, tmp_path)
        monitor.start_notifications(stream(spark, tmp_path), str(tmp_path), f"{tmp_path}/notes", f"{tmp_path}/cp", available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/notes/*").collect()
    assert sorted((r.new, tuple(e.trans_num for e in r.recent)) for r in rows) == [(1, ("c",)), (2, ("b", "a"))]


def test_settings_are_put_back(spark):
    spark.conf.set(PROVIDER, "some.Provider")
    try:
        with keyed_state(spark, available_now=True):
            assert "RocksDB" in spark.conf.get(PROVIDER)
        assert spark.conf.get(PROVIDER) == "some.Provider"
    finally:
        spark.conf.unset(PROVIDER)
    assert FRAUD_ALERT.key == ("trans_day", "trans_time", "trans_num")
