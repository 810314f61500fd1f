import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from cardlens.operators import scoring
from cardlens.operators.features import model_features, with_trans_time
from cardlens.operators.serving import alert_windows
from cardlens.plans.detect import detect, merge_alerts
from cardlens.schema import ALERT_FIELDS, FRAUD_ALERT
from cardlens.sinks.messages import write_message_files
from cardlens.sources.keyed import read_keyed
from cardlens.sources.messages import decode_json, read_message_files, well_formed
from cardlens.streaming import detector, monitor
from checks.queries import AS_OF, EVENT_RULE, rule_model
from checks.tables import event_transactions
from tests.conftest import SMALL


@pytest.fixture
def topic(spark, tmp_path):
    """Four files of messages."""
    write_message_files(event_transactions(spark, SMALL).repartition(4), f"{tmp_path}/topic")
    return tmp_path


def run(spark, root, model=None, files_per_batch=1, name="checkpoint"):
    messages = read_message_files(spark, f"{root}/topic", files_per_batch)
    query = detector.start_detector(messages, str(root), f"{root}/{name}", model, AS_OF, available_now=True)
    query.awaitTermination()
    return query


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def batch_alerts(spark, model=None):
    return scoring.alerts(model_features(event_transactions(spark, SMALL), AS_OF), model)


@pytest.mark.parametrize("with_model", [False, True])
def test_stream_equals_batch(spark, topic, with_model):
    model = rule_model(EVENT_RULE) if with_model else None
    query = run(spark, topic, model)
    assert len(query.recentProgress) >= 4
    assert same_rows(detector.read_alerts(spark, str(topic)), batch_alerts(spark, model))


def test_restart_half_way(spark, topic):
    files = sorted(glob.glob(f"{topic}/topic/*.txt"))
    later = topic / "later"
    later.mkdir()
    for f in files[2:]:
        shutil.move(f, later)
    run(spark, topic)
    half = detector.read_alerts(spark, str(topic)).count()
    for f in reversed(sorted(glob.glob(f"{later}/*"))):
        shutil.copy(f, topic / "topic")
    run(spark, topic)
    assert 0 < half < 53 and same_rows(detector.read_alerts(spark, str(topic)), batch_alerts(spark))


def test_redelivery_and_replay_leave_one_row(spark, topic):
    run(spark, topic)
    write_message_files(event_transactions(spark, SMALL).coalesce(1), f"{topic}/topic")
    run(spark, topic)
    run(spark, topic, name="checkpoint_lost")  # every batch again
    assert same_rows(detector.read_alerts(spark, str(topic)), batch_alerts(spark))


def test_a_new_checkpoint_leaves_stored_alerts(spark, topic):
    run(spark, topic)
    other = event_transactions(spark, SMALL).withColumn("trans_num", F.concat(F.lit("other-"), "trans_num"))
    write_message_files(other.coalesce(1), f"{topic}/more/topic")
    messages = read_message_files(spark, f"{topic}/more/topic")
    detector.start_detector(messages, str(topic), f"{topic}/second", None, AS_OF, available_now=True).awaitTermination()
    assert same_rows(detector.read_alerts(spark, str(topic)).where("trans_num NOT LIKE 'other-%'"), batch_alerts(spark))
    assert detector.read_alerts(spark, str(topic)).count() == 2 * batch_alerts(spark).count()


def test_a_replayed_batch_overwrites_its_own_folders(spark, topic):
    run(spark, topic, files_per_batch=4)
    before = sorted(glob.glob(f"{topic}/fraud_alert/*/*/*"))
    os.remove(f"{topic}/checkpoint/commits/0")
    for crc in glob.glob(f"{topic}/checkpoint/commits/.0*"):
        os.remove(crc)
    run(spark, topic, files_per_batch=4)
    assert before and sorted(glob.glob(f"{topic}/fraud_alert/*/*/*")) == before
    stored = spark.read.parquet(f"{topic}/fraud_alert")
    assert stored.count() == batch_alerts(spark).count()


def test_records_without_number_or_time_are_kept_aside(spark, topic):
    lacking = event_transactions(spark, SMALL).limit(10).withColumn("is_fraud", F.lit(1))
    write_message_files(lacking.withColumn("trans_num", F.lit(None).cast("string")).coalesce(1), f"{topic}/topic")
    write_message_files(lacking.withColumn("trans_date_trans_time", F.lit("soon")).coalesce(1), f"{topic}/topic")
    run(spark, topic)
    assert same_rows(detector.read_alerts(spark, str(topic)), batch_alerts(spark))
    assert detector.read_malformed(spark, str(topic)).where("record LIKE '{%}'").count() == 20


def test_nothing_stored_yet(spark, tmp_path):
    assert detector.read_alerts(spark, str(tmp_path)).isEmpty() and detector.read_malformed(spark, str(tmp_path)).isEmpty()
    assert detector.read_alerts(spark, str(tmp_path), day="2024-01-03").columns == list(ALERT_FIELDS)


def test_notification_counts_an_alert_once(spark):
    rows = batch_alerts(spark)
    row = monitor.notification(rows.unionByName(rows), rows.limit(0)).head()
    today = rows.where(F.col("trans_day") == rows.agg(F.max("trans_day")).head()[0]).count()
    assert (row.new, row["count"]) == (53, today)


def test_malformed_messages_are_kept_aside(spark, topic):
    (topic / "topic" / "bad.txt").write_text('{"trans_num": "x", "amt"\nnot json\n{"trans_num": "y", "amt": "much"}\n')
    run(spark, topic)
    assert same_rows(detector.read_alerts(spark, str(topic)), batch_alerts(spark))
    assert detector.read_malformed(spark, str(topic)).count() == 3


def test_a_failing_sink_fails_the_query_and_loses_nothing(spark, topic, monkeypatch):
    def broken(*args, **kwargs):
        raise OSError("store is down")

    with monkeypatch.context() as patch:
        patch.setattr(detector, "alerts", broken)
        with pytest.raises(Exception, match="store is down"):
            run(spark, topic)
    run(spark, topic)
    assert same_rows(detector.read_alerts(spark, str(topic)), batch_alerts(spark))


def test_late_alerts_are_not_dropped(spark, topic):
    run(spark, topic)
    late = event_transactions(spark, SMALL).limit(20).withColumns(
        {"trans_num": F.concat(F.lit("late-"), "trans_num"), "is_fraud": F.lit(1), "trans_date_trans_time": F.lit("2020-01-01 00:00:00")}
    )
    write_message_files(late, f"{topic}/topic")
    run(spark, topic)
    stored = detector.read_alerts(spark, str(topic))
    assert stored.where("trans_num LIKE 'late-%'").count() == 20
    assert detector.read_alerts(spark, str(topic), day="2020-01-01").count() == 20


def test_alerts_of_a_day_read_only_that_day(spark, topic):
    run(spark, topic)
    day = detector.read_alerts(spark, str(topic), day="2024-01-03")
    assert day.inputFiles() and all("trans_day=2024-01-03" in name for name in day.inputFiles())
    assert same_rows(day, batch_alerts(spark).where("trans_day = '2024-01-03'"))


def test_stored_alerts_merge_into_the_keyed_table(spark, topic):
    run(spark, topic)
    assert merge_alerts(spark, str(topic), f"{topic}/tables", day="2024-01-03") == ["2024-01-03"]
    for _ in range(2):
        assert "2024-01-03" in merge_alerts(spark, str(topic), f"{topic}/tables")
    assert same_rows(read_keyed(spark, FRAUD_ALERT, f"{topic}/tables"), batch_alerts(spark))


def test_windows_are_emitted_once_closed(spark, topic):
    found = detector.scored_stream(read_message_files(spark, f"{topic}/topic"), None, AS_OF)
    monitor.start_alert_windows(found, f"{topic}/rows", f"{topic}/cp", available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{topic}/rows")
    batch = alert_windows(batch_alerts(spark))
    closed = batch_alerts(spark).agg((F.max("trans_time") - F.expr("INTERVAL 10 MINUTES"))).scalar()
    assert same_rows(rows, batch.where(F.col("window_end") <= closed))


def test_unique_alerts_drop_a_second_delivery(spark, topic):
    write_message_files(event_transactions(spark, SMALL).coalesce(1), f"{topic}/topic")
    found = monitor.unique_alerts(detector.scored_stream(read_message_files(spark, f"{topic}/topic"), None, AS_OF))
    query = found.writeStream.format("memory").queryName("unique_alerts").trigger(availableNow=True).start()
    query.awaitTermination()
    assert same_rows(spark.table("unique_alerts"), batch_alerts(spark))


def test_totals(spark, topic):
    rows = with_trans_time(well_formed(decode_json(read_message_files(spark, f"{topic}/topic", 1))))
    monitor.start_totals(rows, "totals_test", f"{topic}/cp", available_now=True).awaitTermination()
    totals = spark.table("totals_test").head()
    assert (totals.total_processed, totals.fraud_count) == (1000, 53)


def test_notification_row(spark, topic):
    run(spark, topic)
    found = detector.scored_stream(read_message_files(spark, f"{topic}/topic", 2), None, AS_OF)
    monitor.start_notifications(found, str(topic), f"{topic}/notes", f"{topic}/cp", available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{topic}/notes/*").collect()
    assert sum(r.new for r in rows) == 53 and all(len(r.recent) == 5 for r in rows)
    for row in rows:
        times = [entry.time for entry in row.recent]
        assert times == sorted(times, reverse=True)
        day = row.recent[0].time[:10]
        assert row["count"] == detector.read_alerts(spark, str(topic), day=day).count()


def test_detection_refuses_a_model_that_is_not_there(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)not exist"):
        detect(spark, "localhost:9092", "transactions", str(tmp_path), f"{tmp_path}/cp", f"{tmp_path}/no_model")
