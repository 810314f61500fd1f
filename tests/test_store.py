"""Folded alerts and stored totals: bounded files, replays, crashes between steps, restarts."""

import os

import pytest
from pyspark.sql import functions as F

from cardlens.operators.serving import running_totals
from cardlens.schema import FRAUD_ALERT
from cardlens.sinks.messages import write_message_files
from cardlens.sinks.segments import ConcurrentWrite, SegmentTable
from cardlens.sources.messages import decode_json, read_message_files, well_formed
from cardlens.operators.features import with_trans_time
from cardlens.streaming import detector, monitor, store
from checks.tables import event_transactions
from tests.conftest import SMALL
from tests.test_state import alerts


def data_files(root):
    return [f for folder in ("fraud_alert", store.MERGED.name) for _, _, names in os.walk(f"{root}/{folder}") for f in names if f.endswith(".parquet")]


def all_files(root):
    return sum(len(names) for _, _, names in os.walk(root))


def write(spark, root, batch, *rows, query="q"):
    detector.write_batch(alerts(spark, *rows).coalesce(1), f"{root}/fraud_alert", query, batch, "trans_day")


def content(spark, root, day=None):
    return sorted((r.trans_num, r.prediction_score) for r in detector.read_alerts(spark, str(root), day).collect())


def test_files_stay_few_over_many_batches(spark, tmp_path):
    want, most, total = {}, 0, []
    for batch in range(50):
        rows = [(f"n{batch}", batch, 0.5), (f"n{batch // 2}", batch // 2, batch / 100)]  # one of them is delivered again and again
        want.update({n: s for n, _, s in sorted(rows, key=lambda r: r[2])} if batch else {"n0": 0.5})
        write(spark, tmp_path, batch, *rows)
        if batch and batch % 10 == 0:
            store.fold_batches(spark, str(tmp_path), "q", batch)
            total.append(all_files(tmp_path))
        most = max(most, len(data_files(tmp_path)))
    assert most <= 2 * 10 + 1 + 3 * store.KEPT_VERSIONS and total[-1] <= max(total[1:-1]) * 1.5
    last = {}
    for batch in range(50):
        last[f"n{batch // 2}"] = max(batch / 100, 0.5) if batch // 2 == batch else batch / 100
        last[f"n{batch}"] = 0.5 if batch // 2 != batch else last[f"n{batch}"]
    assert content(spark, tmp_path) == sorted(last.items()) == content(spark, tmp_path, "2024-01-03")


def test_a_fold_that_stops_between_its_steps(spark, tmp_path, monkeypatch):
    for batch in range(3):
        write(spark, tmp_path, batch, (f"n{batch}", batch, 0.5), ("same", 9, 0.1 * batch))
    want = [("n0", 0.5), ("n1", 0.5), ("n2", 0.5), ("same", 0.2)]
    with monkeypatch.context() as patch:
        patch.setattr(store, "put_text", lambda *a: (_ for _ in ()).throw(OSError("store is down")))
        with pytest.raises(OSError):
            store.fold_batches(spark, str(tmp_path), "q", 2)
    assert content(spark, tmp_path) == want and store.folded_below(spark, str(tmp_path), "q") == 0
    assert store.fold_batches(spark, str(tmp_path), "q", 2) == 2
    assert content(spark, tmp_path) == want and store.folded_below(spark, str(tmp_path), "q") == 2
    assert [b for b, _ in store.batch_folders(spark, str(tmp_path), "q")] == [0, 1, 2]
    assert store.fold_batches(spark, str(tmp_path), "q", 3) == 1
    assert [b for b, _ in store.batch_folders(spark, str(tmp_path), "q")] == [2]
    assert store.fold_batches(spark, str(tmp_path), "q", 3) == 0 and not store.batch_folders(spark, str(tmp_path), "q")
    assert content(spark, tmp_path) == want


def test_another_query_folds_at_the_same_time(spark, tmp_path, monkeypatch):
    write(spark, tmp_path, 0, ("a", 0, 0.5), query="one")
    write(spark, tmp_path, 0, ("a", 0, 0.9), ("b", 1, 0.5), query="two")
    with monkeypatch.context() as patch:
        patch.setattr(SegmentTable, "upsert", lambda *a: (_ for _ in ()).throw(ConcurrentWrite("taken")))
        assert store.fold_batches(spark, str(tmp_path), "one", 1) == 0
    want = content(spark, tmp_path)
    assert want == [("a", 0.9), ("b", 0.5)]
    for query in ("two", "one"):  # whichever is folded last, the row that was shown before is shown after
        assert store.fold_batches(spark, str(tmp_path), query, 1) >= 1
        assert content(spark, tmp_path) == want


def test_a_reader_from_before_a_fold(spark, tmp_path):
    write(spark, tmp_path, 0, ("a", 0, 0.5))
    before = detector.read_alerts(spark, str(tmp_path))
    store.fold_batches(spark, str(tmp_path), "q", 1)
    assert [r.trans_num for r in before.collect()] == ["a"]


def test_the_detector_folds(spark, tmp_path):
    write_message_files(event_transactions(spark, SMALL).repartition(6), f"{tmp_path}/topic")
    messages = read_message_files(spark, f"{tmp_path}/topic", 1)
    detector.start_detector(messages, str(tmp_path), f"{tmp_path}/cp", None, available_now=True, fold_every=2).awaitTermination()
    query = detector.query_identity(spark, f"{tmp_path}/cp")
    assert store.folded_below(spark, str(tmp_path), query) == 4
    assert {b for b, _ in store.batch_folders(spark, str(tmp_path), query)} <= {2, 3, 4, 5}
    assert detector.read_alerts(spark, str(tmp_path)).count() == 53
    day = detector.read_alerts(spark, str(tmp_path), "2024-01-03")
    assert day.count() == detector.read_alerts(spark, str(tmp_path)).where("trans_day = '2024-01-03'").count() > 0


def test_a_day_opens_the_files_around_it(spark, tmp_path):
    for batch, minute in ((0, 0), (1, 60 * 24 * 30)):
        write(spark, tmp_path, batch, (f"n{batch}", minute, 0.5))
        day = alerts(spark, (f"n{batch}", minute, 0.5)).select(F.date_format("trans_time", "yyyy-MM-dd")).head()[0]
        rows = alerts(spark, (f"n{batch}", minute, 0.5)).withColumn("trans_day", F.lit(day))
        detector.write_batch(rows, f"{tmp_path}/fraud_alert", "q", batch, "trans_day")
        store.fold_batches(spark, str(tmp_path), "q", batch + 1)
    store.fold_batches(spark, str(tmp_path), "q", 2)
    files = detector.read_alerts(spark, str(tmp_path), "2024-02-02").inputFiles()
    assert content(spark, tmp_path, "2024-02-02") == [("n1", 0.5)] and len(files) == 1
    assert FRAUD_ALERT.time == "trans_time"


def stored_totals(spark, path):
    rows = with_trans_time(well_formed(decode_json(read_message_files(spark, f"{path}/topic", 1))))
    monitor.start_stored_totals(rows, str(path), f"{path}/cp", available_now=True).awaitTermination()
    return monitor.read_totals(spark, str(path)).head()


def test_totals_over_a_restart_and_a_replay(spark, tmp_path):
    events = event_transactions(spark, SMALL)
    parts = [events.where(f"CAST(trans_num AS BIGINT) % 2 = {i}") for i in (0, 1)]
    write_message_files(parts[0].coalesce(1), f"{tmp_path}/topic")
    first = stored_totals(spark, tmp_path)
    assert first.total_processed == parts[0].count()
    write_message_files(parts[1].coalesce(1), f"{tmp_path}/topic")
    whole = running_totals(with_trans_time(events)).head()
    for _ in range(2):
        got = stored_totals(spark, tmp_path)
        assert (got.total_processed, got.fraud_count, got.per_second) == tuple(whole)
        for name in ("1", ".1.crc"):  # the last batch is played again
            os.remove(f"{tmp_path}/cp/commits/{name}")


def test_totals_of_records_without_time_and_of_nothing(spark, tmp_path):
    lacking = event_transactions(spark, SMALL).limit(7).withColumn("trans_date_trans_time", F.lit("soon"))
    for _ in range(2):
        write_message_files(lacking.coalesce(1), f"{tmp_path}/topic")
    got = stored_totals(spark, tmp_path)
    assert (got.total_processed, got.per_second, got.recent_processed, got.recent_per_second) == (14, 0.0, 0, 0.0)
    assert tuple(monitor.read_totals(spark, f"{tmp_path}/none").head()) == (0, 0, 0.0, 0, 0.0)
