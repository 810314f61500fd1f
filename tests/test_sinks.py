import os
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cardlens.operators.features import enrich, fraud_rows, history_rows
from cardlens.plans.import_batch import import_transactions
from cardlens.schema import CARDHOLDER, CARDHOLDER_DETAILS, CUSTOMER, FRAUD_TRANSACTION, NON_FRAUD_TRANSACTION, TRANSACTION
from cardlens.sinks.files import write_parquet, write_store, write_with_fallback
from cardlens.sinks.keyed import _by_time, partition_value, upsert_keyed, winner_order
from cardlens.sinks.segments import SegmentTable, read_segments
from cardlens.sinks.report import training_report
from cardlens.sources.keyed import read_keyed
from cardlens.workspace import DROP_SHUFFLES, shared_dir, snapshot
from checks.queries import QUERIES
from checks.tables import transactions
from tests.conftest import SMALL

MONTHLY = FRAUD_TRANSACTION.monthly()


def history(spark, *rows):
    """(card, time, number, amount) to history rows."""
    df = spark.createDataFrame(list(rows), "cc_num string, trans_time string, trans_num string, amt double")
    return df.withColumn("trans_time", F.to_timestamp("trans_time")).selectExpr(
        "cc_num", "trans_time", "trans_num", "'c' AS category", "'m' AS merchant", "amt", "0.0D AS merch_lat",
        "0.0D AS merch_long", "0.0D AS distance", "30 AS age", "1.0D AS is_fraud",
    )


def stored(spark, root, table=FRAUD_TRANSACTION):
    rows = read_keyed(spark, table, root)
    return sorted((r.cc_num, str(r.trans_time), r.trans_num, r.amt) for r in rows.collect())


def test_same_key_is_overwritten(spark, tmp_path):
    root = str(tmp_path)
    upsert_keyed(history(spark, ("1", "2020-01-01 10:00:00", "a", 1.0), ("1", "2020-01-01 11:00:00", "b", 2.0)), FRAUD_TRANSACTION, root)
    upsert_keyed(history(spark, ("1", "2020-01-01 10:00:00", "a", 9.0), ("2", "2020-01-01 10:00:00", "c", 3.0)), FRAUD_TRANSACTION, root)
    assert stored(spark, root) == [
        ("1", "2020-01-01 10:00:00", "a", 9.0),
        ("1", "2020-01-01 11:00:00", "b", 2.0),
        ("2", "2020-01-01 10:00:00", "c", 3.0),
    ]


def test_two_rows_of_a_card_in_one_second_collapse(spark, tmp_path):
    root = str(tmp_path)
    upsert_keyed(history(spark, ("1", "2020-01-01 10:00:00", "a", 1.0), ("1", "2020-01-01 10:00:00", "b", 2.0)), FRAUD_TRANSACTION, root)
    assert [r[2] for r in stored(spark, root)] == ["b"]


def test_upsert_again_changes_nothing(spark, tmp_path):
    root, rows = str(tmp_path), history(spark, ("1", "2020-01-01 10:00:00", "a", 1.0), ("2", "2020-02-01 10:00:00", "b", 2.0))
    upsert_keyed(rows, FRAUD_TRANSACTION, root)
    once = stored(spark, root)
    upsert_keyed(rows, FRAUD_TRANSACTION, root)
    assert stored(spark, root) == once


def test_only_touched_folders_are_rewritten(spark, tmp_path):
    root = str(tmp_path)
    upsert_keyed(history(spark, ("1", "2020-01-01 10:00:00", "a", 1.0), ("1", "2020-01-02 10:00:00", "b", 2.0)), FRAUD_TRANSACTION, root)
    untouched = sorted(os.listdir(f"{root}/fraud_transaction/trans_day=2020-01-02"))
    assert upsert_keyed(history(spark, ("3", "2020-01-01 10:00:00", "c", 1.0)), FRAUD_TRANSACTION, root) == ["2020-01-01"]
    assert sorted(os.listdir(f"{root}/fraud_transaction/trans_day=2020-01-02")) == untouched
    assert len(stored(spark, root)) == 3


def test_rows_without_time_are_all_kept(spark, tmp_path):
    """Which of them are the same transaction nobody can tell, so only a row with the same content throughout is one."""
    root = str(tmp_path)
    assert upsert_keyed(history(spark, ("1", None, "a", 1.0), ("1", None, "c", 1.0)), FRAUD_TRANSACTION, root) == ["unknown"]
    for _ in range(2):
        upsert_keyed(history(spark, ("1", None, "b", 2.0)), FRAUD_TRANSACTION, root)
    assert sorted(stored(spark, root)) == [("1", "None", "a", 1.0), ("1", "None", "b", 2.0), ("1", "None", "c", 1.0)]


def test_rows_without_bucket_key_are_dealt_out(spark, tmp_path):
    people = spark.range(200).select(F.lit(None).cast("string").alias("cc_num"), F.concat(F.lit("x"), "id").alias("first"))
    for name, kind in CUSTOMER.fields.items():
        if name not in people.columns:
            people = people.withColumn(name, F.lit(None).cast(kind))
    for _ in range(2):
        folders = upsert_keyed(people, CUSTOMER, str(tmp_path))
    assert read_keyed(spark, CUSTOMER, str(tmp_path)).count() == 200 and len(folders) > 30


def test_nothing_to_write(spark, tmp_path):
    """The table is then there and empty, as one that was declared, and later writes find it."""
    root, one = str(tmp_path), history(spark, ("1", "2020-01-01 10:00:00", "a", 1.0))
    assert upsert_keyed(one.limit(0), FRAUD_TRANSACTION, root) == []
    assert stored(spark, root) == []
    assert upsert_keyed(one, FRAUD_TRANSACTION, root) == ["2020-01-01"]
    assert upsert_keyed(one.limit(0), FRAUD_TRANSACTION, root) == []
    assert len(stored(spark, root)) == 1


def test_files_are_sorted_newest_first_within_a_card(spark, tmp_path):
    rows = history_rows(enrich(fraud_rows(transactions(spark, SMALL)), "2020-06-21"))
    upsert_keyed(rows, MONTHLY, str(tmp_path))
    folder = f"{tmp_path}/fraud_transaction/trans_month=1995-06"
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    listed = [(r.cc_num, r.trans_time) for r in spark.read.parquet(f"{folder}/{files[0]}").collect()]
    assert len(files) == 1 and listed == sorted(listed, key=lambda r: (r[0], -r[1].timestamp()))


def test_customers_collapse_to_one_row_a_card(spark, tmp_path):
    root, fraud, normal = str(tmp_path), FRAUD_TRANSACTION.monthly(), NON_FRAUD_TRANSACTION.monthly()
    seen = import_transactions(transactions(spark, SMALL), root, "2020-06-21", fraud, normal)
    assert (seen.total, seen.fraud + seen.non_fraud) == (6000, 6000)
    people = read_keyed(spark, CUSTOMER, root)
    assert people.count() == people.select("cc_num").distinct().count() == 150
    again = import_transactions(transactions(spark, SMALL), root, "2020-06-21", fraud, normal)
    assert again == seen and read_keyed(spark, CUSTOMER, root).count() == 150


def test_folder_filter_prunes(spark, tmp_path):
    root = str(tmp_path)
    upsert_keyed(history(spark, ("1", "2020-01-01 10:00:00", "a", 1.0), ("1", "2020-01-02 10:00:00", "b", 2.0)), FRAUD_TRANSACTION, root)
    one_day = read_keyed(spark, FRAUD_TRANSACTION, root).where("trans_day = '2020-01-02'")
    assert one_day.count() == 1
    assert "PartitionFilters: [isnotnull(trans_day" in one_day._jdf.queryExecution().executedPlan().toString()


def test_staging_is_removed(spark, tmp_path):
    before = set(os.listdir(shared_dir(spark)))
    upsert_keyed(history(spark, ("1", "2020-01-01 10:00:00", "a", 1.0)), FRAUD_TRANSACTION, str(tmp_path))
    assert set(os.listdir(shared_dir(spark))) == before


def test_fallback_sink(spark, tmp_path):
    df = spark.range(5)
    used = write_with_fallback(
        lambda: write_store(df, "no.such.connector", table="t"), lambda: write_parquet(df, f"{tmp_path}/t")
    )
    assert used == "fallback" and spark.read.parquet(f"{tmp_path}/t").count() == 5
    assert write_with_fallback(lambda: write_parquet(df, f"{tmp_path}/u"), lambda: pytest.fail("not needed")) == "primary"


def test_snapshot_cuts_lineage(spark):
    copy = snapshot(spark.range(10).where("id > 3"))
    assert copy.count() == 6 and "Range" not in copy._jdf.queryExecution().executedPlan().toString()


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


class Session:
    """As much of a session as the choice of the scratch folder looks at."""

    def __init__(self, master, setting=None):
        self.conf = SimpleNamespace(get=lambda name, default: setting or default)
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")


def test_scratch_folder_of_a_cluster_must_be_named():
    assert shared_dir(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn"))
    local = Session("local[2]")
    assert shared_dir(local) == shared_dir(local) and os.path.isdir(shared_dir(local))


def test_report_lines(spark):
    report = training_report(
        spark.createDataFrame([(4, 1)], "total_rows long, fraud_rows long"),
        spark.createDataFrame([(0.5, "balanced")], "accuracy double, on string"),
        spark.createDataFrame([(1.0, 0.0, 3, "balanced")], "label double, prediction double, count long, on string"),
        spark.createDataFrame([("amt", 0.25)], "feature string, importance double"),
        spark.createDataFrame([("gender", "F", 3, 1)], "column string, value string, n long, rank int"),
    )
    assert [tuple(r) for r in report.collect()] == [
        ("1 dataset", "fraud_rows", "1"),
        ("1 dataset", "total_rows", "4"),
        ("2 metrics", "balanced/accuracy", "50.0000%"),
        ("3 confusion", "balanced/1/0", "3"),
        ("4 importances", "amt", "0.250000"),
        ("5 top values", "gender/01/F", "3"),
    ]


def test_two_imports_accumulate(spark, tmp_path):
    root, fraud, normal = str(tmp_path), FRAUD_TRANSACTION.monthly(), NON_FRAUD_TRANSACTION.monthly()
    rows = transactions(spark, SMALL)
    first = rows.where("pmod(hash(trans_num), 2) = 0")
    second = rows.where("pmod(hash(trans_num), 2) = 1 OR pmod(hash(trans_num), 4) = 0")
    import_transactions(first, root, "2020-06-21", fraud, normal)
    import_transactions(second, root, "2020-06-21", fraud, normal)
    stored_rows = read_segments(spark, TRANSACTION, root)
    assert stored_rows.count() == 6000 and stored_rows.select("trans_num").distinct().count() == 6000


def test_rows_without_key_are_set_apart(spark, tmp_path):
    root, fraud, normal = str(tmp_path), FRAUD_TRANSACTION.monthly(), NON_FRAUD_TRANSACTION.monthly()
    rows = transactions(spark, SMALL).withColumn("trans_date_trans_time", F.col("trans_date_trans_time").cast("string"))
    bad = F.col("cc_num") % 10 == 0
    dirty = rows.withColumn("trans_date_trans_time", F.when(bad, "not a time").otherwise(F.col("trans_date_trans_time")))
    seen = import_transactions(dirty, root, "2020-06-21", fraud, normal)
    expected = rows.where(bad).count()
    assert seen.quarantined == expected == spark.read.parquet(f"{root}/quarantine").count() > 0
    assert seen.total == 6000 == expected + read_segments(spark, TRANSACTION, root).count()


def test_history_rows_are_shuffled_once(spark, tmp_path):
    """Folders, order and last writes come of one shuffle by ranges, whether or not rows are stored already."""
    rows = snapshot(history(spark, ("1", "2020-01-01 10:00:00", "a", 1.0), ("1", "2020-01-01 10:00:00", "b", 2.0))).withColumn("trans_month", partition_value(MONTHLY))
    for table_rows, newest in ((rows, winner_order(MONTHLY)), (rows.withColumn("_new", F.lit(1)), [F.desc("_new"), *winner_order(MONTHLY)])):
        laid = _by_time(table_rows, MONTHLY, newest)
        plan = laid._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1
        assert [r.trans_num for r in laid.collect()] == ["b"] and "_new" not in laid.columns


def shuffle_sizes(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    found = (os.path.join(d, f) for top in folders for d, _, names in os.walk(str(top)) for f in names if f.startswith("shuffle_"))
    return {path: os.path.getsize(path) for path in found if os.path.exists(path)}


def test_shuffles_go_with_the_write_that_made_them(spark, tmp_path):
    """What is left is of counts and ranges, a row a task; files are removed a moment after the write."""
    rows = spark.range(50_000).withColumn("v", F.xxhash64("id"))
    before, old = spark.conf.get(DROP_SHUFFLES, None), shuffle_sizes(spark)
    kept = snapshot(rows.repartition(4, "v"))
    versions = kept.select(F.col("v").cast("string").alias("cc_num"), F.timestamp_seconds("id").alias("valid_from"), *[F.lit(None).cast(CARDHOLDER.fields[c]).alias(c) for c in CARDHOLDER_DETAILS])
    stored = SegmentTable(spark, CARDHOLDER, str(tmp_path))
    stored.upsert(versions)
    for _ in range(50):
        left = sum(size for path, size in shuffle_sizes(spark).items() if path not in old)
        if left < 100_000:
            break
        time.sleep(0.2)
    assert left < 100_000 and spark.conf.get(DROP_SHUFFLES, None) == before and stored.read().count() == 50_000


@pytest.mark.parametrize("name", ["csv_folder", "log_structured_versions", "log_structured_upserts"])
def test_copies_go_once_they_are_read(spark, name):
    def copies():
        return {d for d in os.listdir(shared_dir(spark).removeprefix("file:")) if d.startswith(("joined-", "snapshot-"))}

    before = copies()
    assert QUERIES[name](spark, SMALL).count() > 0 and copies() == before
