"""Resumable writes: a store that fails, one that is not there, and errors that are not the store's."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from cardlens.sinks.external import export_table, with_retries, write_chunks
from cardlens.sinks.files import write_with_fallback
from cardlens.workspace import list_files


def failing_store(name, fails):
    """A store whose writes show all their rows on commit, and whose first ``fails`` writes break half way."""

    class Writer(DataSourceWriter):
        def __init__(self, path):
            self.path = path

        def write(self, rows):
            os.makedirs(f"{self.path}/staged", exist_ok=True)
            staged = f"{self.path}/staged/{uuid.uuid4().hex}"
            with open(staged, "w") as out:
                for row in rows:
                    out.write(f"{row.id}\n")
            if len(os.listdir(self.path)) <= fails:
                open(f"{self.path}/failed-{uuid.uuid4().hex}", "w").close()
                raise OSError("store is down")
            message = WriterCommitMessage()
            message.file = staged
            return message

        def commit(self, messages):
            for message in messages:
                os.rename(message.file, message.file.replace("/staged/", "/rows-"))

        def abort(self, messages):
            pass

    class Store(DataSource):
        @classmethod
        def name(cls):
            return name

        def writer(self, schema, overwrite):
            return Writer(self.options["path"])

    return Store


def stored(path):
    names = [n for n in os.listdir(path) if n.startswith("rows-")]
    return sorted(int(line) for n in names for line in open(f"{path}/{n}"))


def test_a_store_that_fails_twice_gets_every_row_once(spark, tmp_path):
    spark.dataSource.register(failing_store("fails_twice", 2))
    path = tmp_path / "store"
    path.mkdir()
    df = spark.range(0, 100, 1, 1)
    assert export_table(df, "t", str(tmp_path), "fails_twice", chunks=3, wait=0.01, path=str(path)) == "primary"
    assert stored(path) == list(range(100)) and any(n.startswith("failed-") for n in os.listdir(path))
    assert export_table(df, "t", str(tmp_path), "fails_twice", chunks=3, path=str(path)) == "primary"
    assert stored(path) == list(range(100))  # the ledger knows that all of it is there


def test_a_run_goes_on_where_the_last_one_failed(spark, tmp_path):
    taken, broken = [], {2}

    def write(rows, number):
        if number in broken:
            raise OSError("store is down")
        taken.extend((number, r.id) for r in rows.collect())

    with pytest.raises(OSError):
        write_chunks(spark.range(60), f"{tmp_path}/l", write, chunks=4, attempts=2, wait=0)
    assert {n for n, _ in taken} == {0, 1}
    broken.clear()
    other = spark.range(1000)  # the rows of the first run are written, whatever the source gives now
    assert write_chunks(other, f"{tmp_path}/l", write, chunks=9, wait=0) == [2, 3]
    assert sorted(i for _, i in taken) == list(range(60)) and not list_files(spark, f"{tmp_path}/l/rows")
    assert write_chunks(other, f"{tmp_path}/l", write) == []


def test_waits_are_bounded_and_double():
    waits, calls = [], []

    def write():
        calls.append(1)
        raise OSError("store is down")

    with pytest.raises(OSError):
        with_retries(write, attempts=4, wait=1.0, sleep=waits.append)
    assert waits == [1.0, 2.0, 4.0] and len(calls) == 4


def test_errors_that_are_not_the_stores(spark, tmp_path):
    calls = []
    with pytest.raises(ZeroDivisionError):
        with_retries(lambda: calls.append(1) or 1 / 0, wait=0)
    with pytest.raises(ZeroDivisionError):
        write_with_fallback(lambda: 1 / 0, lambda: pytest.fail("not the store's error"))
    assert len(calls) == 1


def test_a_connector_that_is_not_there(spark, tmp_path):
    df = spark.range(5).withColumn("v", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        with_retries(lambda: df.write.format("no.such.connector").save(), sleep=lambda s: pytest.fail("no use to wait"))
    assert export_table(df, "t", str(tmp_path), "no.such.connector", chunks=2, wait=0, table="t") == "fallback"
    assert spark.read.parquet(f"{tmp_path}/fallback/t").count() == 5


def test_no_rows(spark, tmp_path):
    assert write_chunks(spark.range(0), f"{tmp_path}/l", lambda rows, n: pytest.fail("nothing to write"), chunks=3) == []
