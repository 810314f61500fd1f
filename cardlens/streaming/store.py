"""The small files that micro-batches leave, folded into few.

A batch's folder belongs to that batch until the batch is committed; Spark may write it anew.  Only batches below one that
already runs are folded: they are committed and do not come back.  Folding takes three steps, each of which can be repeated:
the rows go into the merged table as one version, a marker says up to which batch, and the next fold removes the
folders below the marker.  Until then a row is in both places and counts once, since alerts are read by key; so a reader sees every
alert at any time, and one that began before a fold finds its files for one more.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens.schema import ALERT_FIELDS, FRAUD_ALERT, INT, STRING, TIMESTAMP, KeyedTable, struct_of
from cardlens.sinks.segments import ConcurrentWrite, SegmentTable
from cardlens.workspace import list_files, put_text, remove_path

OWNER = {"query_id": STRING, "batch_id": INT}
ALERTS = "fraud_alert"
MARKERS = "fraud_alert_folded"
# a query's batches come in order, so the row written last is the one of the latest batch; rows of different queries are told apart on reading
MERGED = KeyedTable(
    name="fraud_alert_merged",
    fields={**ALERT_FIELDS, **OWNER},
    key=(*FRAUD_ALERT.key, "query_id"),
    newest=("batch_id", *FRAUD_ALERT.newest),
    partition="trans_day",
    time="trans_time",
)
FOLD_EVERY = 20
KEPT_VERSIONS = 4

# what a stream has counted so far, by minute of event time; "unknown" is the minute of records without a time
MINUTE_TOTALS = KeyedTable(
    name="minute_totals",
    fields={"minute": STRING, "query_id": STRING, "processed": T.LongType(), "fraud": T.LongType(), "first_time": TIMESTAMP, "last_time": TIMESTAMP},
    key=("minute", "query_id"),
    newest=("processed",),
    partition="key_bucket",
)


def stored_schema() -> T.StructType:
    return struct_of({**ALERT_FIELDS, **OWNER})


def batch_folders(spark: SparkSession, root: str, query_id: str) -> list[tuple[int, str]]:
    """Batch and path of every folder of the query's batches, one a day and batch; one listing a day."""
    found = []
    for day in list_files(spark, f"{root}/{ALERTS}"):
        for path in list_files(spark, f"{day}/query_id={query_id}"):
            name = path.rsplit("/", 1)[-1]
            if name.startswith("batch_id="):
                found.append((int(name.removeprefix("batch_id=")), path))
    return sorted(found)


def _markers(spark: SparkSession, root: str, query_id: str) -> list[str]:
    return sorted(path for path in list_files(spark, f"{root}/{MARKERS}/{query_id}") if not path.rsplit("/", 1)[-1].startswith("."))


def folded_below(spark: SparkSession, root: str, query_id: str) -> int:
    """All batches of the query below this one are in the merged table."""
    names = [path.rsplit("/", 1)[-1] for path in _markers(spark, root, query_id)]
    return max((int(name) for name in names if name.isdigit()), default=0)


def fold_batches(spark: SparkSession, root: str, query_id: str, below: int) -> int:
    """Fold the query's batches below ``below``, all of which must be committed, into the merged table; returns how many folders it took.

    If another query's fold gets in between, this one is left to the next time.
    """
    done = folded_below(spark, root, query_id)
    folders = batch_folders(spark, root, query_id)
    for batch, path in folders:
        if batch < done:
            remove_path(spark, path)
    fresh = [path for batch, path in folders if done <= batch < below]
    if not fresh:
        return 0
    rows = spark.read.schema(stored_schema()).option("basePath", f"{root}/{ALERTS}").parquet(*fresh)
    merged = SegmentTable(spark, MERGED, root)
    try:
        merged.upsert(rows)
    except ConcurrentWrite:
        return 0  # what of it is part of the table already is written once more next time, with the same content
    merged.vacuum(KEPT_VERSIONS)
    older = _markers(spark, root, query_id)
    put_text(spark, f"{root}/{MARKERS}/{query_id}/{below:010d}", "")
    for path in older:
        remove_path(spark, path)
    return len(fresh)


def read_merged(spark: SparkSession, root: str, day: str | None = None) -> Iterable[DataFrame]:
    """The folded rows, none where nothing was folded; of one day only the files that hold times around it are opened."""
    merged = SegmentTable(spark, MERGED, root)
    manifest = merged.manifest()
    if manifest.segments:
        if day is None:
            yield merged.read(manifest.version)
        else:
            yield merged.read_times(day, manifest.version).where(F.col("trans_day") == day)
