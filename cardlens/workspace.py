"""Shared scratch space: the folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, which every executor can reach.

    Only a local session without the setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_dirs:
        _own_dirs[application] = tempfile.mkdtemp(prefix="cardlens-")
    return _own_dirs[application]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; never reused between runs."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path of our own through the file system that holds it."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files directly below a folder; none where there is no such folder."""
    files, target = _file_system(spark, path)
    return [str(status.getPath()) for status in files.listStatus(target)] if files.exists(target) else []


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file up as a whole: it is written under another name and renamed; False if the name is taken."""
    files, target = _file_system(spark, path)
    if files.exists(target):
        return False
    _, draft = _file_system(spark, f"{path}.{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()
    return files.rename(draft, target)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes within are removed as each write ends, whatever way it ends.

    Else they lie on the executors' disks until the driver next collects its garbage, which a driver that holds little does seldom:
    a job of several writes would need room for the shuffles of all of them at once.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def snapshot(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back: one computation, short lineage.

    Unlike a cache this survives the loss of executors, and later passes read
    only the columns they need.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "snapshot")
    with passing_shuffles(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_snapshot(copy: DataFrame) -> None:
    """Delete the scratch copy that ``snapshot`` returned, once nothing reads it any more; other files are left alone."""
    for folder in {unquote(file.rsplit("/", 1)[0]) for file in copy.inputFiles()}:
        if folder.rsplit("/", 1)[-1].startswith("snapshot-"):
            remove_path(copy.sparkSession, folder)
