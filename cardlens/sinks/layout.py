"""History and cardholders laid out by card, so that joining them moves neither."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens.operators.cardholders import HOT_SHARE, as_of_time, as_of_time_salted, hot_cards
from cardlens.workspace import passing_shuffles, snapshot

CARD_BUCKETS = 64


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Parquet files that each hold one bucket of ``key``; a bucket with most of the rows is written by several tasks."""
    name = f"bucketed_{uuid.uuid4().hex}"
    spread = df.hint("rebalance", buckets, F.col(key))
    with passing_shuffles(df.sparkSession):
        spread.write.bucketBy(buckets, key).sortBy(key).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the files stay: a table with a path of its own is external


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The files of ``write_bucketed`` with their layout, which Spark takes from a table's definition only."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{where}'")
    return spark.table(name)


@dataclass(frozen=True)
class CardLayout:
    """Where the parts lie: most cards in buckets, the few hot ones beside them."""

    path: str
    buckets: int
    history: T.StructType
    versions: T.StructType

    def transactions(self, spark: SparkSession) -> DataFrame:
        """All transactions with their cardholder as of their time.

        The bucketed sides meet without an exchange.  A bucket is read by one task, so hot cards are not in
        them: these are dealt over many tasks.
        """
        cold = as_of_time(
            read_bucketed(spark, f"{self.path}/history", self.history, "cc_num", self.buckets),
            read_bucketed(spark, f"{self.path}/versions", self.versions, "cc_num", self.buckets),
        )
        hot = as_of_time_salted(
            spark.read.schema(self.history).parquet(f"{self.path}/hot_history"), spark.read.schema(self.versions).parquet(f"{self.path}/hot_versions")
        )
        return cold.unionByName(hot)


def lay_out_by_card(history: DataFrame, versions: DataFrame, path: str, buckets: int = CARD_BUCKETS, share: int = HOT_SHARE) -> CardLayout:
    """Write both sides below ``path``; ``buckets`` is for the caller to choose by the history's size."""
    hot = F.broadcast(snapshot(hot_cards(history, share), f"{path}/hot"))  # fewer than ``share`` rows
    for name, df in (("history", history), ("versions", versions)):
        write_bucketed(df.join(hot, "cc_num", "left_anti"), f"{path}/{name}", "cc_num", buckets)
        with passing_shuffles(df.sparkSession):
            df.join(hot, "cc_num", "left_semi").write.option("compression", "zstd").parquet(f"{path}/hot_{name}")
    return CardLayout(path, buckets, history.schema, versions.schema)
