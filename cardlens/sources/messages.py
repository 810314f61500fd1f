"""JSON records on a message topic, as a batch or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens.schema import STRING, transaction_schema

MALFORMED = "_malformed"


def read_topic(
    spark: SparkSession,
    brokers: str,
    topic: str,
    starting_offsets: str = "earliest",
    stream: bool = True,
    **options: str,
) -> DataFrame:
    """A Kafka topic.  Lost offsets stop the query unless ``failOnDataLoss`` says otherwise; options are passed through."""
    reader = spark.readStream if stream else spark.read
    settings = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        **options,
    }
    return reader.format("kafka").options(**settings).load()


def read_message_files(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of text files, one record a line, in the topic's ``value`` form."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder).select(F.col("value").cast("binary").alias("value"))


def decode_json(df: DataFrame, schema: T.StructType | None = None, value: str = "value") -> DataFrame:
    """Fields of the JSON records, and ``_malformed``: the raw text of a record that is none.

    Numbers sent for text fields are read as text.  A record with one field of a
    wrong type is malformed as a whole, with the fields that fit kept.

    The fields come out of ``inline``, so that a later filter on them stays above the
    parser; out of a plain projection it would be pushed below and parse a second time.
    """
    schema = transaction_schema() if schema is None else schema
    read = T.StructType([*schema.fields, T.StructField(MALFORMED, STRING, True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    record = F.from_json(F.col(value).cast("string"), read, options)
    return df.select(*[c for c in df.columns if c != value], F.inline(F.array(record)))


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def malformed(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("record"))


def encode_json(df: DataFrame) -> DataFrame:
    """Rows as JSON in a ``value`` column; NaN and missing numbers become null."""

    def clean(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.nanvl(column, F.lit(None).cast(field.dataType))
        return column.alias(field.name)

    record = F.struct(*[clean(f) for f in df.schema.fields])
    return df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))
