"""The transaction record and the keyed tables derived from it."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

STRING, INT, DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()
TIMESTAMP = T.TimestampType()

# Field names, order and types of the transaction record.
TRANSACTION_FIELDS = {
    "trans_num": STRING,
    "trans_date_trans_time": STRING,
    "cc_num": STRING,
    "merchant": STRING,
    "category": STRING,
    "amt": DOUBLE,
    "first": STRING,
    "last": STRING,
    "gender": STRING,
    "street": STRING,
    "city": STRING,
    "state": STRING,
    "zip": STRING,
    "lat": DOUBLE,
    "long": DOUBLE,
    "city_pop": INT,
    "job": STRING,
    "dob": STRING,
    "merch_lat": DOUBLE,
    "merch_long": DOUBLE,
    "is_fraud": INT,
}
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
INDEX_COLUMNS = ("_c0", "Unnamed: 0")

# Columns of the keyed tables.
CUSTOMER_COLUMNS = (
    "cc_num", "first", "last", "gender", "street", "city", "state",
    "zip", "lat", "long", "job", "dob",
)
HISTORY_FIELDS = {
    "cc_num": STRING,
    "trans_time": TIMESTAMP,
    "trans_num": STRING,
    "category": STRING,
    "merchant": STRING,
    "amt": DOUBLE,
    "merch_lat": DOUBLE,
    "merch_long": DOUBLE,
    "distance": DOUBLE,
    "age": INT,
    "is_fraud": DOUBLE,
}
ALERT_FIELDS = {
    "trans_day": STRING,
    "trans_time": TIMESTAMP,
    "trans_num": STRING,
    "cc_num": STRING,
    "merchant": STRING,
    "category": STRING,
    "amt": DOUBLE,
    "is_fraud": DOUBLE,
    "prediction_score": DOUBLE,
}


def struct_of(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def transaction_schema() -> T.StructType:
    """All 21 fields, all nullable; used by the CSV, Parquet and message paths alike."""
    return struct_of(TRANSACTION_FIELDS)


@dataclass(frozen=True)
class KeyedTable:
    """A table with one row per ``key``; on conflict the row first in ``newest`` wins.

    ``partition`` is the folder column.  It must be a function of ``key`` so that
    both versions of a row always meet in the same folder: the day or month of
    ``time`` where that column is in the key, else a hash bucket of the key.
    """

    name: str
    fields: dict[str, T.DataType]
    key: tuple[str, ...]
    newest: tuple[str, ...]
    partition: str
    time: str | None = None
    time_format: str = DATE_FORMAT
    buckets: int = 64

    def schema(self) -> T.StructType:
        fields = dict(self.fields)
        fields.setdefault(self.partition, STRING if self.time else INT)
        return struct_of(fields)

    def monthly(self) -> KeyedTable:
        """The same table with a folder a month, for data too thin for a folder a day."""
        return replace(self, partition="trans_month", time_format="yyyy-MM")


CUSTOMER = KeyedTable(
    name="customer",
    fields={
        **{name: TRANSACTION_FIELDS[name] for name in CUSTOMER_COLUMNS},
        "dob": TIMESTAMP,
    },
    key=("cc_num",),
    newest=("street", "city", "state", "zip", "last", "first", "job", "gender", "lat", "long", "dob"),
    partition="key_bucket",
)
FRAUD_TRANSACTION = KeyedTable(
    name="fraud_transaction",
    fields=HISTORY_FIELDS,
    key=("cc_num", "trans_time"),
    newest=("trans_num",),
    partition="trans_day",
    time="trans_time",
)
NON_FRAUD_TRANSACTION = KeyedTable(
    name="non_fraud_transaction",
    fields=HISTORY_FIELDS,
    key=("cc_num", "trans_time"),
    newest=("trans_num",),
    partition="trans_day",
    time="trans_time",
)
FRAUD_ALERT = KeyedTable(
    name="fraud_alert",
    fields=ALERT_FIELDS,
    key=("trans_day", "trans_time", "trans_num"),
    newest=("prediction_score", "cc_num"),
    partition="trans_day",
    time="trans_time",
)
# the full record, one row per transaction however often it is imported
TRANSACTION = KeyedTable(
    name="transactions",
    fields=TRANSACTION_FIELDS,
    key=("trans_num",),
    newest=("trans_date_trans_time", "cc_num", "amt", "merchant"),
    partition="key_bucket",
)
# what training needs of a cardholder, from ``valid_from`` until the card's next row
CARDHOLDER_DETAILS = ("gender", "lat", "long", "city_pop", "dob")
CARDHOLDER = KeyedTable(
    name="cardholder",
    fields={"cc_num": STRING, "valid_from": TIMESTAMP, **{name: TRANSACTION_FIELDS[name] for name in CARDHOLDER_DETAILS}},
    key=("cc_num", "valid_from"),
    newest=CARDHOLDER_DETAILS,
    partition="valid_day",
    time="valid_from",
)
KEYED_TABLES = {t.name: t for t in (CUSTOMER, FRAUD_TRANSACTION, NON_FRAUD_TRANSACTION, FRAUD_ALERT)}
