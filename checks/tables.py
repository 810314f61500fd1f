"""The given tables in the shape of card transactions, one text for both SQL engines.

A transaction is a line item; its order names the card.  The other tables are looked
up by their primary key with left joins, so a lookup neither drops nor multiplies
rows, and a table that no wanted column needs is left out of the query.  Orders meet
customers before they meet line items, so no customer can skew the large side.  Spark
leaves left joins in the order in which they stand; they hang on the line item alone, so any
order gives the same rows, and ``transactions`` takes the one in which line items are
narrow where they are shuffled: parts bring the fewest columns and come first, suppliers last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLAG = "is_fraud"
BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

DIALECTS = {
    "spark": {
        "TS": "l_shipdate + make_dt_interval(0,0,0,cast((l_partkey*7919+l_orderkey*104729)%86400 as decimal(18,6)))",
        "DOB": "date_add(DATE'1940-01-01', cast({card}*37%22000 as int))",
        "TEXT_TIME": "date_format(ts,'yyyy-MM-dd HH:mm:ss')",
        "K": "get_json_object(props,'$.k')",
    },
    "duckdb": {
        "TS": "l_shipdate + to_seconds((l_partkey*7919+l_orderkey*104729)%86400)",
        "DOB": "DATE'1940-01-01' + cast({card}*37%22000 as int)",
        "TEXT_TIME": "strftime(ts,'%Y-%m-%d %H:%M:%S')",
        "K": "json_extract_string(props,'$.k')",
    },
}


def _card_columns(card: str, merchant: str) -> dict[str, str]:
    """Columns that follow from the card's and the merchant's number."""
    lat, long = f"25.0e0+({card}*17%2400)/1e2", f"-124.0e0+({card}*29%5700)/1e2"
    return {
        "gender": f"CASE WHEN {card}%2=0 THEN 'M' ELSE 'F' END",
        "street": f"concat({card},' Main St')",
        "zip": f"lpad(cast({card}%100000 as varchar(10)),5,'0')",
        "lat": lat,
        "long": long,
        "dob": f"@DOB:{card}@",
        "merch_lat": f"{lat}+(({merchant}*13%200)-100)/1e2",
        "merch_long": f"{long}+(({merchant}*31%200)-100)/1e2",
    }


# column: (expression, tables it needs besides lineitem)
TRANSACTION_COLUMNS = {
    "trans_num": (
        "concat(l_orderkey,'-',l_linenumber,'-',l_partkey,'-',l_suppkey,'-',cast(cast(l_shipdate as date) as varchar(10)))",
        (),
    ),
    "trans_date_trans_time": ("@TS@", ()),
    "cc_num": ("o_custkey", ("orders",)),
    "merchant": ("s_name", ("supplier",)),
    "category": ("p_type", ("part",)),
    "amt": ("l_extendedprice", ()),
    "first": ("c_name", ("orders", "customer")),
    "last": ("o_orderpriority", ("orders",)),
    **{name: (text, ("orders",)) for name, text in _card_columns("o_custkey", "l_suppkey").items()},
    "job": ("c_mktsegment", ("orders", "customer")),
    "city": ("p_brand", ("part",)),
    "state": ("n_name", ("orders", "customer", "nation")),
    "city_pop": ("cast(c_nationkey*12345+1000 as int)", ("orders", "customer")),
    "is_fraud": (
        "cast(CASE WHEN l_returnflag='R' AND (l_extendedprice>90000 OR (l_discount>=0.09 AND l_tax>=0.07))"
        " THEN 1 ELSE 0 END as int)",
        (),
    ),
}
# the same with some values missing, some times unreadable
DIRTY_COLUMNS = {
    "time_text": (
        "CASE WHEN o_custkey%101=0 THEN 'not a time' WHEN o_custkey%103=0 THEN NULL ELSE cast(@TS@ as varchar(19)) END",
        ("orders",),
    ),
    "merchant": ("CASE WHEN o_custkey%97=0 THEN NULL ELSE s_name END", ("orders", "supplier")),
    "category": ("CASE WHEN o_custkey%89=0 THEN NULL ELSE p_type END", ("orders", "part")),
    "amt": ("CASE WHEN o_custkey%83=0 THEN NULL ELSE l_extendedprice END", ("orders",)),
    "gender": ("CASE WHEN o_custkey%79=0 THEN NULL WHEN o_custkey%2=0 THEN 'M' ELSE 'F' END", ("orders",)),
    "state": ("CASE WHEN o_custkey%73=0 THEN NULL ELSE n_name END", ("orders", "customer", "nation")),
    "lat": ("CASE WHEN o_custkey%71=0 THEN NULL ELSE 25.0e0+(o_custkey*17%2400)/1e2 END", ("orders",)),
}
EVENT_COLUMNS = {
    "trans_num": "cast(event_id as varchar(20))",
    "trans_date_trans_time": "@TEXT_TIME@",
    "cc_num": "cast(user_id as varchar(20))",
    "merchant": "concat('merchant_',event_id%97)",
    "category": "event_type",
    "amt": "value",
    **_card_columns("user_id", "event_id"),
    "city_pop": "cast(user_id*31%9000+1000 as int)",
    "is_fraud": "cast(CASE WHEN value>150 OR cast(@K@ as int)<1 THEN 1 ELSE 0 END as int)",
}


def _fill(text: str, dialect: str) -> str:
    forms = DIALECTS[dialect]
    for name in ("TS", "TEXT_TIME", "K"):
        text = text.replace(f"@{name}@", forms[name])
    while "@DOB:" in text:
        card = text.split("@DOB:", 1)[1].split("@", 1)[0]
        text = text.replace(f"@DOB:{card}@", forms["DOB"].replace("{card}", card))
    return text


def transactions_sql(columns: tuple[str, ...], dialect: str, dirty: bool = False) -> str:
    source = {**TRANSACTION_COLUMNS, **DIRTY_COLUMNS} if dirty else TRANSACTION_COLUMNS
    needed = {table for c in columns for table in source[c][1]}
    orders = "orders"
    if "customer" in needed:
        orders += " LEFT JOIN customer ON o_custkey=c_custkey"
    if "nation" in needed:
        orders += " LEFT JOIN nation ON c_nationkey=n_nationkey"
    joins = ""
    if "orders" in needed:
        joins += f" LEFT JOIN ({orders}) ON l_orderkey=o_orderkey" if orders != "orders" else " LEFT JOIN orders ON l_orderkey=o_orderkey"
    if "supplier" in needed:
        joins += " LEFT JOIN supplier ON l_suppkey=s_suppkey"
    if "part" in needed:
        joins += " LEFT JOIN part ON l_partkey=p_partkey"
    picked = ", ".join(f"{source[c][0]} AS {c}" for c in columns)
    return _fill(f"SELECT {picked} FROM lineitem{joins}", dialect)


def events_sql(dialect: str) -> str:
    return _fill("SELECT " + ", ".join(f"{text} AS {c}" for c, text in EVENT_COLUMNS.items()) + " FROM events", dialect)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    words = set(sql.replace("(", " ").replace(")", " ").split())
    frames = {name: table(spark, sf_dir, name) for name in BASE_TABLES if name in words}
    named = sql
    for name in frames:
        for before in ("FROM ", "JOIN ", "JOIN ("):
            named = named.replace(f"{before}{name}", f"{before}{{{name}}}")
    return spark.sql(named, **frames)


def transactions(spark: SparkSession, sf_dir: str, *columns: str, dirty: bool = False) -> DataFrame:
    """The rows of ``transactions_sql``, with the joins in the order that shuffles least."""
    columns = columns or tuple(TRANSACTION_COLUMNS)
    source = {**TRANSACTION_COLUMNS, **DIRTY_COLUMNS} if dirty else TRANSACTION_COLUMNS
    needed = {name for c in columns for name in source[c][1]}
    texts = {c: source[c][0] for c in columns}
    frames = {name: table(spark, sf_dir, name) for name in ("lineitem", *sorted(needed))}

    def looked_up(rows: DataFrame, name: str, on: str) -> DataFrame:
        return rows.join(frames[name], F.expr(on), "left") if name in needed else rows

    rows = frames["lineitem"]
    if FLAG in texts:  # one number goes through the shuffles in place of the three columns it is made of
        rows, texts[FLAG] = rows.withColumn(FLAG, F.expr(_fill(texts[FLAG], "spark"))), FLAG
    rows = looked_up(rows, "part", "l_partkey = p_partkey")
    if "orders" in needed:
        frames["orders"] = looked_up(looked_up(frames["orders"], "customer", "o_custkey = c_custkey"), "nation", "c_nationkey = n_nationkey")
    rows = looked_up(looked_up(rows, "orders", "l_orderkey = o_orderkey"), "supplier", "l_suppkey = s_suppkey")
    return rows.selectExpr(*[f"{_fill(text, 'spark')} AS {c}" for c, text in texts.items()])


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, events_sql("spark"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a stream, in the same columns."""
    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.selectExpr(*[_fill(f"{text} AS {c}", "spark") for c, text in EVENT_COLUMNS.items()])
