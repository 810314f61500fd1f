"""The pruned left joins give the rows of the full inner join."""

import pytest
from pyspark.sql import functions as F

from checks import tables
from checks.tables import TRANSACTION_COLUMNS, table, transactions
from tests.conftest import SMALL


def test_left_joins_equal_inner_joins(spark, monkeypatch):
    from checks import tables

    left = transactions(spark, SMALL)
    inner_sql = tables.transactions_sql(tuple(TRANSACTION_COLUMNS), "spark").replace("LEFT JOIN", "JOIN")
    inner = tables._run(spark, SMALL, inner_sql)
    assert left.exceptAll(inner).isEmpty() and inner.exceptAll(left).isEmpty()


@pytest.mark.parametrize("columns", [("trans_num", "amt"), ("cc_num", "state"), ("category", "city"), ("merchant", "job")])
def test_pruned_columns_equal_full_view(spark, columns):
    full, pruned = transactions(spark, SMALL).select(*columns), transactions(spark, SMALL, *columns)
    assert full.exceptAll(pruned).isEmpty() and pruned.exceptAll(full).isEmpty()


@pytest.mark.parametrize(
    "name, key", [("orders", "o_orderkey"), ("customer", "c_custkey"), ("nation", "n_nationkey"), ("part", "p_partkey"), ("supplier", "s_suppkey")]
)
def test_lookups_are_unique(spark, name, key):
    rows = table(spark, SMALL, name)
    assert rows.count() == rows.select(key).distinct().count()


def test_trans_num_is_unique(spark):
    rows = transactions(spark, SMALL, "trans_num")
    assert rows.count() == rows.distinct().count() == 6000


def test_line_items_are_narrow_where_they_are_shuffled(spark):
    """Parts are joined before orders, and the flag's three columns do not go through a shuffle."""
    plan = transactions(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = {key: next(i for i, line in enumerate(plan) if "Join LeftOuter" in line and key in line) for key in ("p_partkey", "o_orderkey", "s_suppkey")}
    assert join["s_suppkey"] < join["o_orderkey"] < join["p_partkey"]  # the innermost join comes last
    assert not any(c in line for line in plan[: join["p_partkey"]] for c in ("l_tax", "l_discount", "l_returnflag"))


def test_order_of_joins_changes_no_row(spark, tmp_path):
    """With keys that are missing, that lead nowhere, and that come twice."""
    kinds = {name: table(spark, SMALL, name).schema for name in ("lineitem", "orders", "customer", "nation", "supplier", "part")}
    doubled = {"orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey", "supplier": "s_suppkey", "part": "p_partkey"}
    for name, schema in kinds.items():
        rows = table(spark, SMALL, name).limit(40)
        if name == "lineitem":
            n = F.monotonically_increasing_id()
            keys = {"l_orderkey": 1 + n % 9, "l_partkey": 1 + n % 7, "l_suppkey": 1 + n % 5}
            rows = rows.withColumns({c: F.when(n % (11 + i) != 0, v) for i, (c, v) in enumerate(keys.items())})
        else:
            key = doubled[name]
            rows = rows.withColumn(key, F.when(F.monotonically_increasing_id() % 8 != 0, 1 + F.monotonically_increasing_id() % 6))
            rows = rows.withColumn("o_custkey", 1 + F.col("o_custkey") % 8) if name == "orders" else rows
        rows.select([F.col(f.name).cast(f.dataType) for f in schema]).write.parquet(f"{tmp_path}/{name}.parquet")
    for dirty in (False, True):
        columns = (*TRANSACTION_COLUMNS, *(["time_text"] if dirty else []))
        made, expected = transactions(spark, str(tmp_path), *columns, dirty=dirty), tables._run(spark, str(tmp_path), tables.transactions_sql(columns, "spark", dirty))
        assert made.schema == expected.schema and made.count() == expected.count() > 40
        assert made.exceptAll(expected).isEmpty()
