"""Every query with SQL equals the independent engine's answer on the smallest tables.

``CHECK_SF_DIR`` points the same tests at larger ones.
"""

import os

import pytest

from checks.compare import differences, oracle_frame
from checks.oracle import ORACLE
from checks.queries import QUERIES
from tests.conftest import SMALL

FOLDER = os.environ.get("CHECK_SF_DIR", SMALL)
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    actual = QUERIES[name](spark, FOLDER).toPandas()
    assert differences(actual, oracle_frame(FOLDER, ORACLE[name])) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 20
    assert set(contract.oracle_sql()) <= set(contract.queries())
