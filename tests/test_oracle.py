"""Every query with SQL agrees with it; the others give rows. Training-data queries are held in tests/llm."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {n: q for n, q in entry.queries().items() if not n.startswith("op") and n != "pipeline"}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in SQL:
        assert difference(spark, con, SF_DIR, name, QUERIES[name], SQL[name]) == ""
    else:
        assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_kept_and_ledger_are_all(spark):
    from evidar.functions.gates import split
    from evidar.plans.price_queries import cleaned_orders

    every = cleaned_orders(spark, SF_DIR)
    kept, ledger = split(every)
    assert kept.count() + ledger.count() == spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
