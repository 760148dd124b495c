"""Every registered query against its DuckDB oracle (TEST_SF_DIR picks the scale)."""

import pytest

from checks.compare import difference, oracle_connection
from checks.oracle import oracle_sql
from checks.queries import registry


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(registry()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(registry()))
def test_query(spark, sf_dir, duck, name):
    assert difference(registry()[name](spark, sf_dir), duck, oracle_sql()[name]) is None


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert set(registry()) <= set(contract.queries()) and set(oracle_sql()) <= set(contract.oracle_sql())
    assert contract.entry(spark).columns == [
        "products_id", "products_model", "products_quantity", "products_weight", "products_price"
    ]
