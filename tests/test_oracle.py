import pytest

import __spark_entry__ as entry
from catalog.queries import QUERIES as CATALOG
from tests.compare import compare, connect
from tests.conftest import FOLDER

SQL = entry.oracle_sql()
QUERIES = {name: entry.queries()[name] for name in CATALOG}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_statement(spark, duck, name):
    _, _, problem = compare(spark, duck, FOLDER, name, QUERIES[name], SQL.get(name))
    assert problem is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(SQL)
