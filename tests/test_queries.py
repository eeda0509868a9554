import pytest

import __spark_entry__ as entry_point
from compare import connect, difference


@pytest.fixture(scope="module")
def engine(folder):
    return connect(folder)


def test_every_statement_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_flagship(spark):
    assert entry_point.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, folder, engine, name):
    result = entry_point.queries()[name](spark, folder)
    statement = entry_point.oracle_sql().get(name)
    if statement is None:
        assert result.count() > 0
    else:
        assert difference(result, engine, statement) is None
