import pytest

from tests.compare import connect, differences
from tideline import catalogue as q


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    n, found = differences(spark, connect(sf_dir), q.queries()[name], q.oracle_sql()[name], sf_dir)
    assert n and not found, found


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(q.oracle_sql())))
def test_query_has_rows(spark, sf_dir, name):
    assert q.queries()[name](spark, sf_dir).count() > 0


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
