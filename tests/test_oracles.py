import pytest
from oracle import DATA, both

from episodica.queries import ORACLES, QUERIES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    mine, theirs = both(spark, QUERIES[name], ORACLES[name], f"{DATA}/sf0.001")
    assert mine == theirs


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 3
