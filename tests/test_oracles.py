"""Every registered query against its SQL, over whole tables."""

import pytest
from oracle_check import connect, difference

from claimloom.oracles import ORACLES
from claimloom.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_registry(spark):
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"classifier_accuracy"}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
