from __future__ import annotations

import pytest

import __spark_entry__ as contract
from fleetlens.plans.queries import QUERIES as OWN  # the corpus operators have tests of their own
from oracle import connect, difference

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    with connect(sf_dir) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_equals_sql(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert difference(df, db, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_every_sql_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    report = contract.entry(spark).collect()
    assert [r["check_name"] for r in report] == [
        "throughput",
        "latency",
        "duplicates",
        "out_of_sequence",
        "missing",
    ]
