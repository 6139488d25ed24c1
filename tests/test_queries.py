"""Every registered query against its SQL, on the whole tables."""

from __future__ import annotations

import pytest

from compare import assert_same, connect

import __spark_entry__ as contract
from rowfold import registry

SF_DIR = "/root/testdata/sf0.01"
registry.load_all()
# those of the corpus operators have tests of their own
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert_same(QUERIES[name](spark, SF_DIR), duck, ORACLES[name])


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    report = contract.entry(spark)
    totals = report.agg({"rows": "sum", "new": "sum"}).first()
    assert set(totals.asDict().values()) and report.count() > 1
