"""Every query against its SQL check, whole results, exact values."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from hackney.plans import catalog, checks
from tests.compare import differences

CHECKS = checks.all_sql()


def test_every_query_has_a_check():
    assert catalog.QUERIES.keys() == CHECKS.keys()
    assert entry.queries().keys() >= CHECKS.keys()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, sf_dir, name):
    assert differences(catalog.QUERIES[name](spark, sf_dir), con, CHECKS[name]) == []


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "PULocationID"
    assert frame.count() > 0
