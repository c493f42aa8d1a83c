"""Every registered query against its SQL, or at least run."""

import pytest
from helpers import same_as_sql

import __spark_entry__
from tickerforge.plans import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, name):
    if name in registry.ORACLES:
        same_as_sql(spark, sf_dir, registry.QUERIES[name], registry.ORACLES[name])
    else:
        assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_oracles_have_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
