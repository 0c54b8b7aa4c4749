"""Every query against its SQL."""

import pytest

from decisionloom.plans import catalogue
from tests.conftest import DATA, compared


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    got, expected = compared(spark, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).count() > 0


def test_entry_works(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
