"""Every query with SQL gives the rows that the SQL gives."""

import pytest

from meterwatch.plans.catalog import ORACLES, QUERIES
from tests.compare import differences
from tests.conftest import SF_DIR


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, key):
    assert differences(con, QUERIES[key](spark, SF_DIR), ORACLES[key]) == []


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, key):
    assert QUERIES[key](spark, SF_DIR).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    flagship = entry.entry(spark)
    assert flagship.count() > 0 and "fraud_score" in flagship.columns
