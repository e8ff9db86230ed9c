"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect
from tests.conftest import DATA

SQL = entry.oracle_sql()
# answers that are empty on the smallest tables
SPARSE = {"exchange_like", "recent_rows", "dust_spam", "semantic_search_filtered", "anomalous_tx", "tx_in_block",
          "tx_by_id", "tx_inouts", "miner_of_block", "health_alerts", "hr_variability", "sensor_30m_one",
          "count_exclusion", "consolidations", "ticks_with_asset", "orphan_rows"}


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    problem = compare(spark, duck, name, entry.queries()[name], SQL.get(name), DATA)
    assert not problem or (problem == "both empty" and name in SPARSE), problem


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["bucket", "symbol", "open", "high", "low", "close", "day_volume"]
    assert df.count() > 0


def test_sql_names_are_queries():
    assert set(SQL) <= set(entry.queries())
