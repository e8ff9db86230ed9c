"""The physical plans the library relies on."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyloom.catalog import health, ledger, market, search, sensors
from tallyloom.operators import patterns
from tallyloom.plans.ledger_store import LedgerStore
from tallyloom.plans.timetable import TimeTable
from tallyloom.sources import views
from tests.conftest import DATA


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_reach_the_scan_and_columns_are_pruned(spark):
    text = plan(market.candles_1d(spark, DATA))
    assert "EqualTo(event_type,purchase)" in text and "GreaterThanOrEqual(ts,2024-0" in text
    # one shuffle for the buckets, one to put them in order
    assert "event_id" not in text and text.count("Exchange hashpartitioning") == 1 and text.count("Exchange") == 2


def test_one_shuffle_for_a_summary(spark):
    for query in (health.daily_health_summary, sensors.sensor_30m_last):
        text = plan(query(spark, DATA))
        assert text.count("Exchange hashpartitioning") == 1, text


def test_facts_are_reduced_before_the_dimension(spark):
    """One shuffle of partial rows by bucket and key, and one of joined partials by bucket and attribute."""
    for query in (sensors.sensor_by_location, health.daily_activity):
        text = plan(query(spark, DATA))
        assert text.count("Exchange hashpartitioning") == 2, text


def test_top_k_needs_no_sort(spark):
    for query in (health.latest_readings, ledger.recent_for_address, search.vector_topk):
        text = plan(query(spark, DATA))
        assert "TakeOrderedAndProject" in text
    assert "Exchange" not in plan(search.vector_topk(spark, DATA))


def test_newest_ticks_are_a_partial_top_k(spark):
    text = plan(market.ticks_with_asset(spark, DATA))
    assert "TakeOrderedAndProject" in text and "Window" not in text and "Sort" not in text


def test_no_query_pairs_everything(spark, no_broadcast):
    for query in (ledger.flow_trace, ledger.exchange_like, ledger.dust_spam, health.sleep_next_day_hr, search.vector_knn_batch):
        text = plan(query(spark, DATA))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_the_parties_are_shuffled_once(spark, no_broadcast):
    df = patterns.exchange_like(views.tx_vinout(spark, DATA), 0, 0)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_distance_is_computed_once_after_the_box(spark):
    text = plan(search.stations_within_ellipsoid(spark, DATA))
    assert text.count("ArrowEvalPython") == 1
    assert text.index("ArrowEvalPython") < text.index("40.4224")


def test_compacted_files_carry_min_and_max(spark, tmp_path):
    table = TimeTable("s", str(tmp_path / "t"), sensors.SENSOR_SCHEMA, "time", ("sensor_id",), ("time DESC",))
    table.load(views.sensor_data(spark, DATA)).compact(spark)
    file = pq.ParquetFile(next((tmp_path / "t" / "hot").rglob("*.parquet")))
    assert file.metadata.row_group(0).column(1).statistics.has_min_max
    text = plan(table.read(spark).where(F.col("temperature") > 100))
    assert "GreaterThan(temperature,100.0)" in text


def test_texts_of_a_search_are_looked_up_by_id(spark):
    from tallyloom.operators.search import nearest, nearest_with
    reports = views.reports(spark, DATA)
    first = plan(nearest(reports.select("id", "embedding"), search.QUERY, 10))
    assert "TakeOrderedAndProject" in first and "text" not in first
    lookup = plan(nearest_with(reports, search.QUERY, ["description"], 10))
    assert "In(doc_id" in lookup and "embedding" not in lookup.replace("embeddings.parquet", "")


def test_exchanges_are_sketched_once(spark):
    text = plan(ledger.exchange_counterparties(spark, DATA))
    assert "hll" not in text and "lineitem" not in text


def test_a_ledger_without_hot_keys_is_shuffled_by_its_buckets_only(spark, no_broadcast, monkeypatch):
    written = []
    monkeypatch.setattr(LedgerStore, "_write", lambda self, table, kind, keys, buckets: written.append(plan(table)))
    LedgerStore.build(views.tx_vinout(spark, DATA), buckets=4)
    assert len(written) == 2 and not any("Join" in text or "Exchange" in text for text in written)
