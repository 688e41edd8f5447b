"""Every query that SQL can express gives what the SQL gives, to the last value."""

import pytest

import __spark_entry__ as entry
from emberlog.operators import joins, quantiles, windows
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert differences(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert not entry.queries()[name](spark, sf_dir).isEmpty()


@pytest.mark.parametrize("name", ["scored_context", "signature_rarity", "payload_score", "service_percentiles",
                                  "incident_labels", "zscore_alerts", "top_n_per_hour"])
def test_query_equals_sql_when_nothing_fits(spark, sf_dir, con, name, monkeypatch):
    """No broadcast by size, many hot keys, short chunks: the ways taken on big data give the same."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(quantiles, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_KEYS", 20)
    monkeypatch.setattr(windows, "CHUNK_ROWS", 500)
    assert differences(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
