import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
import verify
from tideline import catalogue
from tideline.operators import quality
from tideline.oracles import ORACLES


@pytest.fixture(scope="module")
def connection():
    return verify.duck(SF_DIR)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_matches_its_sql(spark, connection, name):
    result, *_ = verify.compare(spark, connection, SF_DIR, name)
    assert result.startswith("ok"), result


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_rollup_keeps_every_fact(spark):
    rolled = entry.queries()["daily_rollup"](spark, SF_DIR).agg({"n_lines": "sum", "sum_qty": "sum"}).first()
    lines = catalogue.table(spark, SF_DIR, "lineitem").agg({"*": "count", "l_quantity": "sum"}).first()
    assert sorted(rolled) == sorted(lines)


def test_grid_is_days_times_categories(spark):
    grid = entry.queries()["dense_grid"](spark, SF_DIR)
    sizes = grid.selectExpr("count(*)", "count(distinct date) * count(distinct p_type)").first()
    assert sizes[0] == sizes[1]


@pytest.mark.parametrize(
    ("name", "keys"),
    [
        ("permits_cleaned", ["ivr_number"]),
        ("dedup_first", ["l_orderkey", "l_linenumber"]),
        ("upsert_latest", ["user_id", "event_type"]),
        ("staged_merge", ["user_id"]),
        ("weather_ingest", ["id"]),
        ("permits_by_date", ["date"]),
    ],
)
def test_keyed_outputs_are_unique_and_complete(spark, name, keys):
    out = entry.queries()[name](spark, SF_DIR)
    assert quality.duplicate_keys(out, keys).isEmpty() and quality.null_keys(out, keys).isEmpty()


def test_pages_of_listings_are_dealt_before_they_are_parsed(spark, monkeypatch):
    pages = []
    real = catalogue.ingest.listing_rows
    monkeypatch.setattr(catalogue.ingest, "listing_rows", lambda *frames: pages.extend(frames) or real(*frames))
    catalogue.QUERIES["listing_ingest"](spark, SF_DIR)
    for rendered in pages:
        assert "RepartitionByExpression" in rendered._jdf.queryExecution().optimizedPlan().toString()


def test_catalog_tables_have_more_buckets_for_more_rows(spark, monkeypatch):
    dealt = []
    real = catalogue.plain.save_bucketed
    monkeypatch.setattr(catalogue.plain, "buckets_for", lambda df: -(-df.count() // 500))
    monkeypatch.setattr(catalogue.plain, "save_bucketed", lambda df, name, keys, buckets, path: dealt.append(buckets) or real(df, name, keys, buckets, path))
    catalogue.QUERIES["catalog_tables"](spark, SF_DIR)
    lines = catalogue.table(spark, SF_DIR, "lineitem").count()
    assert dealt == [-(-lines // 500)] * 2 and dealt[0] > catalogue.FEW_BUCKETS
