"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as entry
from laminar.plans.registry import QUERIES
from tests.conftest import SF_CHECK, SF_SMALL
from tests.parity import compare, duck

KEYS = list(QUERIES)  # the text queries have their own tests


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


def test_every_query_has_oracle_or_is_rows_only():
    assert not set(KEYS) - set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["actorid", "actor", "quality_class", "is_active", "start_date", "end_date"]
    assert df.count() == 710


@pytest.mark.parametrize("key", KEYS)
def test_parity_sf001(spark, con, key):
    res = compare(spark, SF_CHECK, key, entry.queries()[key], entry.oracle_sql().get(key), con)
    assert res["status"] in ("match", "rows-only"), res


@pytest.mark.parametrize("key", ["actors_cumulative", "actors_cumulative_carry", "user_datelist",
                                 "host_datelist", "reduced_hits", "scd2_backfill"])
def test_parity_sf0001(spark, key):
    res = compare(spark, SF_SMALL, key, entry.queries()[key], entry.oracle_sql()[key])
    assert res["status"] == "match", res


def test_surveyed_totals(spark):
    q = entry.queries()
    assert q["actors_cumulative"](spark, SF_SMALL).count() == 973
    assert q["actors_cumulative_carry"](spark, SF_SMALL).count() == 1010
    assert q["host_datelist"](spark, SF_SMALL).count() == 2779
    assert q["user_datelist"](spark, SF_SMALL).count() == 2523
