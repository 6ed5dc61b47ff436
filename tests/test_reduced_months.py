"""Reduced loads: exact wide counts, and days before January 2024."""

import datetime as dt

import pytest

from laminar.plans import incremental as inc
from laminar.plans import registry
from laminar.session import scratch_path
from laminar.sources import roles
from laminar.streaming import read_streamed_reduced, reduced_load
from laminar.streaming.daily import early

D = dt.date
WIDE = (1 << 24) + 1  # the first whole number that a float cannot hold


def test_wide_counts_stay_exact(spark):
    counts = spark.createDataFrame([("h", D(2023, 1, d), WIDE, WIDE + 2) for d in (1, 3)],
                                   "host string, day date, hits long, visitors long")
    path = scratch_path(spark, "wide")
    got = inc.reduce_load_days(spark, counts, path, D(2023, 1, 1), 4, step=2, count_type="long").collect()
    assert [(r.hit_array, r.unique_visitor_array) for r in got] == [([WIDE, 0, WIDE, 0], [WIDE + 2, 0, WIDE + 2, 0])]
    got = read_streamed_reduced(spark, path, "long").collect()
    assert [r.hit_array for r in got] == [[WIDE, 0, WIDE, 0]]


@pytest.mark.parametrize("query", ["reduced_incremental", "reduced_streamed"])
def test_months_before_2024_are_loaded(spark, monkeypatch, query):
    days = [D(2023, 10, 30), D(2023, 12, 31), D(2024, 1, 2)]
    ev = spark.createDataFrame([(1, 1, "h", f"{d} 10:00:00") for d in days],
                               "user_id long, device_id long, host string, event_time string")
    ev = ev.withColumn("event_time", ev.event_time.cast("timestamp"))
    monkeypatch.setattr(roles, "events", lambda *_: ev)
    got = {str(r.month): r.hit_array for r in registry.QUERIES[query](spark, "").collect()}
    assert got == {"2023-10-01": ",".join(["0"] * 29 + ["1", "0"]), "2023-12-01": ",".join(["0"] * 30 + ["1"]), "2024-01-01": "0,1"}
    same = {str(r.month): r.hit_array for r in registry.QUERIES["reduced_hits"](spark, "").collect()}
    assert got == same


def test_rows_before_the_first_day_are_counted(spark):
    staging = scratch_path(spark, "staging")
    rows = [("h", D(2023, 1, 1)), ("h", D(2023, 1, 2)), ("h", D(2023, 1, 3)), ("h", None)]
    spark.createDataFrame(rows, "host string, day date").write.partitionBy("day").parquet(f"{staging}/batch=0")
    assert early(spark, staging, D(2023, 1, 3)) == 2 and reduced_load("x").first_day is None
