"""The streamed daily loads equal the batch closed forms, across a restart."""

import datetime as dt

from pyspark.sql import functions as F

from laminar.operators.datelist import datelist_backfill, host_activity
from laminar.operators.reduced import daily_counts, reduce_month
from laminar.session import scratch_path
from laminar.sources import roles
from laminar.streaming import host_datelist_load, read_streamed_reduced, reduced_load, run_stream
from tests.conftest import SF_SMALL

FIRST = dt.date(2024, 1, 1)


def _land(spark, ev, src, lo, hi):
    ev.where(F.to_date("event_time").between(F.lit(lo), F.lit(hi))).write.mode("append").parquet(src)


def _run_twice(spark, model):
    ev = roles.events(spark, SF_SMALL)
    src, staging, ckpt = (scratch_path(spark, n) for n in ("src", "staging", "ckpt"))
    _land(spark, ev, src, dt.date(2024, 1, 1), dt.date(2024, 1, 12))
    run_stream(spark, src, ev.schema, model, staging, ckpt)          # loads days 1..11
    _land(spark, ev, src, dt.date(2024, 1, 13), dt.date(2024, 1, 31))
    run_stream(spark, src, ev.schema, model, staging, ckpt, finalize=True)  # restart: only new files
    return ev


def test_streamed_host_datelist_equals_backfill(spark):
    target = scratch_path(spark, "hosts")
    ev = _run_twice(spark, host_datelist_load(target, FIRST))
    last = ev.agg(F.max(F.to_date("event_time"))).first()[0]
    want = datelist_backfill(host_activity(ev), ["host"], FIRST, last, "host_activity_datelist")
    got = spark.read.parquet(target)
    key = lambda df: sorted((r.host, r.date, tuple(r.host_activity_datelist)) for r in df.collect())
    assert key(got) == key(want)


def test_streamed_reduced_equals_backfill(spark):
    target = scratch_path(spark, "reduced")
    ev = _run_twice(spark, reduced_load(target, FIRST))
    last = ev.agg(F.max(F.to_date("event_time"))).first()[0]
    want = reduce_month(daily_counts(ev), FIRST, last)
    got = read_streamed_reduced(spark, target)
    key = lambda df: sorted((r.host, tuple(r.hit_array), tuple(r.unique_visitor_array))
                            for r in df.collect())
    assert key(got) == key(want)
