"""A key holding a third of all rows gives whole, exact results; typed CSV reads."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from laminar.operators.datelist import datelist_backfill, host_activity
from laminar.operators.dedup import dedup
from laminar.operators.reduced import daily_counts, reduce_month
from laminar.session import scratch_path
from laminar.sources import roles
from laminar.sources.readers import read_csv
from tests.conftest import SF_SMALL


def _hot_events(spark):
    """Events whose host/device is forced to one value for every third row."""
    ev = roles.events(spark, SF_SMALL).withColumn("_i", F.monotonically_increasing_id())
    hot = (F.col("_i") % 3) == 0
    return (ev.withColumn("host", F.when(hot, F.lit("host-hot")).otherwise(F.col("host")))
              .withColumn("device_id", F.when(hot, F.lit(0).cast("long")).otherwise(F.col("device_id")))
              .drop("_i"))


def test_hot_host_reduced_month_exact(spark):
    ev = _hot_events(spark)
    pdf = ev.select("host", "user_id", F.to_date("event_time").alias("day")).toPandas()
    pdf = pdf[pdf.user_id.notna()]
    last = pdf.day.max()
    got = {r.host: (list(r.hit_array), list(r.unique_visitor_array))
           for r in reduce_month(daily_counts(ev), dt.date(2024, 1, 1), last).collect()}
    days = pd.date_range("2024-01-01", last).date
    for host, g in pdf.groupby("host"):
        hits = g.groupby("day").size()
        vis = g.groupby("day").user_id.nunique()
        assert got[host] == ([float(hits.get(d, 0)) for d in days], [float(vis.get(d, 0)) for d in days])
    assert sum(got["host-hot"][0]) >= len(pdf) / 3 - 1


def test_hot_host_datelist_exact(spark):
    ev = _hot_events(spark)
    pdf = ev.select("host", F.to_date("event_time").alias("day")).toPandas()
    last = pdf.day.max()
    snaps = datelist_backfill(host_activity(ev, distinct=False), ["host"], dt.date(2024, 1, 1), last,
                              "l", as_of=last).collect()
    want = {h: sorted(set(g.day), reverse=True) for h, g in pdf.groupby("host")}
    assert {r.host: list(r.l) for r in snaps} == want


def test_hot_key_dedup_exact(spark):
    ev = _hot_events(spark).withColumn("event_date", F.to_date("event_time"))
    pdf = ev.toPandas()
    got = dedup(ev, ["device_id", "event_date"]).toPandas()
    assert len(got) == pdf.groupby(["device_id", "event_date"], dropna=False).ngroups
    # the kept row is the first by the remaining columns (url, referrer, user_id, host, event_time)
    srt = pdf.sort_values(["url", "referrer", "user_id", "host", "event_time"], na_position="last")
    first = srt.groupby(["device_id", "event_date"], dropna=False).head(1)
    key = ["device_id", "event_date", "url", "user_id", "host", "event_time"]
    assert sorted(map(tuple, first[key].astype(str).values)) == sorted(map(tuple, got[key].astype(str).values))


def test_read_csv_with_declared_schema(spark):
    path = scratch_path(spark, "maps_csv")
    roles.maps(spark, SF_SMALL).withColumn("description", F.lit("d")).write.option("header", "true").csv(path)
    df = read_csv(spark, path, "maps")
    assert df.schema.fieldNames() == ["mapid", "name", "description"] and df.count() == 25
