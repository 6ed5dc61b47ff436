"""Hand-made cases: date lists (step vs closed form), bitmap, reduced month arrays."""

import datetime as dt

from pyspark.sql import functions as F

from laminar.functions.arrays import replace_equal_to_last, replace_last_slot
from laminar.operators.datelist import (datelist_backfill, datelist_bitmap, datelist_step, host_activity,
                                        user_activity)
from laminar.operators.reduced import (daily_counts, explode_days, fix_last, fix_last_variants, reduce_month,
                                       reduce_step)
from laminar.sources.schemas import HOST_ACTIVITY_REDUCED, HOSTS_CUMULATED

D = dt.date


def ev(spark, rows):
    return spark.createDataFrame(rows, "url string, referrer string, user_id long, device_id long, "
                                       "host string, event_time timestamp")


def ts(day, h=12):
    return dt.datetime(2023, 1, day, h)


def _loop_hosts(spark, act, first, days):
    table, loaded = spark.createDataFrame([], HOSTS_CUMULATED), None
    for _ in range(days):
        today = first if loaded is None else loaded + dt.timedelta(days=1)
        y = table.where(F.col("date") == F.lit(loaded)) if loaded else spark.createDataFrame([], HOSTS_CUMULATED)
        step = datelist_step(y, act, ["host"], today, "host_activity_datelist").collect()
        if step:
            table = table.unionByName(spark.createDataFrame(step, HOSTS_CUMULATED))
            loaded = today
    return table


def _rows(df, col):
    return sorted((r.host, r.date, tuple(r[col])) for r in df.collect())


def test_datelist_closed_form_equals_daily_loop(spark):
    e = ev(spark, [(None, None, 1, 1, "h1", ts(1)), (None, None, 1, 1, "h1", ts(3)),
                   (None, None, 2, 2, "h2", ts(2)), (None, None, 2, 2, "h2", ts(2, 18)),
                   (None, None, 3, 3, "h3", ts(5))])  # day 4 has no activity at all
    act = host_activity(e)
    closed = datelist_backfill(act, ["host"], D(2023, 1, 1), D(2023, 1, 5), "host_activity_datelist")
    loop = _loop_hosts(spark, act, D(2023, 1, 1), 5)
    assert _rows(closed, "host_activity_datelist") == _rows(loop, "host_activity_datelist")
    h1 = {r.date: r.host_activity_datelist for r in closed.where("host = 'h1'").collect()}
    assert h1[D(2023, 1, 5)] == [D(2023, 1, 3), D(2023, 1, 1)]  # newest first, idle days carried


def test_datelist_first_day_empty_never_starts(spark):
    e = ev(spark, [(None, None, 1, 1, "h1", ts(2))])
    act = host_activity(e)
    assert datelist_backfill(act, ["host"], D(2023, 1, 1), D(2023, 1, 5), "l").count() == 0
    assert _loop_hosts(spark, act, D(2023, 1, 1), 5).count() == 0


def test_user_activity_fans_out_per_browser_and_skips_null_ids(spark):
    e = ev(spark, [(None, None, 1, 7, "h", ts(1)), (None, None, None, 7, "h", ts(1)),
                   (None, None, 2, None, "h", ts(1))])
    dev = spark.createDataFrame([(7, "chrome"), (7, "safari")], "device_id long, browser_type string")
    got = sorted((r.user_id, r.browser_type) for r in user_activity(e, dev).collect())
    assert got == [(1, "chrome"), (1, "safari")]


def test_bitmap_bits(spark):
    snap = spark.createDataFrame([
        (1, [D(2023, 1, 1), D(2023, 1, 1), D(2023, 1, 31), D(2022, 12, 31), D(2023, 2, 1)]),
        (2, None), (3, []),
    ], "k int, l array<date>")
    got = {r.k: r.bits for r in datelist_bitmap(snap, ["k"], "l", D(2023, 1, 1), "bits").collect()}
    assert got == {1: 1 + (1 << 30), 2: 0, 3: 0}


def test_bitmap_popcount_equals_days_in_month(spark):
    days = [D(2023, 1, d) for d in (2, 3, 5, 8, 13, 21)]
    snap = spark.createDataFrame([(1, days)], "k int, l array<date>")
    r = datelist_bitmap(snap, ["k"], "l", D(2023, 1, 1), "bits").select(F.bit_count("bits").alias("n")).first()
    assert r.n == len(days)


def test_reduced_closed_form_equals_loop_and_sums(spark):
    e = ev(spark, [(None, None, 1, 1, "h1", ts(1)), (None, None, 2, 1, "h1", ts(1)),
                   (None, None, 1, 1, "h1", ts(1, 3)), (None, None, 3, 2, "h2", ts(3)),
                   (None, None, None, 2, "h2", ts(2)), (None, None, 4, 3, "h3", ts(2))])
    counts = daily_counts(e)
    closed = reduce_month(counts, D(2023, 1, 1), D(2023, 1, 4))
    state = spark.createDataFrame([], HOST_ACTIVITY_REDUCED)
    for d in range(1, 5):
        state = spark.createDataFrame(reduce_step(state, counts, D(2023, 1, d)).collect(), HOST_ACTIVITY_REDUCED)
    c = {r.host: (list(r.hit_array), list(r.unique_visitor_array)) for r in closed.collect()}
    lp = {r.host: (list(r.hit_array), list(r.unique_visitor_array)) for r in state.collect()}
    assert c == lp
    assert c["h1"] == ([3.0, 0.0, 0.0, 0.0], [2.0, 0.0, 0.0, 0.0])
    assert c["h2"] == ([0.0, 0.0, 1.0, 0.0], [0.0, 0.0, 1.0, 0.0])  # NULL-user hit on day 2 not counted
    back = {(r.host, r.day): r.hits for r in explode_days(closed).collect()}
    assert sum(back.values()) == 5 and back[("h3", D(2023, 1, 2))] == 1


def test_reduced_month_rollover_starts_new_month(spark):
    e = ev(spark, [(None, None, 1, 1, "h", dt.datetime(2023, 1, 31, 1)),
                   (None, None, 1, 1, "h", dt.datetime(2023, 2, 1, 1))])
    counts = daily_counts(e)
    jan = spark.createDataFrame(reduce_step(spark.createDataFrame([], HOST_ACTIVITY_REDUCED), counts,
                                            D(2023, 1, 31)).collect(), HOST_ACTIVITY_REDUCED)
    feb = reduce_step(jan, counts, D(2023, 2, 1)).collect()
    assert len(jan.first().hit_array) == 31
    assert [(r.month, list(r.hit_array)) for r in feb] == [(D(2023, 2, 1), [1.0])]
    # the closed form clamps the range to the month
    assert len(reduce_month(counts, D(2023, 1, 1), D(2023, 2, 3)).first().hit_array) == 31


def test_replace_last(spark):
    df = spark.createDataFrame([([5.0, 7.0, 5.0],), ([],)], "a array<double>")
    r = df.select(replace_equal_to_last(F.col("a"), F.lit(9.0)).alias("w"),
                  replace_last_slot(F.col("a"), F.lit(9.0)).alias("p")).collect()
    assert list(r[0].w) == [9.0, 7.0, 9.0] and list(r[0].p) == [5.0, 7.0, 9.0]
    assert list(r[1].w) == [] and list(r[1].p) == []


MONTH = "host string, month date, hit_array array<float>, unique_visitor_array array<float>"
RECOUNT = "host string, hits long, visitors long"


def test_fix_last_missing_recount_is_null_unless_given(spark):
    st = spark.createDataFrame([("h", D(2023, 1, 1), [1.0, 2.0], [1.0, 1.0])], MONTH)
    rc = spark.createDataFrame([], RECOUNT)
    assert list(fix_last(st, rc, D(2023, 1, 2), positional=True).first().hit_array) == [1.0, None]
    assert list(fix_last(st, rc, D(2023, 1, 2), positional=True, default=0).first().hit_array) == [1.0, 0.0]


def test_fix_last_keeps_hosts_that_only_the_recount_has(spark):
    st = spark.createDataFrame([("h", D(2023, 1, 1), [1.0, 2.0], [1.0, 1.0])], MONTH)
    rc = spark.createDataFrame([("h", 9, 4), ("new", 5, 3), (None, 2, 1)], RECOUNT)
    got = {r.host: (list(r.hit_array), list(r.unique_visitor_array)) for r in fix_last(st, rc, D(2023, 1, 2), positional=True).collect()}
    assert got == {"h": ([1.0, 9.0], [1.0, 4.0]), "new": ([0.0, 5.0], [0.0, 3.0]), None: ([0.0, 2.0], [0.0, 1.0])}


def test_fix_last_variants_match_single_forms(spark):
    st = spark.createDataFrame([("h", D(2023, 1, 1), [3.0, 1.0, 3.0], [1.0, 2.0, 1.0])], MONTH)
    rc = spark.createDataFrame([("h", 5, 4)], RECOUNT)
    day = D(2023, 1, 3)
    r = fix_last_variants(st, rc, day).first()
    assert list(r.hit_array_as_written) == list(fix_last(st, rc, day).first().hit_array) == [5.0, 1.0, 5.0]
    assert list(r.hit_array_positional) == list(fix_last(st, rc, day, positional=True).first().hit_array) == [3.0, 1.0, 5.0]
    assert list(r.unique_visitor_array_as_written) == [4.0, 2.0, 4.0]
    assert list(r.unique_visitor_array_positional) == [1.0, 2.0, 4.0]


def test_range_operators_equal_step_loops(spark):
    from laminar.operators.datelist import datelist_days
    from laminar.operators.reduced import reduce_days
    e = ev(spark, [(None, None, 1, 1, "h1", ts(1)), (None, None, 2, 1, "h1", ts(3)),
                   (None, None, 3, 2, "h2", ts(4)), (None, None, None, 3, "h3", ts(2)),
                   (None, None, 4, 3, "h3", ts(6))])
    counts, act = daily_counts(e), host_activity(e)
    # reduced: days 1-2 by steps, then 3-6 in one range == six steps == closed form
    state = spark.createDataFrame([], HOST_ACTIVITY_REDUCED)
    for d in (1, 2):
        state = spark.createDataFrame(reduce_step(state, counts, D(2023, 1, d)).collect(), HOST_ACTIVITY_REDUCED)
    ranged = reduce_days(state, counts, D(2023, 1, 3), D(2023, 1, 6))
    closed = reduce_month(counts, D(2023, 1, 1), D(2023, 1, 6))
    key = lambda df: sorted((r.host, tuple(r.hit_array), tuple(r.unique_visitor_array)) for r in df.collect())
    assert key(ranged) == key(closed)
    assert key(reduce_days(spark.createDataFrame([], HOST_ACTIVITY_REDUCED), counts,
                           D(2023, 1, 1), D(2023, 1, 6))) == key(closed)
    # date lists: snapshot of day 2 from steps, then days 3-6 in one range == backfill rows of 3-6
    loop = _loop_hosts(spark, act, D(2023, 1, 1), 2)
    y = loop.where(F.col("date") == F.lit(D(2023, 1, 2)))
    ranged = datelist_days(y, act, ["host"], D(2023, 1, 3), D(2023, 1, 6), "host_activity_datelist")
    full = datelist_backfill(act, ["host"], D(2023, 1, 1), D(2023, 1, 6), "host_activity_datelist")
    assert _rows(ranged, "host_activity_datelist") == _rows(full.where("date >= '2023-01-03'"),
                                                            "host_activity_datelist")
    empty = spark.createDataFrame([], HOSTS_CUMULATED)
    assert _rows(datelist_days(empty, act, ["host"], D(2023, 1, 1), D(2023, 1, 6), "host_activity_datelist"),
                 "host_activity_datelist") == _rows(full, "host_activity_datelist")
    # never starts when the first day is empty and nothing was loaded before
    assert datelist_days(empty, act, ["host"], D(2023, 1, 5), D(2023, 1, 6), "host_activity_datelist").count() == 0
