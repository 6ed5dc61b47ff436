"""Property tests: on random small inputs the serial step loop equals the closed form."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from laminar.operators.datelist import datelist_backfill, datelist_step, host_activity
from laminar.operators.reduced import daily_counts, reduce_month, reduce_step
from laminar.operators.scd2 import scd2_backfill, scd2_increment
from laminar.operators.upsert import upsert
from laminar.sources.schemas import ACTORS_HISTORY_SCD, HOST_ACTIVITY_REDUCED, HOSTS_CUMULATED

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
EV = "host string, user_id long, event_time timestamp"

events_st = st.lists(st.tuples(st.sampled_from(["h1", "h2", "h3"]),
                               st.one_of(st.none(), st.integers(1, 3)),
                               st.integers(1, 6), st.integers(0, 23)), min_size=1, max_size=25)


def _events(spark, rows):
    return spark.createDataFrame([(h, u, dt.datetime(2023, 3, d, hr)) for h, u, d, hr in rows], EV)


@SETTINGS
@given(rows=events_st)
def test_datelist_loop_equals_closed_form(spark, rows):
    act = host_activity(_events(spark, rows))
    first, days = dt.date(2023, 3, 1), 6
    table, loaded = [], None
    for _ in range(days):
        today = first if loaded is None else loaded + dt.timedelta(days=1)
        y = spark.createDataFrame([r for r in table if r.date == loaded], HOSTS_CUMULATED)
        step = datelist_step(y, act, ["host"], today, "host_activity_datelist").collect()
        if step:
            table += [r for r in spark.createDataFrame(step, HOSTS_CUMULATED.fieldNames()).collect()]
            loaded = today
    loop = sorted((r.host, r.date, tuple(r.host_activity_datelist)) for r in table)
    closed = datelist_backfill(act, ["host"], first, first + dt.timedelta(days=days - 1), "l").collect()
    assert loop == sorted((r.host, r.date, tuple(r.l)) for r in closed)
    # the last snapshot of a key is its set of active days, newest first
    for r in closed:
        assert list(r.l) == sorted(set(r.l), reverse=True)


@SETTINGS
@given(rows=events_st)
def test_reduced_loop_equals_closed_form_and_sums(spark, rows):
    counts = daily_counts(_events(spark, rows))
    state = spark.createDataFrame([], HOST_ACTIVITY_REDUCED)
    for d in range(1, 7):
        state = spark.createDataFrame(reduce_step(state, counts, dt.date(2023, 3, d)).collect(), HOST_ACTIVITY_REDUCED)
    closed = reduce_month(counts, dt.date(2023, 3, 1), dt.date(2023, 3, 6))
    key = lambda df: sorted((r.host, tuple(r.hit_array), tuple(r.unique_visitor_array)) for r in df.collect())
    assert key(state) == key(closed)
    hits = sum(1 for h, u, d, hr in rows if u is not None)
    assert sum(sum(r.hit_array) for r in closed.collect()) == hits


snap_st = st.dictionaries(
    st.sampled_from(["a", "b", "c", "d"]),
    st.lists(st.tuples(st.sampled_from(["star", "good", "bad"]), st.booleans()), min_size=4, max_size=4),
    min_size=1)


@SETTINGS
@given(snap=snap_st, present=st.lists(st.booleans(), min_size=4, max_size=4))
def test_scd2_increments_equal_backfill(spark, snap, present):
    years = [2001 + i for i in range(4)]
    rows = [(k, k.upper(), v[i][0], v[i][1], y) for k, v in snap.items() for i, y in enumerate(years)
            if present[i] or i == 0]
    state = spark.createDataFrame(rows, "actorid string, actor string, quality_class string, "
                                        "is_active boolean, current_year int")
    scd = spark.createDataFrame([], ACTORS_HISTORY_SCD)
    for y in sorted({r[4] for r in rows}):
        inc = scd2_increment(scd, state.where(F.col("current_year") <= y))
        scd = spark.createDataFrame(upsert(scd, inc, ["actorid", "start_date"],
                                           ["quality_class", "is_active", "end_date"]).collect(), ACTORS_HISTORY_SCD)
    key = lambda df: sorted(tuple(r) for r in df.select("actorid", "quality_class", "is_active",
                                                         "start_date", "end_date").collect())
    back = scd2_backfill(state)
    if all(present):
        assert key(scd) == key(back)
    # intervals of one key never overlap when the tracked values are never NULL
    ivs = {}
    for a, _, _, s, e in key(back):
        ivs.setdefault(a, []).append((s, e))
    for lst in ivs.values():
        lst.sort()
        assert all(x[1] < y[0] for x, y in zip(lst, lst[1:]))
