"""Hand-made cases: bands, cumulative year step/closed form, SCD2 backfill/increment."""

import pytest
from pyspark.sql import functions as F

from laminar.functions.bands import AS_WRITTEN, SPEC, band
from laminar.operators.cumulate import cumulate_year_step, cumulate_years, period_agg
from laminar.operators.scd2 import scd2_backfill, scd2_increment
from laminar.operators.upsert import upsert
from laminar.sources.schemas import ACTORS, ACTORS_HISTORY_SCD

FILM = "actorid string, actor string, film string, votes int, rating float, filmid string, year int"


def films(spark, rows):
    return spark.createDataFrame(rows, FILM)


def test_band_edges(spark):
    df = spark.createDataFrame([(8.0,), (8.01,), (7.0,), (6.5,), (6.0,), (None,)], "s double")
    got = [r[0] for r in df.select(band(F.col("s"), AS_WRITTEN)).collect()]
    assert got == ["good", "star", "good", "good", "bad", "bad"]
    got = [r[0] for r in df.select(band(F.col("s"), SPEC)).collect()]
    assert got == ["good", "star", "average", "average", "bad", "bad"]


def test_period_agg_sorts_by_film_id(spark):
    f = films(spark, [("a", "A", "f2", 1, 9.0, "2", 2000), ("a", "A", "f1", 1, 9.0, "1", 2000)])
    r = period_agg(f).collect()[0]
    assert [x.filmid for x in r.films] == ["1", "2"] and r.quality_class == "star"


def _loop(spark, facts, seed, runs, history="two_period"):
    state = spark.createDataFrame([], ACTORS)
    for _ in range(runs):
        step = cumulate_year_step(state, facts, seed=seed, history=history)
        # tiny fixture: materialise each step so the next one reads plain rows
        state = spark.createDataFrame(state.unionByName(step.select(*ACTORS.fieldNames())).collect(), ACTORS)
    return state


def _key(df):
    return sorted((r.actorid, r.actor, r.current_year, r.is_active, r.quality_class,
                   tuple(x.filmid for x in r.films)) for r in df.collect())


GAPPY = [
    ("a", "A", "x", 1, 9.0, "1", 2001), ("a", "A", "x", 1, 7.5, "2", 2002),
    ("b", "B", "x", 1, 5.0, "3", 2001), ("b", "B", "x", 1, 6.5, "6", 2004),  # b absent 2002-2003
    ("c", "C", "x", 1, 8.5, "4", 2003),
    ("d", "D", "x", 1, 6.2, "5", 2002), ("d", "D", "x", 1, 6.2, "7", 2004),  # d absent one year
]


@pytest.mark.parametrize("history", ["two_period", "carry"])
def test_closed_form_equals_loop(spark, history):
    f = films(spark, GAPPY)
    closed = cumulate_years(f, seed=2000, history=history)
    assert _key(closed) == _key(_loop(spark, f, 2000, 6, history))


def test_two_period_drops_long_idle_and_carry_keeps(spark):
    f = films(spark, GAPPY)
    two = {(r.actorid, r.current_year) for r in cumulate_years(f, seed=2000).collect()}
    assert ("b", 2002) in two and ("b", 2003) not in two  # idle two years: gone until active
    carry = {(r.actorid, r.current_year): r for r in cumulate_years(f, seed=2000, history="carry").collect()}
    assert ("b", 2003) in carry and not carry[("b", 2003)].is_active
    assert [x.filmid for x in carry[("b", 2004)].films] == ["3", "6"]


def test_stop_guard_and_gap_year(spark):
    f = films(spark, [("a", "A", "x", 1, 9.0, "1", 2001), ("a", "A", "x", 1, 9.0, "2", 2003)])
    got = cumulate_years(f, seed=2000)
    assert [r.current_year for r in got.collect()] == [2001]  # 2002 missing: loading stops for good
    state = spark.createDataFrame([], ACTORS)
    assert cumulate_year_step(state, films(spark, []), seed=2000).count() == 0
    # nothing in seed+1: never starts
    assert cumulate_years(films(spark, [("a", "A", "x", 1, 9.0, "1", 2005)]), seed=2000).count() == 0


def test_two_spellings_multiply(spark):
    f = films(spark, [("a", "A", "x", 1, 9.0, "1", 2001), ("a", "A2", "x", 1, 9.0, "2", 2001),
                      ("a", "A", "x", 1, 9.0, "3", 2002)])
    got = cumulate_years(f, seed=2000).where("current_year = 2002")
    assert got.count() == 2  # the join on actorid fans out per spelling, as written


SNAP = "actorid string, actor string, quality_class string, is_active boolean, current_year int"


def _scd_rows(df):
    return sorted((tuple(r) for r in df.select("actorid", "quality_class", "is_active", "start_date",
                                               "end_date").collect()), key=repr)


def test_scd2_backfill_traps(spark):
    s = spark.createDataFrame([
        ("a", "A", "good", True, 2001), ("a", "A", "good", True, 2002), ("a", "A", "star", True, 2003),
        ("n", "N", None, True, 2001), ("n", "N", "good", True, 2002),              # NULL -> good
        ("m", "M", "bad", True, 2001), ("m", "M", None, True, 2002), ("m", "M", "bad", True, 2003),
        ("s", "S", "bad", True, 2001), ("s", "S", "bad", False, 2002),            # status flips only
    ], SNAP)
    got = _scd_rows(scd2_backfill(s))
    assert ("a", "good", True, 2001, 2002) in got and ("a", "star", True, 2003, 2003) in got
    assert ("n", None, True, 2001, 2001) in got and ("n", "good", True, 2002, 2002) in got
    # A -> NULL -> A shares one streak: one bad interval [2001, 2003] overlapping the NULL one
    assert ("m", "bad", True, 2001, 2003) in got and ("m", None, True, 2002, 2002) in got
    assert ("s", "bad", True, 2001, 2001) in got and ("s", "bad", False, 2002, 2002) in got


def _increment_loop(spark, state, null_safe=False):
    scd = spark.createDataFrame([], ACTORS_HISTORY_SCD)
    for y in sorted({r.current_year for r in state.collect()}):
        rows = scd2_increment(scd, state.where(F.col("current_year") <= y), null_safe=null_safe)
        scd = upsert(scd, rows, ["actorid", "start_date"], ["quality_class", "is_active", "end_date"])
        scd = spark.createDataFrame(scd.collect(), ACTORS_HISTORY_SCD)
    return scd


def test_scd2_increments_equal_backfill(spark):
    s = spark.createDataFrame([
        ("a", "A", "good", True, 2001), ("a", "A", "good", True, 2002), ("a", "A", "star", True, 2003),
        ("b", "B", "bad", True, 2001), ("b", "B", "bad", False, 2002), ("b", "B", "bad", False, 2003),
        ("c", "C", "star", True, 2002), ("c", "C", "star", True, 2003),
    ], SNAP)
    assert _scd_rows(_increment_loop(spark, s)) == _scd_rows(scd2_backfill(s))


def test_scd2_increment_null_class_lost_unless_null_safe(spark):
    s = spark.createDataFrame([("n", "N", None, True, 2001), ("n", "N", None, True, 2002)], SNAP)
    as_written = _scd_rows(_increment_loop(spark, s))
    assert as_written == [("n", None, True, 2001, 2001)]  # 2002 falls in neither branch
    safe = _scd_rows(_increment_loop(spark, s, null_safe=True))
    assert safe == [("n", None, True, 2001, 2002)]


def test_scd2_increment_rerun_is_idempotent(spark):
    s = spark.createDataFrame([("a", "A", "good", True, 2001), ("a", "A", "star", True, 2002)], SNAP)
    scd = _increment_loop(spark, s)
    again = upsert(scd, scd2_increment(scd, s), ["actorid", "start_date"],
                   ["quality_class", "is_active", "end_date"])
    assert _scd_rows(again) == _scd_rows(scd)


@pytest.mark.parametrize("history", ["two_period", "carry"])
def test_null_actor_name_still_active(spark, history):
    f = films(spark, [("a", None, "x", 1, 9.0, "1", 2001), ("a", None, "x", 1, 9.0, "2", 2002)])
    got = {r.current_year: r.is_active for r in cumulate_years(f, seed=2000, history=history).collect()}
    assert got == {2001: True, 2002: True}
    assert _key(cumulate_years(f, seed=2000, history=history)) == _key(_loop(spark, f, 2000, 3, history))
