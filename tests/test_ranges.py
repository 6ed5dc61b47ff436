"""Range steps and corrections against the backfills they have to equal, over random splits and periods."""

import random

import pytest
from pyspark.sql import functions as F

from laminar.operators.cumulate import cumulate_range, cumulate_years
from laminar.operators.scd2 import OPEN, scd2_apply, scd2_backfill, scd2_correct, scd2_range
from laminar.plans.ranges import load_year_ranges, read_scd2_ranges, scd2_load_range, scd2_load_ranges
from laminar.session import scratch_path
from laminar.sources.schemas import ACTORS_HISTORY_SCD

STATE = "actorid string, actor string, quality_class string, is_active boolean, current_year int"
FACTS = "actorid string, actor string, film string, votes int, rating float, filmid string, year int"


def rows_of(df, cols=None):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def random_state(rng, entities, years, nulls, gaps):
    rows = []
    for e in range(entities):
        begin = rng.choice(years)
        for y in range(begin, years[-1] + 1):
            if gaps and rng.random() < 0.2:
                continue
            q = rng.choice(["star", "good", "good", "good", *([None] if nulls else [])])
            name = f"a{e}" if rng.random() < 0.95 else f"A{e}"
            rows.append((f"e{e}", name, q, rng.random() < 0.8, y))
    return rows


def random_split(rng, first, last):
    out, at = [], first
    while at <= last:
        end = min(last, at + rng.randrange(0, 4))
        out.append((at, end))
        at = end + 1
    return out


SCD = ("actorid", "actor", "quality_class", "is_active", "start_date", "end_date")


@pytest.mark.parametrize("seed", range(3))
def test_every_split_equals_the_backfill(spark, seed):
    rng = random.Random(seed)
    state = spark.createDataFrame(random_state(rng, 40, range(2000, 2010), nulls=True, gaps=True), STATE)
    want = rows_of(scd2_backfill(state), SCD)
    open_now, closed = spark.createDataFrame([], ACTORS_HISTORY_SCD), []
    for first, last in random_split(rng, 2000, 2009):
        done = spark.createDataFrame(scd2_range(open_now, state, first, last).collect(), (
                                     "actorid string, actor string, quality_class string, is_active boolean, start_date int, end_date int, is_open boolean"))
        closed += rows_of(done.where(~F.col(OPEN)), SCD)
        open_now = done.where(OPEN).drop(OPEN)
    assert sorted(closed + rows_of(open_now, SCD), key=repr) == want


def test_loaded_ranges_equal_the_backfill_and_can_be_loaded_again(spark):
    rng = random.Random(11)
    state = spark.createDataFrame(random_state(rng, 30, range(2000, 2008), nulls=False, gaps=True), STATE).cache()
    want, path = rows_of(scd2_backfill(state), SCD), scratch_path(spark, "scd")
    assert rows_of(scd2_load_ranges(spark, state, [(2000, 2002), (2003, 2003), (2004, 2007)], path), SCD) == want
    scd2_load_range(spark, state, 2003, 2005, path)  # drops what was built on it
    assert rows_of(read_scd2_ranges(spark, path), SCD) == rows_of(scd2_backfill(state.where("current_year <= 2005")), SCD)
    scd2_load_range(spark, state, 2006, 2007, path)
    assert rows_of(read_scd2_ranges(spark, path), SCD) == want
    assert rows_of(scd2_load_ranges(spark, state.where("false"), [(2000, 2001)], scratch_path(spark, "scd"))) == []


def test_a_range_reads_no_closed_record(spark):
    state = spark.createDataFrame([("a", "A", "star" if y < 2002 else "bad", True, y) for y in range(2000, 2006)], STATE)
    path = scratch_path(spark, "scd")
    scd2_load_range(spark, state, 2000, 2003, path)
    plan = scd2_range(spark.read.schema(ACTORS_HISTORY_SCD).parquet(f"{path}/v=000002003/is_open=true"), state, 2004, 2005)
    assert rows_of(plan) == [("a", "A", "bad", True, 2002, 2005, True)]
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 2


def random_facts(rng, years):
    return [(f"e{e}", f"a{e}" if rng.random() < 0.9 else f"A{e}", f"film{i}", rng.randrange(99), float(rng.randrange(10)), f"f{e}-{y}-{i}", y)
            for e in range(15) for y in years for i in range(rng.choice([0, 0, 1, 1, 2]))]


@pytest.mark.parametrize("history", ["two_period", "carry"])
@pytest.mark.parametrize("years", [range(1999, 2008), [1999, 2000, 2001, 2003, 2004], [1999, 2001]])
def test_year_ranges_equal_the_backfill(spark, history, years):
    rng = random.Random(len(years))
    facts = spark.createDataFrame(random_facts(rng, years), FACTS)
    want = rows_of(cumulate_years(facts, 1999, history))
    split = random_split(rng, 2000, max(years) + 2)
    assert rows_of(load_year_ranges(spark, facts, scratch_path(spark, "actors"), 1999, split, history)) == want


def test_carry_range_reads_no_older_facts(spark):
    rng = random.Random(7)
    facts = spark.createDataFrame(random_facts(rng, range(1999, 2008)), FACTS)
    whole = cumulate_years(facts, 1999, "carry")
    late = cumulate_range(whole.where("current_year = 2003"), facts.where("year >= 2004"), 2004, 2007, "carry")
    assert rows_of(late) == rows_of(whole.where("current_year > 2003"))


def dense_state(rng, entities, years):
    """Rows whose intervals have a row in each period: values change across every gap."""
    rows, n = [], 0
    for e in range(entities):
        y = rng.choice(years)
        while y <= years[-1]:
            stop, n = min(years[-1], y + rng.randrange(0, 5)), n + 1
            for x in range(y, stop + 1):
                rows.append((f"e{e}", f"a{e}", rng.choice([f"q{n}", "star", "star", None]), bool(n % 2), x))
            y = stop + 1 + rng.choice([0, 0, 2])
    return rows


def intervals(rows):
    """The backfill with NULL as a value like others."""
    out, last = [], {}
    for r in sorted(rows, key=lambda r: (r[0], r[4])):
        if r[0] in last and out[last[r[0]]][:4] == list(r[:4]):
            out[last[r[0]]][5] = r[4]
        else:
            last[r[0]] = len(out)
            out.append([*r[:4], r[4], r[4]])
    return sorted((tuple(i) for i in out), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_corrections_equal_a_full_backfill(spark, seed):
    rng = random.Random(seed)
    rows = {(r[0], r[4]): r for r in dense_state(rng, 30, range(2000, 2012))}
    # values across a gap must differ, as an interval stands for a row in each of its periods
    before = intervals(rows.values())
    rows = {(i[0], y): (*i[:4], y) for i in before for y in range(i[4], i[5] + 1)}
    fixes = []
    for k in rng.sample(sorted(rows), 25):
        fixes.append((*rows[k][:2], rng.choice(["star", "good", None]), rng.random() < 0.5, k[1], rng.random() < 0.2))
    for e in range(3):  # periods the entity had no row in, and an entity never seen
        fixes.append((f"new{e}", f"n{e}", "star", True, 2003 + e, False))
    after = dict(rows)
    for f in fixes:
        after.pop((f[0], f[4]), None)
        if not f[5]:
            after[f[0], f[4]] = f[:5]
    scd = spark.createDataFrame(before, ACTORS_HISTORY_SCD).repartition(3)
    changes = scd2_correct(scd, spark.createDataFrame(fixes, STATE + ", gone boolean"), removed="gone")
    assert rows_of(scd2_apply(scd, changes), SCD) == intervals(after.values())
    touched = {f[0] for f in fixes}
    listed = changes.collect()
    assert {r.actorid for r in listed} <= touched  # nothing of the others is rewritten
    taken, put = ({tuple(r)[:6] for r in listed if r.op == op} for op in ("delete", "insert"))
    assert not taken & put and taken <= set(before) and not put & set(before)


def test_a_period_corrected_twice_fails(spark):
    scd = spark.createDataFrame([("a", "A", "star", True, 2000, 2004)], ACTORS_HISTORY_SCD)
    twice = spark.createDataFrame([("a", "A", "bad", True, 2001), ("a", "A", "good", True, 2001)], STATE)
    with pytest.raises(Exception, match="corrected twice"):
        scd2_correct(scd, twice).collect()
    assert rows_of(scd2_apply(scd, scd2_correct(scd, twice.where("false")))) == [("a", "A", "star", True, 2000, 2004)]
