"""Increments replace what they should: re-runs, empty periods, moved-on records, NULL keys, late and replayed files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from laminar.operators.checks import key_violations
from laminar.operators.cumulate import cumulate_year_step, cumulate_years
from laminar.operators.datelist import datelist_backfill, datelist_days, host_activity, user_activity
from laminar.operators.joins import left_join
from laminar.operators.reduced import daily_counts, reduce_month, reduce_months, reduce_step
from laminar.operators.scd2 import scd2_backfill
from laminar.plans import incremental as inc
from laminar.plans.load import create_table, load_bucketed, reload_dedup
from laminar.plans.tables import drop_versions, read_partition, versions, write_version
from laminar.session import scratch_path
from laminar.sources.readers import read_csv, split_rejects
from laminar.sources.schemas import HOST_ACTIVITY_REDUCED, HOSTS_CUMULATED, TABLES
from laminar.streaming import host_datelist_load, read_streamed_reduced, reduced_load, run_stream, undated

D = dt.date
SNAP = "actorid string, actor string, quality_class string, is_active boolean, current_year int"
EV = "url string, referrer string, user_id long, device_id long, host string, event_time timestamp"


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def cols(df):
    return df.select("actorid", "quality_class", "is_active", "start_date", "end_date")


def ts(month, day, h=12):
    return dt.datetime(2023, month, day, h)


def events(spark, items):
    return spark.createDataFrame([(None, None, u, 1, h, t) for h, u, t in items], EV)


# ---- SCD ----

@pytest.mark.parametrize("data,years", [
    ([("a", "A", "star", True, y) for y in (2000, 2001, 2002)], [2000, 2001, 2002]),  # every record moves on
    ([("a", "A", "star", True, 2000), ("a", "A", "star", True, 2002)], [2000, 2001, 2002]),  # a year without rows
    ([("a", "A", "star", True, 2000), ("b", "B", "bad", True, 2000), ("a", "A", "bad", True, 2001), ("b", "B", "bad", True, 2001),
      ("a", "A", "bad", True, 2002), ("b", "B", "good", False, 2002)], [2000, 2001, 2002]),
])
def test_scd_years_equal_backfill_and_can_be_run_again(spark, data, years):
    state, path = spark.createDataFrame(data, SNAP), scratch_path(spark, "scd")
    table = inc.scd2_load_years(spark, state, years, path)
    assert rows(cols(table)) == rows(cols(scd2_backfill(state)))
    assert key_violations(table, ["actorid", "start_date"]).count() == 0
    for y in years:  # any year again, in any order
        inc.scd2_load_year(spark, state, y, path)
        assert rows(cols(inc.read_scd2(spark, path))) == rows(cols(scd2_backfill(state)))
    inc.scd2_load_year(spark, state, years[-1], path)
    assert rows(cols(inc.read_scd2(spark, path))) == rows(cols(scd2_backfill(state)))


# ---- reduced months ----

def test_a_day_loaded_again_changes_nothing(spark):
    counts = daily_counts(events(spark, [("h", 1, ts(1, 1)), ("h", 2, ts(1, 2)), ("g", 3, ts(1, 2)), (None, 4, ts(1, 3))]))
    want = reduce_month(counts, D(2023, 1, 1), D(2023, 1, 3))
    state = spark.createDataFrame([], HOST_ACTIVITY_REDUCED)
    for d in (1, 2, 2, 3, 3):
        state = reduce_step(state, counts, D(2023, 1, d))
    assert rows(state) == rows(want) and None in {r.host for r in state.collect()}
    path = scratch_path(spark, "reduced")
    got = inc.reduce_load_days(spark, counts, path, D(2023, 1, 1), 3, step=2)
    assert rows(got) == rows(want)
    for first, last in ((2, 2), (1, 3), (3, 3)):
        inc.reduce_load_range(spark, counts, path, D(2023, 1, first), D(2023, 1, last))
        assert rows(inc.read_reduced(spark, path, [D(2023, 1, 1)])) == rows(want)


def test_all_months_in_one_job_equal_the_loop(spark):
    ev = events(spark, [("h", 1, ts(1, 30)), ("h", 1, ts(2, 2)), ("g", 2, ts(2, 1)), (None, 3, ts(1, 1))])
    counts = daily_counts(ev)
    want = reduce_months(counts, D(2023, 2, 3))
    assert {(r.host, r.month): len(r.hit_array) for r in want.collect()} == {
        ("h", D(2023, 1, 1)): 31, ("h", D(2023, 2, 1)): 3, ("g", D(2023, 2, 1)): 3, (None, D(2023, 1, 1)): 31}
    got = inc.reduce_load_days(spark, counts, scratch_path(spark, "months"), D(2023, 1, 1), 34)
    assert rows(got) == rows(want)


def test_wide_counts_are_exact(spark):
    big = spark.createDataFrame([("h", D(2023, 1, 1), 16_777_217, 1)], "host string, day date, hits long, visitors long")
    assert reduce_month(big, D(2023, 1, 1), D(2023, 1, 1), count_type="long").first().hit_array == [16_777_217]


# ---- date lists, spellings ----

def test_null_hosts_agree_in_steps_ranges_and_closed_form(spark):
    act = host_activity(events(spark, [(None, 1, ts(1, 1)), (None, 1, ts(1, 2)), ("h", 1, ts(1, 3)), (None, 1, ts(1, 3))]))
    want = datelist_backfill(act, ["host"], D(2023, 1, 1), D(2023, 1, 3), "host_activity_datelist")
    nullable = HOSTS_CUMULATED
    got = inc.datelist_load_days(spark, act, ["host"], scratch_path(spark, "hosts"), D(2023, 1, 1), 3,
                                 "host_activity_datelist", nullable)
    assert rows(got.select("host", "date", "host_activity_datelist")) == rows(want.select("host", "date", "host_activity_datelist"))
    y = want.where(F.col("date") == F.lit(D(2023, 1, 1)))
    ranged = datelist_days(y, act, ["host"], D(2023, 1, 2), D(2023, 1, 3), "host_activity_datelist")
    assert rows(ranged.select("host", "date")) == rows(want.where("date > '2023-01-01'").select("host", "date"))


def test_user_activity_does_not_depend_on_the_size_check(spark):
    ev = events(spark, [("h", 1, ts(1, 1))] * 5)
    dev = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "device_id long, browser_type string")
    for distinct in (True, False):
        small = user_activity(ev, dev, distinct=distinct)
        large = user_activity(ev, dev, distinct=distinct, max_broadcast_rows=1)
        assert rows(small) == rows(large) and small.count() == (2 if distinct else 10)


def test_two_spellings_are_one_row_under_carry(spark):
    f = spark.createDataFrame([("a", "Ann", "x", 1, 9.0, "1", 2001), ("a", "ANN", "y", 1, 7.0, "2", 2001), ("a", "Ann", "z", 1, 7.0, "3", 2002)],
                              "actorid string, actor string, film string, votes int, rating float, filmid string, year int")
    closed = cumulate_years(f, seed=2000, history="carry")
    state = closed.limit(0)
    for _ in range(2):
        state = spark.createDataFrame(state.unionByName(cumulate_year_step(state, f, seed=2000, history="carry")).collect(), state.schema)
    assert rows(state.select(*closed.columns)) == rows(closed) and closed.count() == 2


# ---- streams ----

def _stream(spark, model, batches, staging, ckpt, src, **kw):
    for i, items in enumerate(batches):
        events(spark, items).write.mode("append").parquet(src)
        run_stream(spark, src, events(spark, []).schema, model, staging, ckpt, finalize=i == len(batches) - 1, **kw)


BATCHES = [[("h", 1, ts(1, 1)), ("h", 1, ts(1, 3)), ("g", 2, ts(1, 4))],
           [("h", 2, ts(1, 1)), ("g", 1, ts(1, 2)), ("h", 1, ts(1, 6)), ("z", 5, None)],  # late for closed days, and undated
           [("n", 9, ts(1, 2)), ("h", 3, ts(2, 1))]]


def test_out_of_order_files_give_the_closed_forms(spark):
    ev = events(spark, [i for b in BATCHES for i in b])
    src, staging, ckpt, target = (scratch_path(spark, n) for n in ("src", "stg", "ck", "hosts"))
    _stream(spark, host_datelist_load(target, D(2023, 1, 1)), BATCHES, staging, ckpt, src)
    want = datelist_backfill(host_activity(ev), ["host"], D(2023, 1, 1), D(2023, 2, 1), "host_activity_datelist")
    got = spark.read.parquet(target)
    assert rows(got.select("host", "date", "host_activity_datelist")) == rows(want.select("host", "date", "host_activity_datelist"))
    assert undated(spark, staging) == 1
    src, staging, ckpt, target = (scratch_path(spark, n) for n in ("src", "stg", "ck", "red"))
    _stream(spark, reduced_load(target, D(2023, 1, 1)), BATCHES, staging, ckpt, src)
    assert rows(read_streamed_reduced(spark, target)) == rows(reduce_months(daily_counts(ev), D(2023, 2, 1)))


def test_a_failed_batch_is_not_counted_twice(spark):
    src, staging, ckpt, target = (scratch_path(spark, n) for n in ("src", "stg", "ck", "red"))
    model = reduced_load(target, D(2023, 1, 1))
    load, broken = model.load_range, [True]

    def once_broken(*a):
        if broken:
            broken.pop()
            raise RuntimeError("lost")
        return load(*a)

    model.load_range = once_broken
    items = [("h", 1, ts(1, 1)), ("h", 1, ts(1, 2))]
    with pytest.raises(Exception):
        _stream(spark, model, [items], staging, ckpt, src)
    run_stream(spark, src, events(spark, []).schema, model, staging, ckpt, finalize=True)
    assert rows(read_streamed_reduced(spark, target)) == rows(reduce_months(daily_counts(events(spark, items)), D(2023, 1, 2)))


# ---- tables, loads, CSV ----

def test_only_a_missing_path_is_an_empty_partition(spark):
    path = scratch_path(spark, "odd")
    assert read_partition(spark, path, HOSTS_CUMULATED, "date", D(2023, 1, 1)).count() == 0
    spark.createDataFrame([("x",)], "v string").write.text(f"{path}/date=2023-01-01")
    with pytest.raises(Exception):
        read_partition(spark, path, HOSTS_CUMULATED, "date", D(2023, 1, 1)).collect()


def test_reload_dedup_swaps_versions(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([(1, 2), (1, 1), (2, 5)], "k int, v int")
    write_version(df, path, "v", f"{1:09d}")
    assert rows(reload_dedup(spark, path, df.schema, ["k"])) == rows(spark.createDataFrame([(1, 1), (2, 5)], "k int, v int"))
    assert versions(spark, path, "v") == ["000000001", "000000002"]
    drop_versions(spark, path, "v", keep=1)
    assert versions(spark, path, "v") == ["000000002"]


def test_slices_append_to_a_bucketed_table(spark):
    name, root = f"laminar_{scratch_path(spark, 'x')[-12:]}", scratch_path(spark, "slices")
    create_table(spark, name, TABLES["matches"], root, 4)
    for day in (1, 2, 3):
        part = spark.createDataFrame([(f"m{i}", "1", "p", dt.datetime(2020, 1, day)) for i in range(day)],
                                     "match_id string, mapid string, playlist_id string, completion_date timestamp")
        load_bucketed(spark, part, root, "match_id", 4, name=name, mode="append")
    assert spark.table(name).count() == 6
    with pytest.raises(ValueError):
        load_bucketed(spark, spark.table(name), root, mode="append")


def test_csv_headers_and_values_are_checked(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("n", "1", "d")], "name string, mapid string, description string").write.option("header", "true").csv(path)
    with pytest.raises(Exception):
        read_csv(spark, path, "maps").collect()
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("p", "a", "abc", "1"), ("p", "a", "2", "1")], "match_id string, player_gamertag string, medal_id string, count string"
                          ).coalesce(1).write.option("header", "true").csv(path)
    with pytest.raises(Exception):
        read_csv(spark, path, "medal_matches_players").collect()
    good, bad = split_rejects(read_csv(spark, path, "medal_matches_players", keep_rejects=True))
    assert [r.medal_id for r in good.collect()] == [2] and [r["_corrupt_record"] for r in bad.collect()] == ["p,a,abc,1"]


def test_a_cluster_session_must_name_its_folder(spark, monkeypatch):
    from laminar import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, *a):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_a_hot_right_key_is_spread_and_left_is_read_once(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.createDataFrame([(0, "x"), (0, "y"), (1, "z"), (None, "n"), (9, "q")], "k int, a string")
        right = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5 + 1).cast("int").alias("k"), F.col("id").alias("b"))
        path = scratch_path(spark, "left")
        left.write.parquet(path)
        out = left_join(spark.read.parquet(path), right, ["k"], hot_rows=1000, salts=8)
        want = left.join(right, ["k"], "left").select("k", "a", "b")
        assert rows(out.select("k", "a", "b")) == rows(want)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan parquet") == 1 and plan.count("SortMergeJoin") == 1, plan
        tasks = out.where("k = 0").groupBy(F.spark_partition_id()).count().count()
        assert tasks >= 3  # the hot key's rows are joined in several tasks
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
