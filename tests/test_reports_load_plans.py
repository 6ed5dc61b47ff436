"""Hand-made cases for the star reports and loads, plus physical-plan checks."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from laminar.functions.dates import as_timestamp, split_times
from laminar.operators import reports
from laminar.operators.joins import bounded_broadcast
from laminar.plans.load import file_bytes, layout_report, load_bucketed, rewrite_dedup
from laminar.plans.registry import QUERIES
from laminar.session import scratch_path
from tests.conftest import SF_SMALL

M = "match_id string, mapid string, playlist_id string, completion_date timestamp"
MD = "match_id string, player_gamertag string, player_total_kills int"
MMP = "match_id string, player_gamertag string, medal_id long, count int"


def _star(spark):
    matches = spark.createDataFrame([("m1", "1", "p1", None), ("m2", "2", "p1", None), ("m3", "1", "p2", None)], M)
    details = spark.createDataFrame([("m1", "a", 10), ("m1", "b", 20), ("m2", "a", 20)], MD)
    mmp = spark.createDataFrame([("m1", "a", 7, 1), ("m1", "a", 8, 1), ("m2", "a", 7, 2)], MMP)
    maps = spark.createDataFrame([("1", "Alpha"), ("2", "Beta")], "mapid string, name string")
    medals = spark.createDataFrame([(7, "Killing Spree"), (8, "Other")], "medal_id long, name string")
    return matches, details, mmp, maps, medals


def test_match_fact_left_joins_and_fanout(spark):
    matches, details, mmp, maps, _ = _star(spark)
    fact = reports.match_fact(matches, details, mmp)
    rows = sorted((tuple(r) for r in fact.collect()), key=repr)
    assert len(rows) == 5  # m1/a twice (two medals), m1/b, m2/a, m3 without players
    assert ("m3", "1", "p2", None, None, None) in rows
    pm = reports.player_match(fact, maps)
    assert pm.count() == 4 and pm.where("match_id = 'm3'").first().mapName == "Alpha"


def test_skew_safe_left_join_equals_left_join(spark):
    from laminar.operators.joins import left_join
    l = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d")], "k int, x string")
    r = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (None, 99)] + [(1, i) for i in range(50)], "k int, y int")
    a = sorted(map(tuple, left_join(l, r, ["k"]).collect()), key=repr)
    b = sorted(map(tuple, l.join(r, ["k"], "left").collect()), key=repr)
    assert a == b and left_join(l, r, ["k"]).columns == l.join(r, ["k"], "left").columns


def test_player_match_from_tables_equals_fact_form(spark):
    from laminar.sources import roles
    args = [f(spark, SF_SMALL) for f in (roles.matches, roles.match_details, roles.medal_matches_players)]
    a = reports.player_match(reports.match_fact(*args), roles.maps(spark, SF_SMALL))
    b = reports.player_match_from_tables(args[0], args[1], roles.maps(spark, SF_SMALL))
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_top1_reports_ties_and_nulls(spark):
    matches, details, mmp, maps, medals = _star(spark)
    pm = reports.player_match(reports.match_fact(matches, details, mmp), maps)
    # a: (10+20)/2 = 15, b: 20, NULL player: NULL avg -> last
    assert tuple(reports.top_avg_kills(pm).first()) == ("b", 20.0)
    assert tuple(reports.top_playlist(pm).first()) == ("p1", 3)
    # Alpha: m1/a, m1/b, m3 -> 3 rows; Beta: 1
    assert tuple(reports.top_map(pm).first()) == ("Alpha", 3)
    fact = reports.match_fact(matches, details, mmp)
    # Killing Spree rows: m1/a (map 1) and m2/a (map 2): tie 1-1 -> smallest name wins
    assert tuple(reports.top_medal_map(fact, medals, maps, "Killing Spree").first()) == ("Alpha", 1)


def test_medal_rows_from_tables_equal_fact_filter(spark):
    matches, details, mmp, maps, medals = _star(spark)
    fact = reports.match_fact(matches, details, mmp)
    a = sorted(tuple(r) for r in reports.medal_by_map(fact, medals, maps, "Killing Spree").collect())
    b = sorted(tuple(r) for r in reports.medal_by_map_from_tables(matches, details, mmp, medals, maps,
                                                                  "Killing Spree").collect())
    assert a == b and len(a) == 2
    q = QUERIES["top_medal_map"](spark, SF_SMALL).collect()
    from laminar.sources import roles
    f = reports.match_fact(roles.matches(spark, SF_SMALL), roles.match_details(spark, SF_SMALL),
                           roles.medal_matches_players(spark, SF_SMALL))
    assert q == reports.top_medal_map(f, roles.medals(spark, SF_SMALL), roles.maps(spark, SF_SMALL),
                                      roles.MEDAL_NAME).collect()


def test_shared_player_match_feeds_all_reports(spark):
    matches, details, mmp, maps, _ = _star(spark)
    with reports.shared_player_match(matches, details, maps) as pm:
        got = [tuple(f(pm).first()) for f in (reports.top_avg_kills, reports.top_playlist, reports.top_map)]
        assert pm.is_cached
    assert got == [("b", 20.0), ("p1", 3), ("Alpha", 3)] and not pm.is_cached


def test_top1_all_null_group_counts_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "playlist_id string")
    assert tuple(reports.top_playlist(df).first()) == (None, 0)


def test_bounded_broadcast_checks_size(spark):
    hinted = spark.range(10).join(bounded_broadcast(spark.range(5), max_rows=10), "id")
    unhinted = spark.range(10).join(bounded_broadcast(spark.range(50), max_rows=10), "id")
    assert "BROADCAST" in hinted._jdf.queryExecution().logical().toString().upper()
    assert "BROADCAST" not in unhinted._jdf.queryExecution().logical().toString().upper()


def test_size_check_reads_only_what_the_bound_needs(spark):
    from laminar.operators.joins import fits_broadcast
    sc = spark.sparkContext
    big = spark.range(0, 2_000_000, numPartitions=200)
    sc.setJobGroup("size-check", "size-check")
    try:
        assert not fits_broadcast(big, 1000)
        st = sc.statusTracker()
        tasks = sum(st.getStageInfo(s).numTasks for j in st.getJobIdsForGroup("size-check")
                    for s in st.getJobInfo(j).stageIds if st.getStageInfo(s))
    finally:
        sc.setJobGroup("", "")
    assert tasks < 50  # incremental take: a few partitions, not all 200
    assert fits_broadcast(spark.range(1000), 1000) and not fits_broadcast(spark.range(1001), 1000)


def test_load_bucketed_drops_null_slice_and_buckets(spark):
    df = spark.createDataFrame([("m1", "1", "p", dt.datetime(2020, 1, 1)), ("m2", "1", "p", None)], M)
    t = load_bucketed(spark, df, scratch_path(spark, "t_matches"), "match_id", 4, drop_null="completion_date")
    assert [r.match_id for r in t.collect()] == ["m1"]


def test_files_per_bucket_spreads_a_hot_key_and_keeps_buckets(spark):
    ids = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    df = spark.range(6000).select(ids.alias("match_id"), F.col("id").alias("v"))
    t = load_bucketed(spark, df, scratch_path(spark, "tfb"), "match_id", 4, files_per_bucket=3)
    files = (t.select(F.input_file_name().alias("f"), F.expr("pmod(hash(match_id), 4)").alias("b"),
                      (F.col("match_id") == "hot").alias("hot"))
             .groupBy("f").agg(F.countDistinct("b").alias("nb"), F.max("hot").alias("has_hot")).collect())
    assert all(r.nb == 1 for r in files) and t.count() == 6000
    assert sum(1 for r in files if r.has_hot) >= 2  # the hot key is written by several tasks
    # the bucketed layout still serves shuffle-free joins
    t1 = load_bucketed(spark, df, scratch_path(spark, "tfb1"), "match_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = t.join(t1, "match_id")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_join_has_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(1000).select(F.col("id").cast("string").alias("match_id"), F.lit("x").alias("v"))
        b = spark.range(1000).select(F.col("id").cast("string").alias("match_id"), F.lit(1).alias("w"))
        ta = load_bucketed(spark, a, scratch_path(spark, "ta"), "match_id", 8)
        tb = load_bucketed(spark, b, scratch_path(spark, "tb"), "match_id", 8)
        plan = ta.join(tb, "match_id", "left")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        from laminar.operators.joins import left_join
        plain = left_join(ta, tb, ["match_id"], skew_safe=False)
        plain.collect()
        assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_layout_report_and_file_bytes(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    rep = {r.sort_column: r for r in layout_report(spark, df, ["a", "b"], scratch_path(spark, "lay")).collect()}
    assert set(rep) == {"unsorted", "a", "b"} and all(r.bytes > 0 and r.n_rows == 2000 for r in rep.values())
    assert rep["unsorted"].sorted is None and rep["a"].sorted and rep["b"].sorted


def test_rewrite_dedup_new_version(spark):
    v1 = scratch_path(spark, "gd")
    spark.createDataFrame([(1, 2), (1, 1), (2, 5)], "k int, v int").write.parquet(v1)
    v2 = scratch_path(spark, "gd")
    got = sorted(tuple(r) for r in rewrite_dedup(spark, v1, v2, ["k"]).collect())
    assert got == [(1, 1), (2, 5)] and spark.read.parquet(v1).count() == 3  # old version intact
    sizes = file_bytes(spark, v2)
    assert sizes.agg(F.sum("bytes")).first()[0] > 0 and "content" not in _plan(sizes).split("ReadSchema")[-1]


def test_text_event_times_fail_or_are_split_off(spark):
    df = spark.createDataFrame([("2023-01-02 10:00:00",), ("not a time",), (None,)], "event_time string")
    with pytest.raises(Exception, match="not an event time: not a time"):
        df.select(as_timestamp(df, "event_time")).collect()
    good, rejected = split_times(df, "event_time")
    assert [r[0] for r in good.select(as_timestamp(good, "event_time")).collect()] == [dt.datetime(2023, 1, 2, 10), None]
    assert [r[0] for r in rejected.collect()] == ["not a time"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bitmap_plan_has_no_cartesian_product(spark):
    plan = _plan(QUERIES["datelist_int"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_dedup_plan_uses_partial_aggregate_not_window(spark):
    plan = _plan(QUERIES["dedup_details"](spark, SF_SMALL))
    assert "Window" not in plan and "partial_min" in plan


def test_day_predicate_reaches_parquet_scan(spark):
    from laminar.operators.reduced import daily_counts
    from laminar.sources import roles
    c = daily_counts(roles.events(spark, SF_SMALL)).where(F.col("day") == F.lit(dt.date(2024, 1, 3)))
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(user_id), IsNotNull(ts), GreaterThanOrEqual(ts" in plan or \
        ("GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan), plan


def test_no_python_udfs_anywhere(spark):
    for key in ["actors_cumulative", "user_datelist", "reduced_hits", "player_match", "scd2_backfill"]:
        plan = _plan(QUERIES[key](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_overwrite_partitions_bounds_files_and_replaces_only_its_partitions(spark):
    from laminar.plans.tables import overwrite_partitions
    path = scratch_path(spark, "parts")
    df = spark.range(3000, numPartitions=16).select((F.col("id") % 3).alias("p"), F.col("id"))
    overwrite_partitions(df, path, "p", files_per_partition=2)
    per = (spark.read.parquet(path).select("p", F.input_file_name().alias("f")).distinct()
           .groupBy("p").count().collect())
    assert len(per) == 3 and all(r["count"] <= 2 for r in per)
    overwrite_partitions(spark.createDataFrame([(0, -1)], "p long, id long"), path, "p")
    got = spark.read.parquet(path)
    assert got.where("p = 0").count() == 1 and got.where("p = 1").count() == 1000
