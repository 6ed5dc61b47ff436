"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Each query builds the stand-in roles from the given tables, runs the library
operator over the whole tables, and projects nested results into flat, comparable
columns (arrays become delimited strings) so the DuckDB oracle can check them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.functions.bands import AS_WRITTEN, QUALITY_CLASSES, SPEC
from laminar.operators import reports
from laminar.operators.checks import domain_summary, key_violations
from laminar.operators.cumulate import cumulate_years
from laminar.operators.datelist import datelist_backfill, datelist_bitmap, host_activity, user_activity
from laminar.operators.dedup import dedup
from laminar.operators.reduced import daily_counts, explode_days, fix_last_variants, reduce_months
from laminar.operators.scd2 import scd2_apply, scd2_backfill, scd2_correct
from laminar.plans import incremental, keyed, ranges, registers
from laminar.operators.upsert import upsert
from laminar.plans.load import (bucket_count, layout_report, load_bucketed, load_report_slices, load_salted_star, load_star,
                                match_bucket_join, reload_dedup)
from laminar.plans.tables import overwrite_partitions, write_version
from laminar.session import scratch_path
from laminar.sources import roles
from laminar.sources.infer import compare_schema
from laminar.sources.readers import read_csv
from laminar.sources.schemas import HOSTS_CUMULATED, TABLES, USER_DEVICES_CUMULATED
from laminar.streaming import host_datelist_load, read_streamed_reduced, reduced_load, run_stream

Query = Callable[[SparkSession, str], DataFrame]


def films_key(films: Column) -> Column:
    return F.array_join(F.transform(films, lambda f: F.concat_ws(
        ":", f["filmid"], f["film"], f["votes"].cast("string"))), "|")


def _flat_actors(df: DataFrame) -> DataFrame:
    return df.select("actorid", "actor", films_key(F.col("films")).alias("films_key"),
                     F.size("films").cast("long").alias("n_films"), "quality_class",
                     "current_year", "is_active")


def actors(spark: SparkSession, sf_dir: str, history: str = "two_period", bands=AS_WRITTEN) -> DataFrame:
    return cumulate_years(roles.actor_films(spark, sf_dir), seed=roles.ACTOR_SEED_YEAR,
                          history=history, bands=bands)


def q_actors_cumulative(spark, sf_dir):
    return _flat_actors(actors(spark, sf_dir))


def q_actors_cumulative_spec_bands(spark, sf_dir):
    return _flat_actors(actors(spark, sf_dir, bands=SPEC))


def q_actors_cumulative_carry(spark, sf_dir):
    return _flat_actors(actors(spark, sf_dir, history="carry"))


def q_scd2_backfill(spark, sf_dir):
    return scd2_backfill(actors(spark, sf_dir))


def q_dedup_details(spark, sf_dir):
    return dedup(roles.game_details(spark, sf_dir), ["l_orderkey", "l_linenumber"])


def dedup_events(spark, sf_dir, day=None):
    """Events deduplicated per (user, device, day), of one day if given (the day is part of the key)."""
    ev = roles.events(spark, sf_dir)
    if day is not None:
        ev = ev.where(F.to_date("event_time") == day)
    keyed = ev.withColumn("event_date", F.to_date("event_time"))
    return dedup(keyed, ["user_id", "device_id", "event_date"]).select(*ev.columns)


def q_dedup_events(spark, sf_dir):
    return dedup_events(spark, sf_dir)


def q_dedup_devices(spark, sf_dir):
    return dedup(roles.device_catalog(spark, sf_dir), ["p_brand", "p_type"])


def q_check_domain(spark, sf_dir):
    return domain_summary(actors(spark, sf_dir, bands=SPEC), "quality_class", QUALITY_CLASSES)


def q_check_key(spark, sf_dir):
    return key_violations(roles.game_details(spark, sf_dir), ["l_orderkey", "l_linenumber"])


# ---- date lists -------------------------------------------------------------
USER_KEYS = ["user_id", "browser_type"]


def _last_event_day(ev: DataFrame):
    return ev.agg(F.max(F.to_date("event_time"))).scalar()


def _dates_str(arr: Column) -> Column:
    return F.array_join(F.transform(arr, lambda d: d.cast("string")), ",")


def user_datelist(spark, sf_dir, as_of=None):
    ev = roles.events(spark, sf_dir)
    act = user_activity(ev, roles.devices(spark, sf_dir), distinct=False)
    return datelist_backfill(act, USER_KEYS, roles.EVENTS_FIRST_DAY, _last_event_day(ev),
                             "device_actives", as_of=as_of)


def host_datelist(spark, sf_dir):
    ev = roles.events(spark, sf_dir)
    return datelist_backfill(host_activity(ev, distinct=False), ["host"], roles.EVENTS_FIRST_DAY, _last_event_day(ev),
                             "host_activity_datelist")


def q_user_datelist(spark, sf_dir):
    return user_datelist(spark, sf_dir).select(
        *USER_KEYS, "date", _dates_str(F.col("device_actives")).alias("device_actives"),
        F.size("device_actives").cast("long").alias("n_active"))


def q_host_datelist(spark, sf_dir):
    return host_datelist(spark, sf_dir).select(
        "host", "date", _dates_str(F.col("host_activity_datelist")).alias("host_activity_datelist"),
        F.size("host_activity_datelist").cast("long").alias("n_active"))


def q_datelist_int(spark, sf_dir):
    snap = user_datelist(spark, sf_dir, as_of=roles.SNAPSHOT_DATE)
    return datelist_bitmap(snap, USER_KEYS, "device_actives", roles.MONTH_START)


# ---- reduced month facts ----------------------------------------------------
def _counts_str(arr: Column) -> Column:
    return F.array_join(F.transform(arr, lambda x: x.cast("long").cast("string")), ",", "NULL")


def reduced(spark, sf_dir):
    """The month table of all months, with slots wide enough for any count."""
    ev = roles.events(spark, sf_dir)
    return reduce_months(daily_counts(ev), _last_event_day(ev), count_type="long")


def q_reduced_hits(spark, sf_dir):
    return reduced(spark, sf_dir).select("host", "month", _counts_str(F.col("hit_array")).alias("hit_array"),
                                         F.size("hit_array").cast("long").alias("n_days"))


def q_reduced_visitors(spark, sf_dir):
    return reduced(spark, sf_dir).select(
        "host", "month", _counts_str(F.col("unique_visitor_array")).alias("unique_visitor_array"),
        F.size("unique_visitor_array").cast("long").alias("n_days"))


def q_reduced_fix_last(spark, sf_dir):
    """The last day's month, last slots corrected by a recount over that day's deduplicated events."""
    ev = roles.events(spark, sf_dir)
    last = _last_event_day(ev)
    state = reduce_months(daily_counts(ev), last, count_type="long")
    recount = daily_counts(dedup_events(spark, sf_dir, last))
    fixed = fix_last_variants(state, recount, last, count_type="long")
    return fixed.select("host", "month", *[_counts_str(F.col(c)).alias(c) for c in fixed.columns[2:]])


def q_reduced_daily(spark, sf_dir):
    return explode_days(reduced(spark, sf_dir))


# ---- star reports -----------------------------------------------------------
MEDAL_NAME = roles.MEDAL_NAME


def fact(spark, sf_dir):
    return reports.match_fact(roles.matches(spark, sf_dir), roles.match_details(spark, sf_dir),
                              roles.medal_matches_players(spark, sf_dir))


def player_match(spark, sf_dir):
    return reports.player_match_from_tables(roles.matches(spark, sf_dir), roles.match_details(spark, sf_dir),
                                            roles.maps(spark, sf_dir))


def q_match_fact(spark, sf_dir):
    return fact(spark, sf_dir)


def q_player_match(spark, sf_dir):
    return player_match(spark, sf_dir)


def q_top_avg_kills(spark, sf_dir):
    r = reports.top_avg_kills(player_match(spark, sf_dir))
    return r.select("player_gamertag", F.round("avg_kill_per_game", 6).alias("avg_kill_per_game"))


def q_top_playlist(spark, sf_dir):
    return reports.top_playlist(player_match(spark, sf_dir))


def q_top_map(spark, sf_dir):
    return reports.top_map(player_match(spark, sf_dir))


def q_top_medal_map(spark, sf_dir):
    return reports.top_medal_map_from_tables(
        roles.matches(spark, sf_dir), roles.match_details(spark, sf_dir),
        roles.medal_matches_players(spark, sf_dir), roles.medals(spark, sf_dir), roles.maps(spark, sf_dir),
        MEDAL_NAME)


# ---- serial (incremental) loads: the same tables, one period per job --------
def actors_loaded(spark, sf_dir, history="two_period"):
    facts = roles.actor_films(spark, sf_dir)
    last_year = facts.agg(F.max("year")).first()[0]
    runs = int(last_year) - roles.ACTOR_SEED_YEAR + 1  # one run past the end hits the stop guard
    return incremental.load_years(spark, facts, scratch_path(spark, "actors"), roles.ACTOR_SEED_YEAR, runs,
                                  history=history)


def q_actors_incremental(spark, sf_dir):
    return _flat_actors(actors_loaded(spark, sf_dir))


def q_actors_incremental_carry(spark, sf_dir):
    return _flat_actors(actors_loaded(spark, sf_dir, history="carry"))


def q_scd2_incremental(spark, sf_dir):
    path = scratch_path(spark, "actors")
    overwrite_partitions(actors(spark, sf_dir), path, "current_year", files_per_partition=2)
    state = spark.read.parquet(path)
    years = [r[0] for r in state.select("current_year").distinct().orderBy("current_year").collect()]
    return incremental.scd2_load_years(spark, state, years, scratch_path(spark, "actors_scd"))


def q_host_datelist_incremental(spark, sf_dir):
    ev = roles.events(spark, sf_dir)
    first = dt.date.fromisoformat(roles.EVENTS_FIRST_DAY)
    last = ev.agg(F.max(F.to_date("event_time"))).first()[0]
    table = incremental.datelist_load_days(spark, host_activity(ev), ["host"], scratch_path(spark, "hosts"),
                                           first, (last - first).days + 1, "host_activity_datelist",
                                           HOSTS_CUMULATED)
    return table.select("host", "date",
                        _dates_str(F.col("host_activity_datelist")).alias("host_activity_datelist"),
                        F.size("host_activity_datelist").cast("long").alias("n_active"))


def q_user_datelist_incremental(spark, sf_dir):
    ev = roles.events(spark, sf_dir)
    first = dt.date.fromisoformat(roles.EVENTS_FIRST_DAY)
    last = ev.agg(F.max(F.to_date("event_time"))).first()[0]
    act = user_activity(ev, roles.devices(spark, sf_dir), distinct=False)
    table = incremental.datelist_load_days(spark, act, USER_KEYS, scratch_path(spark, "user_devices"),
                                           first, (last - first).days + 1, "device_actives",
                                           USER_DEVICES_CUMULATED)
    return table.select(*USER_KEYS, "date", _dates_str(F.col("device_actives")).alias("device_actives"),
                        F.size("device_actives").cast("long").alias("n_active"))


def q_reduced_incremental(spark, sf_dir):
    ev = roles.events(spark, sf_dir)
    day = F.to_date("event_time")
    first, last = ev.agg(F.min(F.trunc(day, "MM")), F.max(day)).first()
    table = incremental.reduce_load_days(spark, daily_counts(ev), scratch_path(spark, "reduced"), first,
                                         (last - first).days + 1, count_type="long")
    return table.select("host", "month", _counts_str(F.col("hit_array")).alias("hit_array"),
                        F.size("hit_array").cast("long").alias("n_days"))


# ---- loads ------------------------------------------------------------------
def q_load_sliced(spark, sf_dir):
    """Matches loaded into a table bucketed by match; rows with no completion date are not loaded."""
    matches = roles.matches(spark, sf_dir)
    return load_bucketed(spark, matches, scratch_path(spark, "matches"), "match_id", bucket_count(matches), drop_null="completion_date")


def layout_full(spark, sf_dir):
    """The layout trial with its file sizes."""
    return layout_report(spark, fact(spark, sf_dir), list(roles.LAYOUT_COLUMNS), scratch_path(spark, "layout"))


def q_layout_report(spark, sf_dir):
    """What does not depend on the writer: rows of each layout, and whether it is sorted."""
    return layout_full(spark, sf_dir).select("sort_column", "n_rows", "sorted")


def _reloaded(spark, df, name, keys):
    path = scratch_path(spark, name)
    write_version(df, path, "v", f"{1:09d}")
    return reload_dedup(spark, path, df.schema, keys)


def q_dedup_rewrite(spark, sf_dir):
    """The detail table written as a table, then reloaded with its deduplicated self."""
    return _reloaded(spark, roles.game_details(spark, sf_dir), "game_details", ["l_orderkey", "l_linenumber"])


def q_dedup_rewrite_events(spark, sf_dir):
    ev = roles.events(spark, sf_dir)
    keyed = ev.withColumn("event_date", F.to_date("event_time"))
    return _reloaded(spark, keyed, "events", ["user_id", "device_id", "event_date"]).select(*ev.columns)


def q_dedup_rewrite_devices(spark, sf_dir):
    return _reloaded(spark, roles.device_catalog(spark, sf_dir), "devices", ["p_brand", "p_type"])


def q_match_fact_bucketed(spark, sf_dir):
    """The star fact over tables bucketed by match: neither join needs an exchange.

    The second join is on match and player; with the match as the only bucket key that takes the setting
    of the reference's report job, which holds while the fact is written.
    """
    tables = {"matches": roles.matches(spark, sf_dir), "match_details": roles.match_details(spark, sf_dir),
              "mmp": roles.medal_matches_players(spark, sf_dir)}
    n = bucket_count(*tables.values())
    m, d, p = (load_bucketed(spark, df, scratch_path(spark, name), buckets=n) for name, df in tables.items())
    out = scratch_path(spark, "match_fact")
    with match_bucket_join(spark):
        reports.match_fact(m, d, p, skew_safe=False).write.parquet(out)
    return spark.read.parquet(out)


def q_upsert_by_key(spark, sf_dir):
    """Order counts upserted into the customers by key: names stay, counts are taken from the source."""
    c = roles.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("long").alias("n"))
    o = (roles.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(F.count(F.lit(1)).alias("n"))
         .withColumn("name", F.lit(None).cast("string")))
    return upsert(c, o, ["custkey"], update_cols=["n"])


def q_check_domain_violations(spark, sf_dir):
    """A column checked against a domain that leaves out one of its values."""
    return domain_summary(roles.table(spark, sf_dir, "lineitem"), "l_returnflag", ("A", "N"))


def q_csv_load_star(spark, sf_dir):
    """The five star tables as CSV files, loaded through their declared schemas into created tables."""
    files = _star_files(spark, sf_dir)
    root = scratch_path(spark, "star")
    loaded = load_star(spark, files, f"laminar_{root[-12:]}", root)
    keys = {"maps": "mapid", "medals": "medal_id"}
    out = None
    for name, df in loaded.items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(keys.get(name, "match_id")).alias("n_keys"))
        row = row.select(F.lit(name).alias("table_name"), "n_rows", "n_keys")
        out = row if out is None else out.unionByName(row)
    return out


# ---- several periods a job, corrections --------------------------------------
def _spans(first: int, last: int, step: int) -> list[tuple[int, int]]:
    return [(y, min(last, y + step - 1)) for y in range(first, last + 1, step)]


def actors_ranged(spark, sf_dir, history="two_period", step=3):
    """The cumulative table caught up by several years a job; the last range reaches past the end."""
    facts = roles.actor_films(spark, sf_dir)
    last_year = facts.agg(F.max("year")).first()[0]
    return ranges.load_year_ranges(spark, facts, scratch_path(spark, "actors"), roles.ACTOR_SEED_YEAR,
                                   _spans(roles.ACTOR_SEED_YEAR + 1, int(last_year) + 1, step), history=history)


def q_actors_ranged(spark, sf_dir):
    return _flat_actors(actors_ranged(spark, sf_dir))


def q_actors_ranged_carry(spark, sf_dir):
    return _flat_actors(actors_ranged(spark, sf_dir, history="carry"))


def _stored_actors(spark, sf_dir):
    path = scratch_path(spark, "actors")
    overwrite_partitions(actors(spark, sf_dir), path, "current_year", files_per_partition=2)
    return spark.read.parquet(path)


def q_scd2_ranged(spark, sf_dir, step=3):
    state = _stored_actors(spark, sf_dir)
    first, last = state.agg(F.min("current_year"), F.max("current_year")).first()
    return ranges.scd2_load_ranges(spark, state, _spans(first, last, step), scratch_path(spark, "actors_scd"))


def q_scd2_corrected(spark, sf_dir):
    """A dimension built from a state with wrong classes in the past, put right by corrections of those rows alone."""
    state = _stored_actors(spark, sf_dir)
    wrong = F.crc32(F.concat_ws(":", "actorid", F.col("current_year").cast("string"))) % 10 == 0
    other = F.when(F.col("quality_class") == "star", "bad").otherwise("star")
    path = scratch_path(spark, "actors_scd")
    scd2_backfill(state.withColumn("quality_class", F.when(wrong, other).otherwise(F.col("quality_class")))).write.parquet(path)
    scd, changes = spark.read.parquet(path), scratch_path(spark, "scd_changes")
    scd2_correct(scd, state.where(wrong)).write.parquet(changes)
    return scd2_apply(scd, spark.read.parquet(changes))


# ---- keys of tables -------------------------------------------------------------
def q_insert_keyed(spark, sf_dir):
    """Order lines inserted under their key in two batches that overlap, into a table partitioned by return flag.

    The first batch skips what repeats in it; the second rejects what is taken or repeats.
    The result is the table by batch, and the number of rejected rows by reason.
    """
    keys = ["l_returnflag", "l_orderkey", "l_linenumber"]
    lines = roles.game_details(spark, sf_dir).select(*keys)
    path = scratch_path(spark, "lines")
    first = keyed.insert_keyed(spark, lines.where(F.col("l_orderkey") % 3 != 0), path, lines.schema, keys, "skip", "l_returnflag")
    second = keyed.insert_keyed(spark, lines.where(F.col("l_orderkey") % 3 != 1), path, lines.schema, keys, "reject", "l_returnflag")
    table = spark.read.schema(lines.schema).parquet(path)
    kept = table.agg(F.lit("table").alias("part"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*keys).alias("n_keys"))
    loads = spark.createDataFrame([("first", first.n_rows, first.n_rows), ("second", second.n_rows, second.n_rows)], kept.schema)
    why = second.rejected.groupBy(F.col("verdict").alias("part")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*keys).alias("n_keys"))
    return kept.unionByName(loads).unionByName(why)


def q_upsert_table(spark, sf_dir):
    """Two rounds of upserts into a customer table that is partitioned by the hash of its key: new counts, then new names."""
    c = roles.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.lit(0).cast("long").alias("n"))
    path, keys, slots = scratch_path(spark, "customers"), ["custkey"], 16
    keyed.create_keyed(c.where(F.col("custkey") % 2 == 0), path, keys, slots)
    counts = (roles.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(F.count(F.lit(1)).alias("n"))
              .select("custkey", F.lit("no name").alias("name"), "n"))
    keyed.upsert_table(spark, counts, path, c.schema, keys, slots, update_cols=["n"])
    keyed.upsert_table(spark, c.where(F.col("custkey") <= 40), path, c.schema, keys, slots, update_cols=["name"])
    return keyed.read_keyed(spark, path, c.schema)


def q_check_key_loads(spark, sf_dir):
    """Event keys checked load by load: three loads touch the same days; the counts kept give every violation."""
    ev = roles.events(spark, sf_dir).withColumn("event_date", F.to_date("event_time"))
    keys, path = ["user_id", "device_id", "event_date"], scratch_path(spark, "key_counts")
    for part in range(3):
        registers.checked_load(spark, ev.where(F.hour("event_time") % 3 == part), path, keys, F.col("event_date"))
    return registers.standing_violations(spark, path, keys)


def q_activity_counts(spark, sf_dir):
    """Daily, weekly and monthly active users, from registers per user and browser advanced a week a job."""
    ev = roles.events(spark, sf_dir)
    first, last = ev.agg(F.min(F.to_date("event_time")), F.max(F.to_date("event_time"))).first()
    act = user_activity(ev, roles.devices(spark, sf_dir), distinct=False)
    return registers.register_load_days(spark, act, USER_KEYS, ["user_id"], scratch_path(spark, "activity"), first, last)


def _star_files(spark, sf_dir):
    """The five star tables as header CSV files, with the columns of their declared schemas."""
    parts = {"maps": roles.maps, "medals": roles.medals, "matches": roles.matches,
             "match_details": roles.match_details, "medal_matches_players": roles.medal_matches_players}
    files = {}
    for name, role in parts.items():
        df = role(spark, sf_dir)
        wide = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in TABLES[name].fields]
        files[name] = scratch_path(spark, f"{name}_csv")
        df.select(*wide).write.option("header", "true").csv(files[name])
    return files


def q_csv_infer(spark, sf_dir):
    """What the values of the five star files are, against their declared schemas."""
    out = None
    for name, path in _star_files(spark, sf_dir).items():
        found = compare_schema(spark, path, TABLES[name]).select(
            F.lit(name).alias("table_name"), "column_name", "inferred", "declared", "n_rows", "n_values", "verdict")
        out = found if out is None else out.unionByName(found)
    return out


# ---- the star over several tasks and slices --------------------------------------
def q_match_fact_salted(spark, sf_dir):
    """The star fact over tables bucketed by match and salt; matches with six detail rows or more count as hot."""
    tables = load_salted_star(spark, roles.matches(spark, sf_dir), roles.match_details(spark, sf_dir),
                              roles.medal_matches_players(spark, sf_dir), scratch_path(spark, "salted_star"), hot_rows=6)
    out = scratch_path(spark, "match_fact")
    with match_bucket_join(spark):
        reports.match_fact_salted(*tables).write.parquet(out)
    return spark.read.parquet(out)


def q_tops_of_slices(spark, sf_dir):
    """The top-1 reports kept per year: every year loaded, one of them first with details missing, then again."""
    m, d, maps = roles.matches(spark, sf_dir), roles.match_details(spark, sf_dir), roles.maps(spark, sf_dir)
    path, year = scratch_path(spark, "report_slices"), F.year("completion_date")
    years = sorted(str(r[0]) for r in m.select(year).distinct().collect() if r[0] is not None)
    load_report_slices(spark, m, d, maps, path, year, years[:-1])
    load_report_slices(spark, m.where(F.col("mapid") != "3"), d.where(F.col("player_total_kills") > 40), maps, path, year, years[-2:])
    done = load_report_slices(spark, m, d, maps, path, year, years[-2:])
    return done.select("report", "name", F.round("value", 6).alias("value"))


# ---- streamed daily loads ----------------------------------------------------
def _land_events(spark, sf_dir):
    """The events as files in a landing folder, as an upstream writer leaves them."""
    src = scratch_path(spark, "events_landing")
    ev = roles.events(spark, sf_dir)
    ev.write.parquet(src)
    return src, ev.schema


def q_host_datelist_streamed(spark, sf_dir):

    src, schema = _land_events(spark, sf_dir)
    target = scratch_path(spark, "hosts_streamed")
    model = host_datelist_load(target, dt.date.fromisoformat(roles.EVENTS_FIRST_DAY))
    run_stream(spark, src, schema, model, scratch_path(spark, "staging"), scratch_path(spark, "stream_ckpt"),
               finalize=True)
    return spark.read.parquet(target).select(
        "host", "date", _dates_str(F.col("host_activity_datelist")).alias("host_activity_datelist"),
        F.size("host_activity_datelist").cast("long").alias("n_active"))


def q_reduced_streamed(spark, sf_dir):
    src, schema = _land_events(spark, sf_dir)
    target = scratch_path(spark, "reduced_streamed")
    model = reduced_load(target, count_type="long")
    run_stream(spark, src, schema, model, scratch_path(spark, "staging"), scratch_path(spark, "stream_ckpt"),
               finalize=True)
    return read_streamed_reduced(spark, target, "long").select(
        "host", "month", _counts_str(F.col("hit_array")).alias("hit_array"),
        F.size("hit_array").cast("long").alias("n_days"))


def q_csv_scan(spark, sf_dir):
    """The maps dimension landed as header CSV, read back against its declared schema."""
    path = scratch_path(spark, "maps_csv")
    (roles.maps(spark, sf_dir).withColumn("description", F.lit(None).cast("string"))
     .write.option("header", "true").csv(path))
    return read_csv(spark, path, "maps")


QUERIES: dict[str, Query] = {
    "scd2_backfill": q_scd2_backfill,
    "actors_cumulative": q_actors_cumulative,
    "actors_cumulative_spec_bands": q_actors_cumulative_spec_bands,
    "actors_cumulative_carry": q_actors_cumulative_carry,
    "dedup_details": q_dedup_details,
    "dedup_events": q_dedup_events,
    "dedup_devices": q_dedup_devices,
    "check_domain": q_check_domain,
    "check_key": q_check_key,
    "user_datelist": q_user_datelist,
    "host_datelist": q_host_datelist,
    "datelist_int": q_datelist_int,
    "reduced_hits": q_reduced_hits,
    "reduced_visitors": q_reduced_visitors,
    "reduced_fix_last": q_reduced_fix_last,
    "reduced_daily": q_reduced_daily,
    "match_fact": q_match_fact,
    "player_match": q_player_match,
    "top_avg_kills": q_top_avg_kills,
    "top_playlist": q_top_playlist,
    "top_map": q_top_map,
    "top_medal_map": q_top_medal_map,
    "actors_incremental": q_actors_incremental,
    "actors_incremental_carry": q_actors_incremental_carry,
    "scd2_incremental": q_scd2_incremental,
    "host_datelist_incremental": q_host_datelist_incremental,
    "user_datelist_incremental": q_user_datelist_incremental,
    "reduced_incremental": q_reduced_incremental,
    "load_sliced": q_load_sliced,
    "csv_scan": q_csv_scan,
    "layout_report": q_layout_report,
    "dedup_rewrite": q_dedup_rewrite,
    "match_fact_bucketed": q_match_fact_bucketed,
    "host_datelist_streamed": q_host_datelist_streamed,
    "reduced_streamed": q_reduced_streamed,
    "upsert_by_key": q_upsert_by_key,
    "check_domain_violations": q_check_domain_violations,
    "dedup_rewrite_events": q_dedup_rewrite_events,
    "dedup_rewrite_devices": q_dedup_rewrite_devices,
    "csv_load_star": q_csv_load_star,
    "actors_ranged": q_actors_ranged,
    "actors_ranged_carry": q_actors_ranged_carry,
    "scd2_ranged": q_scd2_ranged,
    "scd2_corrected": q_scd2_corrected,
    "insert_keyed": q_insert_keyed,
    "upsert_table": q_upsert_table,
    "check_key_loads": q_check_key_loads,
    "activity_counts": q_activity_counts,
    "csv_infer": q_csv_infer,
    "match_fact_salted": q_match_fact_salted,
    "tops_of_slices": q_tops_of_slices,
}
