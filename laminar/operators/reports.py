"""Star-schema fact and top-1 reports (matches, players, medals, maps).

The fact is built with left joins on the match key; dimensions (maps, a filtered
medal set) are broadcast only after a size check.  Top-1 reports are partial +
final hash aggregates followed by ``orderBy(...).limit(1)``, which Spark plans as a
per-partition top-1 and a single merge (TakeOrderedAndProject); ties are broken by
the group key so the answer is reproducible.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.operators.joins import HOT_ROWS, bounded_broadcast, hot_keys, left_join

# --- fixed values: output column names, as the reference's reports have them ---
MAP_NAME = "mapName"
MEDAL_NAME = "medalName"
AVG_KILLS = "avg_kill_per_game"
PLAYED = "played_count"
MAP_PLAYED = "map_played_count"
MEDALS = "medal_count"
# --------------------------------------------------------------------------------

def match_fact(matches: DataFrame, details: DataFrame, medals_players: DataFrame,
               skew_safe: bool = True) -> DataFrame:
    """matches LEFT JOIN details ON match LEFT JOIN medal rows ON (match, player).

    A player's row repeats once per medal row; matches without details keep one row
    with NULL player.  Medal ``count`` is not carried.  The fact tables are on the
    right of both left joins; ``skew_safe`` (see ``joins.left_join``) keeps a hot
    match or player key from landing in one task.
    """
    m = matches.select("match_id", "mapid", "playlist_id")
    d = details.select("match_id", "player_gamertag", "player_total_kills")
    md = left_join(m, d, ["match_id"], skew_safe)
    mmp = medals_players.select("match_id", "player_gamertag", "medal_id")
    return (left_join(md, mmp, ["match_id", "player_gamertag"], skew_safe)
            .select("match_id", "mapid", "playlist_id", "medal_id", "player_gamertag",
                    "player_total_kills"))


def player_match(fact: DataFrame, maps: DataFrame) -> DataFrame:
    """One row per (match, playlist, map, player, kills) with the map name."""
    pm = fact.select("match_id", "playlist_id", "mapid", "player_gamertag", "player_total_kills").distinct()
    mp = bounded_broadcast(maps.select("mapid", F.col("name").alias(MAP_NAME)))
    return (pm.join(mp, "mapid", "left")
            .select("match_id", "playlist_id", "mapid", "player_gamertag", "player_total_kills", MAP_NAME))


def player_match_from_tables(matches: DataFrame, details: DataFrame, maps: DataFrame,
                             skew_safe: bool = True) -> DataFrame:
    """``player_match`` without building the medal fan-out first.

    The DISTINCT keeps only matches/details columns, and a left join never drops a
    left row, so joining the medal rows and folding them back changes nothing: the
    result equals ``player_match(match_fact(...), maps)`` row for row.
    """
    m = matches.select("match_id", "mapid", "playlist_id")
    d = details.select("match_id", "player_gamertag", "player_total_kills")
    return player_match(left_join(m, d, ["match_id"], skew_safe).withColumn("medal_id", F.lit(None)), maps)


def top1(df: DataFrame, group: str, value: Column, alias: str) -> DataFrame:
    """The group with the largest aggregate (NULLs last; ties -> smallest group key)."""
    return (df.groupBy(group).agg(value.alias(alias))
            .orderBy(F.col(alias).desc_nulls_last(), F.col(group).asc_nulls_last())
            .limit(1))


def top_avg_kills(pm: DataFrame) -> DataFrame:
    return top1(pm, "player_gamertag", F.avg("player_total_kills"), AVG_KILLS)


def top_playlist(pm: DataFrame) -> DataFrame:
    return top1(pm, "playlist_id", F.count("playlist_id"), PLAYED)


def top_map(pm: DataFrame) -> DataFrame:
    return top1(pm, MAP_NAME, F.count("match_id"), MAP_PLAYED)


def medal_by_map(fact: DataFrame, medals: DataFrame, maps: DataFrame, medal_name: str) -> DataFrame:
    """(match_id, mapName, medalName) for every fact row holding the named medal.

    The medal dimension is filtered before the size check, so only the matching
    medals are broadcast; both joins are inner.
    """
    md = bounded_broadcast(medals.where(F.col("name") == medal_name)
                           .select("medal_id", F.col("name").alias(MEDAL_NAME)))
    mp = bounded_broadcast(maps.select("mapid", F.col("name").alias(MAP_NAME)))
    return fact.join(md, "medal_id").join(mp, "mapid").select("match_id", MAP_NAME, MEDAL_NAME)


def top_medal_map(fact: DataFrame, medals: DataFrame, maps: DataFrame, medal_name: str) -> DataFrame:
    return top1(medal_by_map(fact, medals, maps, medal_name), MAP_NAME, F.count(MEDAL_NAME), MEDALS)


def medal_by_map_from_tables(matches: DataFrame, details: DataFrame, medals_players: DataFrame,
                             medals: DataFrame, maps: DataFrame, medal_name: str) -> DataFrame:
    """``medal_by_map`` over the fact's source tables, most selective join first.

    The inner joins with the named medal and the map turn the fact's left joins into
    inner joins, so the result equals filtering the finished fact -- but here the
    medal rows are cut to the named medal map-side (broadcast) before anything is
    shuffled, and the detail and match tables are joined only to those rows.
    """
    md = bounded_broadcast(medals.where(F.col("name") == medal_name)
                           .select("medal_id", F.col("name").alias(MEDAL_NAME)))
    mp = bounded_broadcast(maps.select("mapid", F.col("name").alias(MAP_NAME)))
    hits = medals_players.select("match_id", "player_gamertag", "medal_id").join(md, "medal_id")
    with_player = hits.join(details.select("match_id", "player_gamertag"), ["match_id", "player_gamertag"])
    return (with_player.join(matches.select("match_id", "mapid"), "match_id")
            .join(mp, "mapid").select("match_id", MAP_NAME, MEDAL_NAME))


def top_medal_map_from_tables(matches, details, medals_players, medals, maps, medal_name) -> DataFrame:
    rows = medal_by_map_from_tables(matches, details, medals_players, medals, maps, medal_name)
    return top1(rows, MAP_NAME, F.count(MEDAL_NAME), MEDALS)


@contextmanager
def shared_player_match(matches: DataFrame, details: DataFrame, maps: DataFrame):
    """Compute the player-match table once for several reports run together.

    Persisted with MEMORY_AND_DISK (a lost block is recomputed from lineage) and
    released on exit.  Without it each report action recomputes the joins.
    """
    pm = player_match_from_tables(matches, details, maps).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield pm
    finally:
        pm.unpersist()


# ---- a star that is salted at load time ------------------------------------------
SALT, MATCH_IS_HOT = "match_salt", "match_is_hot"


def salt_star(matches: DataFrame, details: DataFrame, medals_players: DataFrame, salts: int = 16,
              hot_rows: int = HOT_ROWS, hot: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The fact's three sources with a salt, for tables bucketed by (match, salt).

    A match with ``hot_rows`` detail rows or more has its players dealt over ``salts`` by a hash of the player, the
    same way in details and medals, and its match row copied to every salt; all other rows have salt 0.  So
    rows that join lie in one bucket, and a hot match lies in several.  ``hot`` are these matches (``hot_keys``), if
    they are known already.
    """
    hot = hot_keys(details, ["match_id"], hot_rows) if hot is None else hot

    def salted(df: DataFrame) -> DataFrame:
        salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("player_gamertag"), F.lit(salts)).cast("int")).otherwise(F.lit(0))
        return df.join(F.broadcast(hot), "match_id", "left").withColumn(SALT, salt).drop("_hot")

    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    m = (matches.join(F.broadcast(hot), "match_id", "left").withColumn(SALT, F.explode(copies))
         .withColumn(MATCH_IS_HOT, F.coalesce("_hot", F.lit(False))).drop("_hot"))
    return m, salted(details), salted(medals_players)


def match_fact_salted(matches: DataFrame, details: DataFrame, medals_players: DataFrame) -> DataFrame:
    """``match_fact`` over salted sources (``salt_star``): both joins are on match, salt and so on.

    A hot match has details, so a copy of its row whose salt met none is no unmatched match and goes.
    """
    m = matches.select("match_id", SALT, "mapid", "playlist_id", MATCH_IS_HOT)
    d = details.select("match_id", SALT, "player_gamertag", "player_total_kills", F.lit(True).alias("_met"))
    md = m.join(d, ["match_id", SALT], "left").where(~F.col(MATCH_IS_HOT) | F.col("_met"))
    mmp = medals_players.select("match_id", SALT, "player_gamertag", "medal_id")
    return (md.join(mmp, ["match_id", SALT, "player_gamertag"], "left")
            .select("match_id", "mapid", "playlist_id", "medal_id", "player_gamertag", "player_total_kills"))


# ---- reports kept per slice ------------------------------------------------------
SLICE = "slice"
KILLS, PLAYLIST, MAP, LOADED = "kills", "playlist", "map", "loaded"


def slice_partials(pm: DataFrame, slices: DataFrame) -> DataFrame:
    """Mergeable aggregates ``(report, name, total, n, slice)`` of the player-match rows ``pm`` with their ``slice``.

    A match lies in one slice, so sums and counts of slices add up to those of all matches.  ``slices(slice)`` are the
    slices this load stands for; each gets a row of its own, so that a slice without matches replaces what was there.
    """
    def partial(report: str, name: str, total: Column, n: Column) -> DataFrame:
        return (pm.groupBy(SLICE, F.col(name).cast("string").alias("name"))
                .agg(total.cast("long").alias("total"), n.alias("n")).select(F.lit(report).alias("report"), "name", "total", "n", SLICE))

    kills = F.col("player_total_kills")
    nothing = F.lit(0).cast("long")
    return (partial(KILLS, "player_gamertag", F.sum(kills), F.count(kills))
            .unionByName(partial(PLAYLIST, "playlist_id", F.lit(0), F.count("playlist_id")))
            .unionByName(partial(MAP, MAP_NAME, F.lit(0), F.count("match_id")))
            .unionByName(slices.select(F.lit(LOADED).alias("report"), F.lit(None).cast("string").alias("name"),
                                       nothing.alias("total"), nothing.alias("n"), SLICE)))


def tops_of_slices(partials: DataFrame) -> DataFrame:
    """The three top-1 reports from the partial aggregates of all slices: ``(report, name, value)``."""
    whole = partials.groupBy("report", "name").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = None
    for report in (KILLS, PLAYLIST, MAP):
        value = F.try_divide(F.col("total"), F.col("n")) if report == KILLS else F.col("n").cast("double")
        top = (whole.where(F.col("report") == report).select("report", "name", value.alias("value"))
               .orderBy(F.col("value").desc_nulls_last(), F.col("name").asc_nulls_last()).limit(1))
        out = top if out is None else out.unionByName(top)
    return out
