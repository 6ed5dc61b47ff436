"""Declared table schemas (explicit StructTypes; never inferred).

Inputs are the raw fact/dimension tables the models read; outputs are the
modelled tables they write.  Column names and types follow the reference DDL.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, FloatType,
                               IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in
                       ((f[0], f[1], f[2] if len(f) > 2 else True) for f in fields)])


FILM = _s(("film", StringType()), ("votes", IntegerType()), ("rating", FloatType()),
          ("filmid", StringType()))

ACTOR_FILMS = _s(("actorid", StringType()), ("actor", StringType()), ("film", StringType()),
                 ("votes", IntegerType()), ("rating", FloatType()), ("filmid", StringType()),
                 ("year", IntegerType()))

ACTORS = _s(("actorid", StringType(), False), ("actor", StringType()),
            ("films", ArrayType(FILM)), ("quality_class", StringType()),
            ("current_year", IntegerType(), False), ("is_active", BooleanType()))

ACTORS_HISTORY_SCD = _s(("actorid", StringType(), False), ("actor", StringType()),
                        ("quality_class", StringType()), ("is_active", BooleanType()),
                        ("start_date", IntegerType(), False), ("end_date", IntegerType()))

# fixed values: column names of the reference's tables, here and below
_GAME_STATS = [
    "fgm", "fga", "fg_pct", "fg3m", "fg3a", "fg3_pct", "ftm", "fta", "ft_pct", "oreb", "dreb",
    "reb", "ast", "stl", "blk", "TO", "pf", "pts", "plus_minus",
]
GAME_DETAILS = _s(("game_id", IntegerType()), ("team_id", IntegerType()),
                  ("team_abbreviation", StringType()), ("team_city", StringType()),
                  ("player_id", IntegerType()), ("player_name", StringType()),
                  ("nickname", StringType()), ("start_position", StringType()),
                  ("comment", StringType()), ("min", StringType()),
                  *[(c, FloatType()) for c in _GAME_STATS])

DEVICES = _s(("device_id", LongType()), ("browser_type", StringType()),
             ("browser_version_major", IntegerType()), ("browser_version_minor", IntegerType()),
             ("browser_version_patch", IntegerType()), ("device_type", StringType()),
             ("device_version_major", StringType()), ("device_version_minor", IntegerType()),
             ("device_version_patch", IntegerType()), ("os_type", StringType()),
             ("os_version_major", StringType()), ("os_version_minor", IntegerType()),
             ("os_version_patch", IntegerType()))

EVENTS = _s(("url", StringType()), ("referrer", StringType()), ("user_id", LongType()),
            ("device_id", LongType()), ("host", StringType()), ("event_time", StringType()))

USER_DEVICES_CUMULATED = _s(("user_id", LongType(), False), ("browser_type", StringType(), False),
                            ("device_actives", ArrayType(DateType())), ("date", DateType(), False))

DATELIST_INT = _s(("user_id", LongType()), ("browser_type", StringType()),
                  ("device_activity_datelist_int", LongType()))

HOSTS_CUMULATED = _s(("host", StringType(), False), ("host_activity_datelist", ArrayType(DateType())),
                     ("date", DateType(), False))

HOST_ACTIVITY_REDUCED = _s(("host", StringType(), False), ("month", DateType(), False),
                           ("hit_array", ArrayType(FloatType())),
                           ("unique_visitor_array", ArrayType(FloatType())))

MEDALS = _s(("medal_id", LongType()), ("sprite_uri", StringType()), ("sprite_left", IntegerType()),
            ("sprite_top", IntegerType()), ("sprite_sheet_width", IntegerType()),
            ("sprite_sheet_height", IntegerType()), ("sprite_width", IntegerType()),
            ("sprite_height", IntegerType()), ("classification", StringType()),
            ("description", StringType()), ("name", StringType()), ("difficulty", IntegerType()))

MAPS = _s(("mapid", StringType()), ("name", StringType()), ("description", StringType()))

_DETAIL_INTS = [
    "previous_spartan_rank", "spartan_rank", "previous_total_xp", "total_xp", "previous_csr_tier",
    "previous_csr_designation", "previous_csr", "previous_csr_percent_to_next_tier",
    "previous_csr_rank", "current_csr_tier", "current_csr_designation", "current_csr",
    "current_csr_percent_to_next_tier", "current_csr_rank", "player_rank_on_team",
]
MATCH_DETAILS = _s(("match_id", StringType()), ("player_gamertag", StringType()),
                   *[(c, IntegerType()) for c in _DETAIL_INTS],
                   ("player_finished", BooleanType()), ("player_average_life", StringType()),
                   ("player_total_kills", IntegerType()), ("player_total_headshots", IntegerType()),
                   ("player_total_weapon_damage", IntegerType()),
                   ("player_total_shots_landed", IntegerType()),
                   ("player_total_melee_kills", IntegerType()),
                   ("player_total_melee_damage", DoubleType()),
                   ("player_total_assassinations", IntegerType()),
                   ("player_total_ground_pound_kills", IntegerType()),
                   ("player_total_shoulder_bash_kills", IntegerType()),
                   ("player_total_grenade_damage", DoubleType()),
                   ("player_total_power_weapon_damage", DoubleType()),
                   ("player_total_power_weapon_grabs", IntegerType()),
                   ("player_total_deaths", IntegerType()), ("player_total_assists", IntegerType()),
                   ("player_total_grenade_kills", IntegerType()), ("did_win", IntegerType()),
                   ("team_id", IntegerType()))

MATCHES = _s(("match_id", StringType()), ("mapid", StringType()), ("playlist_id", StringType()),
             ("completion_date", TimestampType()))

MEDAL_MATCHES_PLAYERS = _s(("match_id", StringType()), ("player_gamertag", StringType()),
                           ("medal_id", LongType()), ("count", IntegerType()))

TABLES = {
    "actor_films": ACTOR_FILMS, "actors": ACTORS, "actors_history_scd": ACTORS_HISTORY_SCD,
    "game_details": GAME_DETAILS, "devices": DEVICES, "events": EVENTS,
    "user_devices_cumulated": USER_DEVICES_CUMULATED, "datelist_int": DATELIST_INT,
    "hosts_cumulated": HOSTS_CUMULATED, "host_activity_reduced": HOST_ACTIVITY_REDUCED,
    "medals": MEDALS, "maps": MAPS, "match_details": MATCH_DETAILS, "matches": MATCHES,
    "medal_matches_players": MEDAL_MATCHES_PLAYERS,
}
