"""Stand-in role views over the driver's test tables.

The reference ships no data.  Each function here only renames and casts columns
of the given tables into the schema a model expects (see FIXTURES.md §2); it does
none of the model's work.  Everything stays lazy and column-pruned, so the parquet
scans read only the columns a role needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def actor_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer: actor = customer, film = order, year = order year."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                              "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .select(F.col("o_custkey").cast("string").alias("actorid"),
                    F.col("c_name").alias("actor"),
                    F.col("o_orderpriority").alias("film"),
                    F.floor("o_totalprice").cast("int").alias("votes"),
                    (F.col("o_totalprice") / 50000).cast("float").alias("rating"),
                    F.col("o_orderkey").cast("string").alias("filmid"),
                    F.year("o_orderdate").cast("int").alias("year")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: device and host come from the ``k`` property; event_time stays typed."""
    e = table(spark, sf_dir, "events").select("event_type", "user_id", "props", "ts")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(F.concat(F.lit("/"), F.col("event_type")).alias("url"),
                    F.lit(None).cast("string").alias("referrer"),
                    F.col("user_id"),
                    k.alias("device_id"),
                    F.when(k.isNotNull(), F.format_string("host-%02d", k)).alias("host"),
                    F.col("ts").alias("event_time"))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part: device = part, browser type = part type."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("device_id"),
                                               F.col("p_type").alias("browser_type"))


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a wide fact with duplicate (l_orderkey, l_linenumber) keys."""
    return table(spark, sf_dir, "lineitem")


def device_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as a device catalog with duplicate (p_brand, p_type) keys."""
    return table(spark, sf_dir, "part")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer: match = order, map = customer nation, playlist = priority."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority",
                                              "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .select(F.col("o_orderkey").cast("string").alias("match_id"),
                    F.col("c_nationkey").cast("string").alias("mapid"),
                    F.col("o_orderpriority").alias("playlist_id"),
                    F.col("o_orderdate").alias("completion_date")))


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: match = order, player = supplier, kills = quantity."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("match_id"),
        F.col("l_suppkey").cast("string").alias("player_gamertag"),
        F.col("l_quantity").cast("int").alias("player_total_kills"))


def medal_matches_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: match = order, player = supplier, medal = part, count = line number."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("match_id"),
        F.col("l_suppkey").cast("string").alias("player_gamertag"),
        F.col("l_partkey").alias("medal_id"),
        F.col("l_linenumber").alias("count"))


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part: medal = part, medal name = part type."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("medal_id"),
                                               F.col("p_type").alias("name"))


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation: map = nation."""
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("mapid"),
                                                 F.col("n_name").alias("name"))


# --- fixed parameters of the stand-ins (FIXTURES.md §2) ----------------------
ACTOR_SEED_YEAR = 1994          # reference seed 1969; first run loads the first data year
EVENTS_FIRST_DAY = "2024-01-01"  # first day loaded by the date-list increments
SNAPSHOT_DATE = "2024-01-14"     # datelist -> bitmap snapshot
MONTH_START = "2024-01-01"       # reduced-fact month
MEDAL_NAME = "PROMO"             # stands in for "Killing Spree"
LAYOUT_COLUMNS = ("mapid", "playlist_id", "match_id", "medal_id")
# -----------------------------------------------------------------------------
