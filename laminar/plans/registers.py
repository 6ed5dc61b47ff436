"""Daily upkeep: activity registers with their counts, and key counts that check each load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from laminar.operators.checks import KEY_PERIOD, counted_violations, key_counts, merge_key_counts
from laminar.operators.register import BITS, REGISTER, WINDOWS, activity_counts, advance, roll_up
from laminar.plans.incremental import land, landed
from laminar.plans.tables import (exists, has_partition, latest, overwrite_partitions, partition_path, read_version, versions,
                                  write_version)
from laminar.session import scratch_path


def register_load_days(spark: SparkSession, activity: DataFrame, keys: Sequence[str], count_keys: Sequence[str], path: str,
                       first_day: dt.date, last_day: dt.date, step: int = 7, windows: dict[str, int] = WINDOWS) -> DataFrame:
    """Advance the registers of ``keys`` from ``first_day`` to ``last_day`` and keep the counts of each day.

    A job advances by up to ``step`` days: it reads its days' activity and the registers of the day before, writes the
    registers as a version named by its last day, and replaces the counts of its days, so a step can be run again.
    Returns the counts of active ``count_keys``, one row per day.
    """
    if step - 1 + max(windows.values()) > BITS:
        raise ValueError("a step is too long for the longest window")
    act = activity.select(*keys, "day").distinct()
    act_path, registers, counts = f"{path}/activity", f"{path}/registers", f"{path}/counts"
    land(act, act_path, "day", files_per_partition=1)
    schema = StructType([*act.drop("day").schema.fields, StructField(REGISTER, LongType())])
    day = first_day
    while day <= last_day:
        end = min(last_day, day + dt.timedelta(days=step - 1))
        there = [d for d in (day + dt.timedelta(days=i) for i in range((end - day).days + 1))
                 if has_partition(spark, act_path, "day", d)]
        facts = landed(spark, act_path, act.schema, "day", there) if there else spark.createDataFrame([], act.schema)
        before = read_version(spark, registers, schema, "v", latest(versions(spark, registers, "v"), day.isoformat()))
        write_version(advance(before, facts, keys, day, end), registers, "v", end.isoformat())
        now = roll_up(read_version(spark, registers, schema, "v", end.isoformat()), count_keys)
        overwrite_partitions(activity_counts(now, end, (end - day).days + 1, windows).coalesce(1), counts, "day")
        day = end + dt.timedelta(days=1)
    if not exists(spark, counts):
        return spark.createDataFrame([], "day date, " + ", ".join(f"{w} long" for w in windows))
    return spark.read.parquet(counts).select("day", *windows)


def checked_load(spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str], period: Column,
                 replace: bool = False) -> DataFrame:
    """Add one load's key counts to the table at ``path`` and return the keys that now violate the primary key.

    Only the counts of the periods that the load touches are read, merged and replaced; the result covers just them: other
    periods are as they were after their own last load.  With ``replace`` the load stands for all rows of its
    periods, as when a partition is written anew.
    """
    staged = scratch_path(spark, "key-counts")
    key_counts(rows, keys, period).write.parquet(staged)
    new = spark.read.parquet(staged)
    if not replace and exists(spark, path):
        touched = [r[0] for r in new.select(KEY_PERIOD).distinct().collect()]  # one value per period of the load
        there = F.col(KEY_PERIOD).isin([t for t in touched if t is not None])
        if None in touched:
            there = there | F.col(KEY_PERIOD).isNull()
        old = spark.read.schema(new.schema).parquet(path).where(there)
        merged = scratch_path(spark, "merged-counts")
        merge_key_counts(old, new, keys).write.parquet(merged)
        new = spark.read.parquet(merged)
    overwrite_partitions(new, path, KEY_PERIOD, files_per_partition=8)
    return counted_violations(new, keys)


def standing_violations(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """All keys that violate the primary key, from the counts alone."""
    return counted_violations(spark.read.parquet(path), keys)
