"""Loads of several periods in one job.

A late or skipped yearly run is caught up by one range step instead of a job per year.  The steps
themselves are ``cumulate_range`` and ``scd2_range``; here they read and write tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.functions.bands import AS_WRITTEN
from laminar.operators.cumulate import cumulate_range
from laminar.operators.scd2 import OPEN, scd2_range
from laminar.plans.incremental import land, landed
from laminar.plans.tables import (conform, hadoop_path, has_partition, latest, overwrite_partitions, partition_path, read_partition,
                                  read_table, versions)
from laminar.sources.schemas import ACTORS, ACTORS_HISTORY_SCD


def load_year_ranges(spark: SparkSession, facts: DataFrame, path: str, seed: int, ranges: Sequence[tuple[int, int]],
                     history: str = "two_period", bands=AS_WRITTEN) -> DataFrame:
    """Load the snapshot table at ``path`` range by range, each in one job; ``seed`` is the year before the first.

    Ranges must follow each other.  A range starts with the year after the last one loaded and ends before the first year
    without facts, after which nothing more is loaded, as in the serial run.
    """
    facts_path = f"{path.rstrip('/')}-facts"
    land(facts, facts_path, "year")
    loaded = seed
    for first, last in ranges:
        if first != loaded + 1:
            continue  # a year before this range had no facts
        there = [y for y in range(first, last + 1) if has_partition(spark, facts_path, "year", y)]
        end = max((y for y in there if set(range(first, y + 1)) <= set(there)), default=None)
        if end is None:
            continue
        state = (read_partition(spark, path, ACTORS, "current_year", loaded) if history == "carry"
                 else spark.createDataFrame([], ACTORS))
        span = landed(spark, facts_path, facts.schema, "year", range(first - 1, end + 1))
        rows = cumulate_range(state, span, first, end, history=history, bands=bands)
        overwrite_partitions(conform(rows, ACTORS), path, "current_year", files_per_partition=4)
        loaded = end
    return read_table(spark, path, ACTORS)


def _name(year: int) -> str:
    return f"{int(year):09d}"


def scd2_load_range(spark: SparkSession, state: DataFrame, first: int, last: int, path: str, key: str = "actorid") -> None:
    """Apply the periods ``first..last`` of the cumulative ``state`` to the SCD table at ``path``, in one job and one write.

    A range is a version ``v=<last>``: the records open at its end and those it closed, as partitions
    ``is_open``.  It continues the newest version before ``first``; versions from ``first`` on are built on what this load
    replaces and are dropped once it is written, so a range can be loaded again and the table then ends with it.
    """
    before = latest(versions(spark, path, "v"), _name(first))
    rows = scd2_range(_part(spark, path, before, True), state, first, last, key=key)
    (rows.write.mode("overwrite").partitionBy(OPEN).parquet(partition_path(path, "v", _name(last))))
    for v in versions(spark, path, "v"):
        if v >= _name(first) and v != _name(last):
            fs, p = hadoop_path(spark, partition_path(path, "v", v))
            fs.delete(p, True)


def _part(spark: SparkSession, path: str, version: str | None, is_open: bool) -> DataFrame:
    root = None if version is None else partition_path(path, "v", version)
    if root is None or not has_partition(spark, root, OPEN, str(is_open).lower()):
        return spark.createDataFrame([], ACTORS_HISTORY_SCD)
    return conform(spark.read.schema(ACTORS_HISTORY_SCD).parquet(partition_path(root, OPEN, str(is_open).lower())), ACTORS_HISTORY_SCD)


def read_scd2_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The SCD table: the newest version's open records and what every version closed."""
    names = versions(spark, path, "v")
    out = _part(spark, path, latest(names), True)
    for v in names:
        out = out.unionByName(_part(spark, path, v, False))
    return out


def scd2_load_ranges(spark: SparkSession, state: DataFrame, ranges: Sequence[tuple[int, int]], path: str,
                     key: str = "actorid") -> DataFrame:
    """Apply the ranges in order."""
    for first, last in ranges:
        scd2_load_range(spark, state, first, last, path, key)
    return read_scd2_ranges(spark, path)
