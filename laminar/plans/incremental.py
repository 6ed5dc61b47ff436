"""Serial loads: run a model's daily/yearly step period after period.

Facts are landed once, partitioned by period, so a step reads only the folders of
its own periods; it reads the previous period's state by its directory and writes the
next one, so lineage never grows beyond a step and a lost executor only re-runs
tasks of the current step.  The loop carries only the last loaded period on the
driver.  A step that replaces its own input writes a version (``laminar.plans.tables``),
hence re-running any period gives the same table.  These loops are what a scheduler
runs once per period; the closed forms in ``laminar.operators`` produce the same
tables in one job for a backfill.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StructField, StructType

from laminar.functions.bands import AS_WRITTEN
from laminar.operators.cumulate import cumulate_year_step
from laminar.operators.datelist import datelist_days
from laminar.operators.reduced import reduce_days
from laminar.operators.scd2 import scd2_increment
from laminar.operators.upsert import upsert
from laminar.plans.tables import (conform, exists, has_partition, latest, overwrite_partitions, partition_path,
                                  read_partition, read_table, read_version, versions, write_version)
from laminar.session import scratch_path
from laminar.sources.schemas import ACTORS, ACTORS_HISTORY_SCD, HOST_ACTIVITY_REDUCED


def land(df: DataFrame, path: str, col: str, files_per_partition: int = 4) -> None:
    """Write facts partitioned by period, once, for steps that read single periods."""
    overwrite_partitions(df, path, col, files_per_partition)


def landed(spark: SparkSession, path: str, schema, col: str, periods: Sequence) -> DataFrame:
    """The landed facts of some periods, read by their folders only."""
    parts = [read_partition(spark, path, schema, col, p) for p in periods]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_years(spark: SparkSession, facts: DataFrame, path: str, seed: int, runs: int,
               history: str = "two_period", bands=AS_WRITTEN) -> DataFrame:
    """Run the yearly cumulative step ``runs`` times into the table at ``path``.

    The facts are landed by year beside the table; a step reads its two years and, for
    ``carry``, the latest snapshot.  A run past the last loadable year writes nothing
    (the stop guard) and the year does not advance.
    """
    facts_path = f"{path.rstrip('/')}-facts"
    land(facts, facts_path, "year")
    last = None
    for _ in range(runs):
        prev = last if last is not None else seed
        if not has_partition(spark, facts_path, "year", prev + 1):
            continue  # the stop guard: no facts, nothing to write
        state = (read_partition(spark, path, ACTORS, "current_year", last) if history == "carry" and last is not None
                 else spark.createDataFrame([], ACTORS))
        two = landed(spark, facts_path, facts.schema, "year", (prev, prev + 1))
        step = cumulate_year_step(state, two, seed=seed, history=history, bands=bands, last=prev)
        overwrite_partitions(conform(step, ACTORS), path, "current_year")
        last = prev + 1
    return read_table(spark, path, ACTORS)


def scd2_load_year(spark: SparkSession, state: DataFrame, year: int, path: str, key: str = "actorid",
                   null_safe: bool = False) -> None:
    """Apply one year's increment to the SCD table at ``path``.

    The table is the closed history, ``closed/end_date=<end>``, and versions of the open
    slice (the records with the latest end), ``open/v=<year>``.  A step reads the
    newest open slice before ``year``; what it continues or opens is the next slice, the
    rest is closed history from then on.  A year without rows, or that leaves nothing open,
    writes nothing: the latest end stays what it was.
    """
    now = state.where(F.col("current_year") == year)
    prev = latest(versions(spark, f"{path}/open", "v"), _v(year))
    open_slice = read_version(spark, f"{path}/open", ACTORS_HISTORY_SCD, "v", prev)
    rows = scd2_increment(open_slice, now, key=key, null_safe=null_safe)
    merged = conform(upsert(open_slice, rows, keys=[key, "start_date"],
                            update_cols=["quality_class", "is_active", "end_date"]), ACTORS_HISTORY_SCD)
    staged = scratch_path(spark, "scd2-step")  # computed once; both parts are read from it
    merged.write.parquet(staged)
    done = spark.read.schema(ACTORS_HISTORY_SCD).parquet(staged)
    now_open = done.where(F.col("end_date") == year)
    if now_open.isEmpty():
        return
    if prev is not None:  # replaced as a whole, also by nothing
        write_version(done.where(F.col("end_date") < year), f"{path}/closed", "v", prev)
    write_version(now_open, f"{path}/open", "v", _v(year))


def _v(year: int) -> str:
    return f"{int(year):09d}"


def read_scd2(spark: SparkSession, path: str) -> DataFrame:
    """The SCD table: the newest open slice and the history closed before it."""
    now = latest(versions(spark, f"{path}/open", "v"))
    out = read_version(spark, f"{path}/open", ACTORS_HISTORY_SCD, "v", now)
    closed = [v for v in versions(spark, f"{path}/closed", "v") if v < (now or "")]
    if closed:
        paths = [partition_path(f"{path}/closed", "v", v) for v in closed]
        out = out.unionByName(conform(spark.read.schema(ACTORS_HISTORY_SCD).parquet(*paths), ACTORS_HISTORY_SCD))
    return out


def scd2_load_years(spark: SparkSession, state: DataFrame, years: Sequence[int], path: str,
                    key: str = "actorid", null_safe: bool = False) -> DataFrame:
    """Apply the yearly SCD increment for each year of the cumulative ``state``, in order."""
    for y in years:
        scd2_load_year(spark, state, y, path, key, null_safe)
    return read_scd2(spark, path)


def datelist_load_days(spark: SparkSession, activity: DataFrame, keys: Sequence[str], path: str,
                       first_day: dt.date, days: int, list_col: str, schema, step: int = 5) -> DataFrame:
    """Load ``days`` daily snapshots into the table partitioned by ``date``, up to ``step`` of them per job.

    The distinct activity is landed by day once; a job reads its days' folders and the
    snapshot before them.  If the first day has no activity nothing ever loads, as in the serial run.
    """
    act_path = f"{path.rstrip('/')}-activity"
    act = activity.select(*keys, "day").distinct()
    land(act, act_path, "day", files_per_partition=1)
    if not has_partition(spark, act_path, "day", first_day):
        return spark.createDataFrame([], schema)
    for i in range(0, days, step):
        span = [first_day + dt.timedelta(days=j) for j in range(i, min(days, i + step))]
        there = [d for d in span if has_partition(spark, act_path, "day", d)]
        facts = landed(spark, act_path, act.schema, "day", there) if there else spark.createDataFrame([], act.schema)
        yesterday = read_partition(spark, path, schema, "date", span[0] - dt.timedelta(days=1))
        rows = datelist_days(yesterday, facts, keys, span[0], span[-1], list_col)
        overwrite_partitions(conform(rows, schema), path, "date", files_per_partition=2)
    return read_table(spark, path, schema)


_SLOTS = {"float": FloatType(), "long": LongType(), "double": DoubleType()}


def reduced_schema(count_type: str = "float") -> StructType:
    """The month table's schema with slots of ``count_type``; a table has one type for all its versions."""
    slots = ArrayType(_SLOTS[count_type])
    return StructType([StructField(f.name, slots, f.nullable) if isinstance(f.dataType, ArrayType) else f
                       for f in HOST_ACTIVITY_REDUCED.fields])


def reduce_load_range(spark: SparkSession, counts: DataFrame, path: str, first: dt.date, last: dt.date,
                      key: str = "host", count_type: str = "float") -> None:
    """Load days ``first..last`` of one month: a version of the month's rows through ``last``.

    The newest version is the prior state; whatever it holds of ``first`` and later is cut off, so
    loading a range again changes nothing.  Each load is a version of its own, ``<last>.<number>``.
    """
    month = first.replace(day=1)
    root = partition_path(path, "month", month)
    names = versions(spark, root, "through")
    schema = reduced_schema(count_type)
    state = read_version(spark, root, schema, "through", latest(names))
    rows = reduce_days(state, counts, first, last, key=key, count_type=count_type)
    number = sum(n.startswith(last.isoformat()) for n in names)
    write_version(conform(rows, schema), root, "through", f"{last.isoformat()}.{number:04d}")


def read_reduced(spark: SparkSession, path: str, months: Sequence[dt.date], count_type: str = "float") -> DataFrame:
    """The newest version of each month."""
    schema = reduced_schema(count_type)
    out = spark.createDataFrame([], schema)
    for m in months:
        root = partition_path(path, "month", m)
        out = out.unionByName(read_version(spark, root, schema, "through", latest(versions(spark, root, "through"))))
    return out


def month_ranges(first: dt.date, last: dt.date, step: int) -> list[tuple[dt.date, dt.date]]:
    """Ranges of at most ``step`` days that cover ``first..last`` and stay within a month."""
    out = []
    while first <= last:
        end = min(last, first + dt.timedelta(days=step - 1),
                  (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1))
        out.append((first, end))
        first = end + dt.timedelta(days=1)
    return out


def reduce_load_days(spark: SparkSession, counts: DataFrame, path: str, first_day: dt.date,
                     days: int, key: str = "host", step: int = 7, count_type: str = "float") -> DataFrame:
    """Load ``days`` days into the month table, up to ``step`` of them per job.

    The daily counts are landed by day once, so a job reads its days' folders. A month without
    counts and without a prior version has no rows and takes no job.
    """
    last_day = first_day + dt.timedelta(days=days - 1)
    counts_path = f"{path.rstrip('/')}-counts"
    land(counts, counts_path, "day", files_per_partition=1)
    ranges = month_ranges(first_day, last_day, step)
    found = {}
    for first, last in ranges:
        span = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
        found[first] = [d for d in span if exists(spark, partition_path(counts_path, "day", d))]
    held = {first.replace(day=1) for first, there in found.items() if there}
    for first, last in ranges:
        month, there = first.replace(day=1), found[first]
        if month not in held and not versions(spark, partition_path(path, "month", month), "through"):
            continue
        facts = (landed(spark, counts_path, counts.schema, "day", there) if there
                 else spark.createDataFrame([], counts.schema))
        reduce_load_range(spark, facts, path, first, last, key, count_type)
    return read_reduced(spark, path, sorted({a.replace(day=1) for a, _ in ranges}), count_type)
