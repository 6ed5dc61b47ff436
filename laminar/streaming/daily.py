"""Run the daily models from a stream of event files.

Each micro-batch (``foreachBatch``):

1. writes the batch's rows, projected to what the model needs, to its own staging folder
   ``batch=<id>``, partitioned by event day.  A batch replayed after a failure overwrites
   that folder, so no event is staged twice;
2. loads, in one job with the model's range operator (``datelist_days`` / ``reduce_days``,
   which equal the serial daily steps), every day from the first one it has to: the day after
   the last loaded, or an earlier one for which the batch brought late events.  A late event
   thus reloads its day and all later ones; none is lost, whatever the order of the files.

A day is loaded once a newer one (plus an allowed lateness) has been seen; until then its
rows wait in staging.  Rows without an event time belong to no day; they stay in the staging folder of
``day`` NULL and are counted by ``undated``.  Progress lives in the tables, not in
driver memory: the last loaded day is read back from the target, and the range is read by
its day folders only.  A backlog (a restart after downtime, a replay) is caught up in one job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from laminar.functions.dates import as_timestamp
from laminar.operators.datelist import datelist_days
from laminar.operators.reduced import daily_counts
from laminar.plans.incremental import month_ranges, read_reduced, reduce_load_range
from laminar.plans.tables import (conform, exists, hadoop_path, overwrite_partitions, partition_path, read_partition,
                                  versions)
from laminar.sources.schemas import HOSTS_CUMULATED


@dataclass
class DailyLoad:
    """A daily model: what to stage per event, how to load a range of days, how far it got.

    ``load_range(spark, staged, first, last)`` loads days ``first..last`` from the staged
    rows of those days on top of what the target holds for the day before. Days before ``first_day``
    are not loaded (``early`` counts their rows); without one every day is, from the first staged.
    """
    staging_cols: list[str]
    load_range: Callable[[SparkSession, DataFrame, dt.date, dt.date], None]
    loaded_through: Callable[[SparkSession], dt.date | None]
    first_day: dt.date | None


def host_datelist_load(target: str, first_day: dt.date) -> DailyLoad:
    """Host active-date list (table partitioned by ``date``)."""

    def loaded_through(spark):
        return spark.read.parquet(target).agg(F.max("date")).first()[0] if exists(spark, target) else None

    def load_range(spark, staged, first, last):
        y = read_partition(spark, target, HOSTS_CUMULATED, "date", first - dt.timedelta(days=1))
        rows = datelist_days(y, staged.select("host", "day"), ["host"], first, last, "host_activity_datelist")
        overwrite_partitions(conform(rows, HOSTS_CUMULATED), target, "date")

    return DailyLoad(["host"], load_range, loaded_through, first_day)


def reduced_load(target: str, first_day: dt.date | None = None, count_type: str = "float") -> DailyLoad:
    """Monthly reduced hits / unique visitors: versions of each month (``laminar.plans.tables``).

    The last loaded day is the newest version's name.  A range crossing a month boundary is loaded as
    one job per month that has rows or a version; a version keeps the one before readable until it is whole.
    """

    def loaded_through(spark):
        days = [d for m in _folders(spark, target, "month") for d in versions(spark, partition_path(target, "month", m), "through")]
        return dt.date.fromisoformat(max(days)[:10]) if days else None

    def load_range(spark, staged, first, last):
        counts = daily_counts(staged.withColumnRenamed("ts", "event_time"))
        ranges = month_ranges(first, last, 31)
        held = {ranges[-1][0].replace(day=1), *(dt.date.fromisoformat(m) for m in _folders(spark, target, "month"))}
        if any(a.replace(day=1) not in held for a, _ in ranges):
            held |= {r[0] for r in staged.select(F.trunc("day", "MM")).distinct().collect()}
        for a, b in ranges:
            if a.replace(day=1) in held:
                reduce_load_range(spark, counts, target, a, b, count_type=count_type)

    return DailyLoad(["host", "user_id", "ts"], load_range, loaded_through, first_day)


def read_streamed_reduced(spark: SparkSession, target: str, count_type: str = "float") -> DataFrame:
    return read_reduced(spark, target, [dt.date.fromisoformat(m) for m in _folders(spark, target, "month")], count_type)


def _folders(spark: SparkSession, path: str, col: str) -> list[str]:
    if not exists(spark, path):
        return []
    fs, p = hadoop_path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n[len(col) + 1:] for n in names if n.startswith(f"{col}="))


def undated(spark: SparkSession, staging: str) -> int:
    """How many staged rows have no event time, hence belong to no day."""
    if not exists(spark, staging):
        return 0
    return spark.read.option("basePath", staging).parquet(staging).where(F.col("day").isNull()).count()


def early(spark: SparkSession, staging: str, first_day: dt.date) -> int:
    """How many staged rows lie before a model's ``first_day``, hence are not loaded."""
    if not exists(spark, staging):
        return 0
    return spark.read.option("basePath", staging).parquet(staging).where(F.col("day").cast("date") < F.lit(first_day)).count()


def run_stream(spark: SparkSession, source_dir: str, schema, model: DailyLoad, staging: str,
               checkpoint: str, time_col: str = "event_time", lateness_days: int = 0,
               available_now: bool = True, finalize: bool = False):
    """Start the stream; with ``available_now`` process what is there and return.

    ``finalize`` also loads the newest day seen (for a bounded replay where no later
    event will arrive to close it).
    """
    staging = staging.rstrip("/")
    events = spark.readStream.schema(schema).parquet(source_dir)
    ts = as_timestamp(events, time_col)
    staged_cols = [F.col(c) for c in model.staging_cols if c != "ts"]
    if "ts" in model.staging_cols:
        staged_cols.append(ts.alias("ts"))
    projected = events.select(*staged_cols, F.to_date(ts).alias("day"))
    staged_schema = StructType([*projected.schema.fields]).add("batch", LongType())

    def staged_days(first: dt.date, last: dt.date) -> DataFrame:
        """The staged rows of days first..last, read by their folders in every batch."""
        paths = []
        for b in _folders(spark, staging, "batch"):
            days = set(_folders(spark, f"{staging}/batch={b}", "day"))
            span = [(first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]
            paths += [f"{staging}/batch={b}/day={d}" for d in span if d in days]
        if not paths:
            return spark.createDataFrame([], projected.schema)
        return spark.read.schema(staged_schema).option("basePath", staging).parquet(*paths).drop("batch")

    def days_of(batch: str) -> list[dt.date]:
        return [dt.date.fromisoformat(d) for d in _folders(spark, f"{staging}/batch={batch}", "day") if d[:1].isdigit()]

    def load_complete_days(touched: list[dt.date], upto_inclusive: bool):
        seen = [d for b in _folders(spark, staging, "batch") for d in days_of(b)]
        if not seen:
            return
        prev = model.loaded_through(spark)
        last = max(seen) if upto_inclusive else max(seen) - dt.timedelta(days=1 + lateness_days)
        last = max(last, prev) if prev is not None else last  # late rows reload through what is loaded
        start = (model.first_day or min(seen)) if prev is None else prev + dt.timedelta(days=1)
        first = min([start, *(d for d in touched if model.first_day is None or d >= model.first_day)])
        if first <= last:
            model.load_range(spark, staged_days(first, last), first, last)

    def batch(df: DataFrame, batch_id: int):
        df.write.mode("overwrite").partitionBy("day").parquet(f"{staging}/batch={batch_id}")
        load_complete_days(days_of(str(batch_id)), False)

    writer = projected.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        if finalize:
            load_complete_days([], True)
    return query
