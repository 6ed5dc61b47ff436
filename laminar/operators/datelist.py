"""Cumulative active-date lists (entity x day) and their monthly bitmap.

* ``user_activity`` / ``host_activity`` -- (keys, day) activity facts, distinct by default;
* ``datelist_step`` -- one daily increment (yesterday's snapshot + today's facts);
* ``datelist_days`` -- several consecutive daily increments in one job (catch-up);
* ``datelist_backfill`` -- every snapshot a serial run of steps writes, in one job
  (or just the snapshot of one day with ``as_of``);
* ``datelist_bitmap`` -- a snapshot's list packed into a 64-bit month bitmap.

A NULL key is an entity of its own, in the steps and in the closed forms alike.
Lists are newest first.  Once an entity is active it has a row every later day,
its list unchanged on idle days.  A run whose first day has no activity never
starts (the table stays empty), as in the serial load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.functions.arrays import concat_nullsafe
from laminar.functions.bitmap import month_bitmap
from laminar.functions.dates import as_timestamp
from laminar.operators.joins import MAX_BROADCAST_ROWS, fits_broadcast, full_outer_null_safe


def user_activity(events: DataFrame, devices: DataFrame, time_col: str = "event_time",
                  distinct: bool = True, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(user_id, browser_type, day) for events whose user and device are known.

    When the device side passes the broadcast size check the join is map-side and
    the partial aggregate of the final DISTINCT reduces events before the only
    shuffle.  Otherwise events are first reduced to distinct (user, device, day), so
    the shuffle into the join moves one row per user-device-day, not one per event.
    ``distinct=False`` keeps one row per event and device row, whatever the size of the
    device side, for a consumer that removes duplicates itself (a per-key
    ``collect_set``).  Rows do not depend on the size check, only the plan does.
    """
    day = F.to_date(as_timestamp(events, time_col))
    ev = (events.where(F.col("device_id").isNotNull() & F.col("user_id").isNotNull())
          .select("user_id", "device_id", day.alias("day")))
    dev = devices.select("device_id", "browser_type")
    if fits_broadcast(dev, max_broadcast_rows):
        dev = F.broadcast(dev)
    elif distinct:
        ev = ev.distinct()
    act = ev.join(dev, "device_id").select("user_id", "browser_type", "day")
    return act.distinct() if distinct else act


def host_activity(events: DataFrame, time_col: str = "event_time", distinct: bool = True) -> DataFrame:
    """(host, day), distinct unless the consumer deduplicates itself."""
    day = F.to_date(as_timestamp(events, time_col))
    act = events.select("host", day.alias("day"))
    return act.distinct() if distinct else act


def datelist_step(yesterday: DataFrame, activity: DataFrame, keys: Sequence[str], today,
                  list_col: str, date_col: str = "date") -> DataFrame:
    """The snapshot of ``today`` from yesterday's snapshot rows and the activity facts.

    Active today: ``[today] || yesterday's list``; idle: the list unchanged; the
    snapshot date advances by one day either way.
    """
    keys = list(keys)
    today = F.lit(today).cast("date") if not isinstance(today, Column) else today
    # The day is fixed, so today's distinct keys are computed on the keys alone: that
    # shuffle's partitioning is the one the join needs, so only yesterday is shuffled.
    t = (activity.where(F.col("day") == today).select(*keys).distinct()
         .select(*keys, F.array(today).alias("_t_list"), today.alias("_t_date")))
    y = yesterday.select(*keys, F.col(list_col).alias("_y_list"), F.col(date_col).alias("_y_date"))
    j = full_outer_null_safe(t, y, keys)
    return j.select(*keys, concat_nullsafe(F.col("_t_list"), F.col("_y_list")).alias(list_col),
                    F.coalesce(F.col("_t_date"), F.date_add(F.col("_y_date"), 1)).alias(date_col))


def datelist_days(yesterday: DataFrame, activity: DataFrame, keys: Sequence[str], first_day, last_day,
                  list_col: str, date_col: str = "date") -> DataFrame:
    """The snapshots of days first_day..last_day on top of the snapshot of the day
    before (``yesterday``, may be empty), in one job (catch-up of several daily steps).

    A known key gets a row every day: its new active days (newest first) in front of
    yesterday's list.  A new key starts on its first active day.  With an empty
    ``yesterday`` and no activity on ``first_day`` nothing loads, as in the serial run.
    One day is exactly ``datelist_step``; an empty ``yesterday`` gives
    ``datelist_backfill``.  Per key at most one entry per day is collected.
    """
    keys = list(keys)
    first = F.lit(first_day).cast("date") if not isinstance(first_day, Column) else first_day
    last = F.lit(last_day).cast("date") if not isinstance(last_day, Column) else last_day
    act = activity.where(F.col("day").between(first, last)).select(*keys, "day")
    per_key = (act.groupBy(*keys)
               .agg(F.sort_array(F.collect_set("day"), asc=False).alias("_days"), F.min("day").alias("_first")))
    y = yesterday.select(*keys, F.col(list_col).alias("_y_list"), F.lit(True).alias("_known"))
    started = yesterday.exists() | act.where(F.col("day") == first).exists()
    j = (full_outer_null_safe(per_key, y, keys).where(started)
         .withColumn("_start", F.when(F.col("_known").isNotNull(), first).otherwise(F.col("_first")))
         .withColumn("_last", last))
    snaps = j.select(*keys, "_days", "_y_list",
                     F.explode(F.sequence(F.col("_start"), F.col("_last"))).alias(date_col))
    new = F.filter("_days", lambda d: d <= F.col(date_col))
    return snaps.select(*keys, concat_nullsafe(new, F.col("_y_list")).alias(list_col), date_col)


def datelist_backfill(activity: DataFrame, keys: Sequence[str], first_day, last_day,
                      list_col: str, date_col: str = "date", as_of=None) -> DataFrame:
    """All snapshots first_day..last_day a daily run from an empty table writes.

    Per key the distinct active days are collected once (at most one per day of the
    range, whatever the raw event skew); each snapshot day keeps those <= its date.
    ``activity`` may hold duplicate (keys, day) rows.
    ``as_of`` returns only that day's snapshot, without the day expansion.
    """
    keys = list(keys)
    first = F.lit(first_day).cast("date") if not isinstance(first_day, Column) else first_day
    last = F.lit(last_day).cast("date") if not isinstance(last_day, Column) else last_day
    upto = last if as_of is None else (F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of)
    act = activity.where(F.col("day").between(first, upto)).select(*keys, "day")
    started = act.where(F.col("day") == first).exists()
    # collect_set has a map-side partial step: duplicates (raw events or activity
    # rows) collapse before the single shuffle on the keys.
    per_key = (act.groupBy(*keys)
               .agg(F.sort_array(F.collect_set("day"), asc=False).alias("_days"),
                    F.min("day").alias("_first"))
               .where(started))
    if as_of is not None:
        return per_key.select(*keys, F.col("_days").alias(list_col), upto.alias(date_col))
    snaps = per_key.select(*keys, "_days",
                           F.explode(F.sequence(F.col("_first"), last)).alias(date_col))
    return snaps.select(*keys, F.filter("_days", lambda d: d <= F.col(date_col)).alias(list_col),
                        date_col)


def datelist_bitmap(snapshot: DataFrame, keys: Sequence[str], list_col: str, month_start,
                    out_col: str = "device_activity_datelist_int") -> DataFrame:
    """Per key, bit (d-1) set when day d of the month is in the list (row-local).

    The snapshot has one row per key, so no aggregation (and no shuffle) is needed; a key
    present twice gives two rows.
    """
    month = F.lit(month_start).cast("date") if not isinstance(month_start, Column) else month_start
    return snapshot.select(*keys, month_bitmap(F.col(list_col), month).alias(out_col))
