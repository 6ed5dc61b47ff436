"""Monthly reduced facts: entity x month with one array slot per day.

Slot i (0-based) holds the day month+i.  Arrays of one month have equal length:
an entity first seen on day k gets k-1 leading zeros, an idle day appends 0.

* ``daily_counts`` -- hits (rows) and unique visitors per (host, day);
* ``reduce_step`` -- one daily increment of the month table;
* ``reduce_days`` -- several consecutive days of increments in one job (catch-up);
* ``reduce_months`` / ``reduce_month`` -- the table of all months, or of one, in one job (backfill);
* ``fix_last`` -- correct the last slot (as written: every slot equal to it);
* ``explode_days`` -- read the arrays back as (host, day, value) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.functions.arrays import replace_equal_to_last, replace_last_slot, zero_prefix
from laminar.functions.dates import as_timestamp
from laminar.operators.joins import full_outer_null_safe


def _date(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("date")


def daily_counts(events: DataFrame, key: str = "host", user: str = "user_id",
                 time_col: str = "event_time") -> DataFrame:
    """(key, day, hits, visitors) over events with a known user.

    ``count_distinct`` is planned as a two-level aggregate with partial steps, so a hot
    (key, day) costs one row per map task in each shuffle.
    """
    day = F.to_date(as_timestamp(events, time_col))
    return (events.where(F.col(user).isNotNull())
            .groupBy(key, day.alias("day"))
            .agg(F.count(F.lit(1)).alias("hits"), F.count_distinct(user).alias("visitors")))


def _cut(arr: Column, n: Column, count_type: str) -> Column:
    """The first ``n`` slots of an array, filled up with zeros."""
    return F.concat(F.slice(arr, 1, n), F.array_repeat(F.lit(0).cast(count_type), n - F.size(arr)))


def _daily_maps(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and month, slot -> count maps (at most one entry per day)."""
    slot = F.datediff("day", F.trunc("day", "MM"))
    return counts.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(slot, "hits"))).alias("_h"),
        F.map_from_entries(F.collect_list(F.struct(slot, "visitors"))).alias("_v"))


def _fill(m: str, slots: Column, count_type: str) -> Column:
    return F.transform(slots, lambda i: F.coalesce(F.try_element_at(F.col(m), i), F.lit(0)).cast(count_type))


def reduce_step(month_state: DataFrame, counts: DataFrame, day, key: str = "host",
                count_type: str = "float") -> DataFrame:
    """The month table after loading ``day`` (day's month derived from it).

    ``month_state`` holds the rows of that month (may be empty); slots of ``day`` and later
    are replaced, so loading a day again changes nothing.  ``counts`` holds (key, day, hits, visitors).
    """
    return reduce_days(month_state, counts, day, day, key, count_type)


def reduce_months(counts: DataFrame, last_day, key: str = "host", count_type: str = "float") -> DataFrame:
    """The month table of every month up to ``last_day``, in one job.

    A key has a row per month in which it has a count.  Its daily rows (at most one per
    day) become a day->count map, read off for every slot of the month, in the last month up to ``last_day``.
    ``count_type`` is the slots' type: ``float`` as in the reference (whole counts are exact up to
    16,777,216 only), or ``long`` / ``double``.
    """
    last = _date(last_day)
    per_key = (_daily_maps(counts.where(F.col("day") <= last).withColumn("month", F.trunc("day", "MM")), [key, "month"])
               # bound first: a higher-order function may not contain the period subqueries
               .withColumn("_to", F.datediff(F.least(last, F.last_day("month")), F.col("month")))
               .withColumn("_slots", F.sequence(F.lit(0), F.col("_to"))))
    slots = F.col("_slots")
    return per_key.select(key, "month", _fill("_h", slots, count_type).alias("hit_array"),
                          _fill("_v", slots, count_type).alias("unique_visitor_array"))


def reduce_month(counts: DataFrame, month_start, last_day, key: str = "host", count_type: str = "float") -> DataFrame:
    """One month's table after loading days month_start..last_day (clamped to the month)."""
    month = _date(month_start)
    inside = counts.where(F.col("day").between(month, F.last_day(month)))
    return reduce_months(inside, last_day, key, count_type)


def reduce_days(month_state: DataFrame, counts: DataFrame, first_day, last_day,
                key: str = "host", count_type: str = "float") -> DataFrame:
    """The month table after loading days first_day..last_day in one job.

    ``month_state`` holds the month's rows (may be empty); both days must be in the same
    month.  Prior arrays are cut to the slots before ``first_day`` (and filled with
    zeros if shorter), then get one slot per day of the range (0 when idle), so a range
    loaded again replaces itself.  Keys first seen in the range get zeros from the 1st of
    the month.  One day is ``reduce_step``; an empty state from the 1st is ``reduce_month``.
    Per key at most one count per day is collected, then one full outer join on the key (null-safe).
    """
    first, last = _date(first_day), _date(last_day)
    month = F.trunc(first, "MM")
    per_key = _daily_maps(counts.where(F.col("day").between(first, last)), [key])
    y = (month_state.where(F.col("month") == month)
         .select(key, "hit_array", "unique_visitor_array", F.lit(True).alias("_known")))
    known = F.col("_known").isNotNull()
    # bound first: a higher-order function may not contain the period subqueries
    j = (full_outer_null_safe(per_key, y, [key])
         .withColumn("_month", month)
         .withColumn("_before", F.datediff(first, month))
         .withColumn("_from", F.when(known, F.col("_before")).otherwise(F.lit(0)))
         .withColumn("_to", F.datediff(last, month)))
    slots = F.sequence(F.col("_from"), F.col("_to"))

    def grown(arr: str, m: str) -> Column:
        new = _fill(m, slots, count_type)
        return F.when(known, F.concat(_cut(F.col(arr), F.col("_before"), count_type), new)).otherwise(new).alias(arr)

    return j.select(key, F.col("_month").alias("month"), grown("hit_array", "_h"), grown("unique_visitor_array", "_v"))


_FIXED = (("hit_array", "hits"), ("unique_visitor_array", "visitors"))


def fix_last_variants(month_state: DataFrame, recount: DataFrame, day, key: str = "host", default=None,
                      count_type: str = "float") -> DataFrame:
    """Both corrections of both arrays from one full outer join with ``recount(key, hits, visitors)``.

    ``<array>_as_written``: every slot equal to the last value is replaced, which is what replacing by value does;
    ``<array>_positional``: the last slot only.  A key without a recount gets ``default``
    (NULL as written).  A key that only the recount has gets a row: zeros, then the recount in ``day``'s slot.
    """
    d = _date(day)
    month = F.trunc(d, "MM")
    y = month_state.where(F.col("month") == month).select(key, *[a for a, _ in _FIXED], F.lit(True).alias("_known"))
    t = recount.select(key, *[F.col(v).alias(f"_{v}") for _, v in _FIXED], F.lit(True).alias("_counted"))
    j = full_outer_null_safe(y, t, [key]).withColumn("_month", month).withColumn("_slot", F.datediff(d, month))
    known = F.col("_known").isNotNull()
    out = []
    for arr, value in _FIXED:
        v = F.when(F.col("_counted").isNotNull(), F.col(f"_{value}")).otherwise(F.lit(default)).cast(count_type)
        new = zero_prefix(F.col("_slot"), v, count_type)
        out += [F.when(known, replace_equal_to_last(F.col(arr), v)).otherwise(new).alias(f"{arr}_as_written"),
                F.when(known, replace_last_slot(F.col(arr), v)).otherwise(new).alias(f"{arr}_positional")]
    return j.select(key, F.col("_month").alias("month"), *out)


def fix_last(month_state: DataFrame, recount: DataFrame, day, key: str = "host", positional: bool = False,
             default=None, count_type: str = "float") -> DataFrame:
    """The month table with both arrays' last slot corrected (see ``fix_last_variants``)."""
    kind = "positional" if positional else "as_written"
    both = fix_last_variants(month_state, recount, day, key, default, count_type)
    return both.select(key, "month", *[F.col(f"{a}_{kind}").alias(a) for a, _ in _FIXED])


def explode_days(month_state: DataFrame, key: str = "host") -> DataFrame:
    """(key, day, hits, visitors) rows read back from the month arrays."""
    z = month_state.select(key, "month", F.posexplode(F.arrays_zip("hit_array", "unique_visitor_array")))
    return z.select(key, F.date_add("month", F.col("pos")).alias("day"),
                    F.col("col.hit_array").cast("long").alias("hits"),
                    F.col("col.unique_visitor_array").cast("long").alias("visitors"))
