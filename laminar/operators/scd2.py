"""Slowly-changing (type 2) dimensions from cumulative snapshots.

Validity intervals are two plain integer columns, both ends inclusive.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def scd2_backfill(state: DataFrame, key: str = "actorid", tracked: Sequence[str] = ("quality_class", "is_active"),
                  period: str = "current_year", attrs: Sequence[str] = ("actor",),
                  start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Collapse a full snapshot history into change intervals in one job.

    A row starts a new streak when any tracked column differs from the previous
    period's value (a NULL comparison is *not* a change).  Intervals are grouped by
    key, attrs, streak and the tracked values, so a NULL<->value switch still splits.
    Plan: one exchange on ``key``; lag and running sum share one window; the final
    aggregate's keys contain ``key`` so it needs no second exchange.  A key holds one
    row per period, so a window partition is bounded by the number of periods.
    """
    w = Window.partitionBy(key).orderBy(period)
    diffs = [F.col(c) != F.lag(c, 1).over(w) for c in tracked]
    changed = reduce(lambda a, b: a | b, diffs)
    flagged = state.select(key, *attrs, *tracked, period,
                           F.when(changed, 1).otherwise(0).alias("_chg"))
    streaks = flagged.withColumn("_streak", F.sum("_chg").over(w))
    return (streaks.groupBy(key, *attrs, "_streak", *tracked)
            .agg(F.min(period).cast("int").alias(start), F.max(period).cast("int").alias(end))
            .select(key, *attrs, *tracked, start, end))


def scd2_increment(scd: DataFrame, state: DataFrame, key: str = "actorid",
                   tracked: Sequence[str] = ("quality_class", "is_active"),
                   period: str = "current_year", attrs: Sequence[str] = ("actor",),
                   start: str = "start_date", end: str = "end_date",
                   null_safe: bool = False) -> DataFrame:
    """Rows to upsert on (key, start) for the latest period of ``state``.

    Open records are those whose end equals the table's latest end.  An entity whose
    tracked values are unchanged keeps its start and gets the new end; a changed or
    unseen entity opens a record [period, period].  With ``null_safe=False`` (as
    written) a pair with a NULL tracked value on either side that is otherwise equal
    falls in neither branch and is dropped; ``null_safe=True`` compares with <=>.
    """
    open_end = scd.agg(F.max(end)).scalar()
    last = scd.where(F.col(end) == open_end).select(
        key, *[F.col(c).alias(f"_l_{c}") for c in tracked], F.col(start).alias("_l_start"))
    cur_period = state.agg(F.max(period)).scalar()
    cur = state.where(F.col(period) == cur_period).select(
        key, *attrs, *tracked, F.col(period).cast("int").alias("_p"))
    j = cur.join(last, key, "left")
    if null_safe:
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_l_{c}")) for c in tracked])
        differ = ~same
    else:
        same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_l_{c}") for c in tracked])
        differ = reduce(lambda a, b: a | b, [F.col(c) != F.col(f"_l_{c}") for c in tracked])
    unseen = F.col("_l_start").isNull()
    matched = j.where(~unseen & same).select(key, *attrs, *tracked, F.col("_l_start").alias(start),
                                             F.col("_p").alias(end))
    opened = j.where(differ | unseen).select(key, *attrs, *tracked, F.col("_p").alias(start),
                                             F.col("_p").alias(end))
    return matched.unionByName(opened)


OPEN = "is_open"  # marks the records of an entity's current streak


def scd2_range(open_records: DataFrame, state: DataFrame, first: int, last: int, key: str = "actorid",
               tracked: Sequence[str] = ("quality_class", "is_active"), period: str = "current_year",
               attrs: Sequence[str] = ("actor",), start: str = "start_date", end: str = "end_date") -> DataFrame:
    """The intervals that the periods ``first..last`` continue or open, in one job: a range step of the backfill.

    ``open_records`` are the records of every entity's current streak before ``first`` (what an earlier range
    marked ``is_open``; empty at the start).  They take part in the change-streak window as rows at their ends, so an
    interval begun before the range is continued, not restarted.  The result holds these records as they now are
    and all new ones, each with ``is_open``; records closed by earlier ranges are not read.  Any split of the periods
    into ranges gives the rows of ``scd2_backfill``.

    Plan: one exchange on ``key``; a window partition holds an entity's periods of this range and the records
    of one streak (one but for NULLs).
    """
    cols = [key, *attrs, *tracked]
    seeds = open_records.select(*cols, F.col(end).alias("_p"), F.col(start).alias("_from"))
    rows = state.where(F.col(period).between(first, last)).select(*cols, F.col(period).alias("_p"), F.lit(None).alias("_from"))
    w = Window.partitionBy(key).orderBy("_p", F.col("_from").desc_nulls_last())
    # records of one streak follow each other without a change; the last of them is the row before the range
    changed = reduce(lambda a, b: a | b, [F.col(c) != F.lag(c, 1).over(w) for c in tracked])
    flagged = seeds.unionByName(rows).withColumn("_chg", F.when(F.col("_from").isNull() & changed, 1).otherwise(0))
    streaks = flagged.withColumn("_streak", F.sum("_chg").over(w))
    newest = streaks.withColumn("_newest", F.max("_streak").over(Window.partitionBy(key)))
    return (newest.groupBy(*cols, "_streak", "_newest")
            .agg(F.min(F.coalesce("_from", "_p")).cast("int").alias(start), F.max("_p").cast("int").alias(end))
            .select(*cols, start, end, (F.col("_streak") == F.col("_newest")).alias(OPEN)))


def scd2_correct(scd: DataFrame, corrections: DataFrame, key: str = "actorid",
                 tracked: Sequence[str] = ("quality_class", "is_active"), period: str = "current_year",
                 attrs: Sequence[str] = ("actor",), start: str = "start_date", end: str = "end_date",
                 removed: str | None = None) -> DataFrame:
    """Records to delete from and to insert into ``scd`` after corrections of past periods (column ``op``).

    ``corrections`` has the right row of an entity for each corrected period, at most one each (a second one for the same period
    fails the job); with ``removed``, a boolean column of that name marks periods the entity has no row in.
    The state itself is not read: a record stands for a row in each of its periods, so it is cut at the corrected
    periods, the right rows are put in, and neighbours that no longer differ become one.  Only entities with a
    correction are computed, and only records that change are in the result.  NULL is a value like others here.

    Plan: the corrections reduced to one row per entity meet the records of these entities in one
    join on ``key``; the window and the two aggregates keep that partitioning.
    """
    cols = [key, *attrs, *tracked]
    gone = F.col(removed) if removed else F.lit(False)
    fixes = corrections.select(*cols, F.col(period).cast("int").alias("_p"), F.coalesce(gone, F.lit(False)).alias("_gone"))
    by_entity = fixes.groupBy(key).agg(F.array_sort(F.collect_list("_p")).alias("_cuts"))
    twice = F.size(F.array_distinct("_cuts")) < F.size("_cuts")
    by_entity = by_entity.where(F.when(twice, F.raise_error(F.lit("a period of one entity is corrected twice"))).otherwise(F.lit(True)))
    old = scd.join(by_entity, key).select(*cols, F.col(start).alias("_s"), F.col(end).alias("_e"), "_cuts")
    # what is left of a record: the stretches between the cuts inside it
    inside = F.filter("_cuts", lambda c: (c >= F.col("_s")) & (c <= F.col("_e")))
    edges = F.concat(F.array(F.col("_s") - 1), inside, F.array(F.col("_e") + 1))
    stretches = F.transform(F.sequence(F.lit(1), F.size("_in") + 1), lambda i: F.struct(
        (F.element_at("_edges", i) + 1).alias("s"), (F.element_at("_edges", i + 1) - 1).alias("e")))
    left = (old.withColumn("_in", inside).withColumn("_edges", edges)
            .select(*cols, F.explode(F.filter(stretches, lambda x: x["s"] <= x["e"])).alias("_x"))
            .select(*cols, F.col("_x.s").alias("_s"), F.col("_x.e").alias("_e")))
    right = fixes.where(~F.col("_gone")).select(*cols, F.col("_p").alias("_s"), F.col("_p").alias("_e"))
    w = Window.partitionBy(key).orderBy("_s")
    changed = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.lag(c, 1).over(w)) for c in [*attrs, *tracked]])
    new = (left.unionByName(right).withColumn("_chg", F.when(changed, 1).otherwise(0))
           .withColumn("_streak", F.sum("_chg").over(w)).groupBy(*cols, "_streak")
           .agg(F.min("_s").alias("_s"), F.max("_e").alias("_e")))
    # records on both sides cancel out
    sided = old.select(*cols, "_s", "_e", F.lit(-1).alias("_n")).unionByName(new.select(*cols, "_s", "_e", F.lit(1).alias("_n")))
    return (sided.groupBy(*cols, "_s", "_e").agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
            .select(*cols, F.col("_s").alias(start), F.col("_e").alias(end),
                    F.when(F.col("_n") > 0, "insert").otherwise("delete").alias("op")))


def scd2_apply(scd: DataFrame, changes: DataFrame) -> DataFrame:
    """``scd`` with the records of ``scd2_correct`` taken out and put in."""
    cols = scd.columns
    taken = changes.where(F.col("op") == "delete").select(*[F.col(c).alias(f"_x_{c}") for c in cols])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_x_{c}")) for c in cols])
    put = changes.where(F.col("op") == "insert").select(*cols)
    return scd.join(taken, same, "left_anti").unionByName(put)
