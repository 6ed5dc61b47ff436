"""Activity as a shifted 64-bit register: bit ``i`` says whether the key was active ``i`` days ago.

The month bitmap of a snapshot (``datelist_bitmap``) counts bits from the first of one month; a register counts them back
from its own day, so it runs on across month ends: a day later everything moves up by one bit.  Registers of several
keys (a user's browsers) roll up with ``bit_or``, and the bits under a mask tell who was active within a day, a week, a month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64
WINDOWS = {"dau": 1, "wau": 7, "mau": 28}  # days that count as active, the day itself included
REGISTER = "register"


def advance(state: DataFrame, activity: DataFrame, keys: Sequence[str], first: dt.date, last: dt.date) -> DataFrame:
    """Registers as of ``last`` from those as of the day before ``first`` and the ``activity(*keys, day)`` in between.

    ``state(*keys, register)`` may be empty; repeated days and keys count once; activity outside the days is ignored.
    A key without activity in the last 64 days has no bit left and drops out.  One exchange on the keys, with a partial step.
    """
    days = (last - first).days + 1
    if not 0 < days <= BITS:
        raise ValueError(f"a step advances by 1 to {BITS} days")
    moved = state.select(*keys, _shifted(F.col(REGISTER), days).alias(REGISTER))
    ago = F.date_diff(F.lit(last), F.col("day"))
    fresh = activity.where(F.col("day").between(F.lit(first), F.lit(last))).select(
        *keys, F.call_function("shiftleft", F.lit(1).cast("bigint"), ago).alias(REGISTER))
    return moved.unionByName(fresh).groupBy(*keys).agg(F.bit_or(REGISTER).alias(REGISTER)).where(F.col(REGISTER) != 0)


def _shifted(register: Column, days: int) -> Column:
    # a shift by the full width is no shift in the JVM
    return F.shiftleft(register, days) if days < BITS else F.lit(0).cast("bigint")


def roll_up(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Registers of coarser keys: active when any of theirs was."""
    return state.groupBy(*keys).agg(F.bit_or(REGISTER).alias(REGISTER))


def active_days(register: Column, days: int, ago: Column | int = 0) -> Column:
    """Number of active days among the ``days`` that end ``ago`` days before the register's day."""
    seen = F.call_function("shiftrightunsigned", register, ago if isinstance(ago, Column) else F.lit(ago))
    return F.bit_count(seen.bitwiseAND(F.lit((1 << days) - 1 if days < BITS else -1).cast("bigint")))


def activity_counts(state: DataFrame, last: dt.date, days: int, windows: dict[str, int] = WINDOWS) -> DataFrame:
    """Active keys ``(day, *windows)`` of each of the ``days`` up to ``last``, from registers as of ``last`` alone.

    A register covers 64 days, so ``days - 1`` plus the longest window may be that many.  Every key is spread over the days
    before a partial count: the exchange carries one row per day and task.
    """
    if days - 1 + max(windows.values()) > BITS:
        raise ValueError("the registers do not reach back that far")
    spread = state.select(REGISTER, F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("ago"))
    active = [F.count_if(active_days(F.col(REGISTER), n, F.col("ago")) > 0).alias(name) for name, n in windows.items()]
    return (spread.groupBy("ago").agg(*active)
            .select(F.date_sub(F.lit(last), F.col("ago")).alias("day"), *windows))
