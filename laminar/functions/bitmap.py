"""Date list -> 64-bit activity bitmap for one month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_bitmap(dates: Column, month_start: Column) -> Column:
    """Bit (d-1) set for every day d of the month present in ``dates``.

    Bit 0 is the 1st of the month.  Dates outside the month are ignored, a date
    listed twice counts once (bitwise OR), a NULL or empty list gives 0.  Row-local:
    no explode, no shuffle.
    """
    in_month = F.filter(dates, lambda d: F.trunc(d, "MM") == month_start)
    bits = F.aggregate(
        in_month, F.lit(0).cast("long"),
        lambda acc, d: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(d) - 1)))
    return F.coalesce(bits, F.lit(0).cast("long"))
