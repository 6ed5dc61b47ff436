"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def as_timestamp(df, name: str) -> Column:
    """Event time as a timestamp.

    Typed columns pass through (so a day predicate still reaches the parquet scan as a
    range); text is parsed, and a malformed value fails the job, as the reference does.  Take such
    rows out first with ``split_times``.
    """
    if isinstance(df.schema[name].dataType, StringType):
        parsed = F.expr(f"try_cast(`{name}` AS TIMESTAMP)")
        bad = F.col(name).isNotNull() & parsed.isNull()
        return F.when(bad, F.raise_error(F.concat(F.lit("not an event time: "), F.col(name)))).otherwise(parsed)
    return F.col(name)


def split_times(df, name: str):
    """``(good, rejected)``: the rows whose event time is NULL or can be parsed, and the others."""
    if not isinstance(df.schema[name].dataType, StringType):
        return df, df.where(F.lit(False))
    bad = F.col(name).isNotNull() & F.expr(f"try_cast(`{name}` AS TIMESTAMP)").isNull()
    return df.where(~bad), df.where(bad)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def month_of(d: Column) -> Column:
    return F.trunc(d, "MM")
