"""Constraint checks the database enforced and Spark does not: domains and keys.

Each returns a DataFrame of violations (empty when the table is clean) or a
one-row summary, computed as an ordinary distributed job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_PERIOD = "key_period"


def domain_violations(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose ``col`` is set but outside ``allowed`` (NULL is allowed, as for an enum)."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed)))


def domain_summary(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    bad = F.col(col).isNotNull() & ~F.col(col).isin(list(allowed))
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col(col).isNull()).alias("n_null"),
                  F.count_if(bad).alias("n_violations"))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once or contain a NULL, with their row count.

    A primary key is unique and NOT NULL.  The count is a hash aggregate with a
    partial step, so a hot key costs one row per map task in the shuffle.
    """
    keys = list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where((F.col("n_rows") > 1) | any_null))


# ---- keys kept up by loads -------------------------------------------------------
def key_counts(rows: DataFrame, keys: Sequence[str], period: Column) -> DataFrame:
    """How often each key occurs in each period: ``(*keys, n_rows, key_period)``.

    Counts of several loads add up, so they are a state that a load updates without older rows.  The period has to
    follow from the key (a column of it, or an expression over its columns), so a key lies in one period.
    """
    return rows.groupBy(*keys, period.alias(KEY_PERIOD)).agg(F.count(F.lit(1)).alias("n_rows")).select(*keys, "n_rows", KEY_PERIOD)


def merge_key_counts(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return old.unionByName(new).groupBy(*keys, KEY_PERIOD).agg(F.sum("n_rows").alias("n_rows")).select(*keys, "n_rows", KEY_PERIOD)


def counted_violations(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or contain a NULL, as ``key_violations`` finds them in the rows."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return counts.where((F.col("n_rows") > 1) | any_null).select(*keys, "n_rows")
