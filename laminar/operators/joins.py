"""Join helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Default row bound for a broadcast build side.  The dimensions broadcast here are
# pruned to a key and one or two short columns, so 1M rows (tens of MB) stay far
# below the broadcast size limit of an executor.
MAX_BROADCAST_ROWS = 1_000_000


# Bytes of text a broadcast side may hold besides (long names break a bound on rows alone).
MAX_BROADCAST_TEXT = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_text: int = MAX_BROADCAST_TEXT) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_text`` bytes in its string columns.

    ``offset(max_rows).take(1)`` runs as one collect-limit of ``max_rows + 1`` rows,
    which Spark executes incrementally: it scans a few partitions, then more, and
    stops as soon as it has seen ``max_rows + 1`` rows.  The rows are a constant
    projection (no column is read).  A large side therefore costs about
    ``max_rows`` rows of scanning; a filtered side is scanned until that many rows pass
    the filter, so at worst whole.  Only a side within the row bound has its text measured.
    """
    if len(df.select(F.lit(1).alias("_one")).offset(max_rows).take(1)):
        return False
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not text:
        return True
    return (df.agg(F.sum(reduce(lambda a, b: a + b, text))).first()[0] or 0) <= max_text


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint ``df`` for broadcast only after checking it has at most ``max_rows`` rows.

    The check (``fits_broadcast``) stops reading once the bound is exceeded, so its
    cost is bounded even for a large side.  Above the bound the DataFrame is
    returned unhinted and the join stays a shuffle join (adaptive execution may
    still switch it to broadcast from runtime sizes).
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def full_outer_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``left FULL OUTER JOIN right`` on keys compared null-safe; each key column once."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys],
                     F.lit(True).alias("_in_r"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    j = left.withColumn("_in_l", F.lit(True)).join(r, on, "full_outer")
    rest = [c for c in [*left.columns, *right.columns] if c not in keys]
    return j.select(*[F.when(F.col("_in_l"), F.col(k)).otherwise(F.col(f"_r_{k}")).alias(k) for k in keys], *rest)


# A right-side key with this many rows is salted, the largest MAX_HOT_KEYS of them at most (they are broadcast).
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000
SALTS = 64


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, most: int = MAX_HOT_KEYS) -> DataFrame:
    """The keys with at least ``hot_rows`` rows, as ``(*keys, _hot)``: the ``most`` largest if there are more.

    The order is total, so every evaluation names the same keys; those left out are joined like any other.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= hot_rows)
            .orderBy(F.col("_n").desc(), *keys).limit(most).select(*keys, F.lit(True).alias("_hot")))


def left_join(left: DataFrame, right: DataFrame, keys: list[str], skew_safe: bool = True,
              hot_rows: int = HOT_ROWS, salts: int = SALTS) -> DataFrame:
    """``left LEFT OUTER JOIN right USING (keys)``, safe against a hot key on the right.

    Adaptive execution splits a skewed partition only on the left side of a left
    outer join, so a right-side key holding a third of the rows would be joined in one
    task.  With ``skew_safe`` the right side's keys are counted first (a partial aggregate of
    the key columns); those with at least ``hot_rows`` rows, ``MAX_HOT_KEYS`` at most, are broadcast, their right rows spread over
    ``salts`` by a hash of the row, and their left rows copied once per salt.  A hot key has
    matches by definition, so a copy that meets none is dropped, and the result equals
    the left outer join exactly (a left row with a NULL key matches nothing and is kept once).
    ``left`` is computed once; a hot left key is split by adaptive execution.
    """
    if not skew_safe:
        return left.join(right, keys, "left")
    hot = hot_keys(right, keys, hot_rows)
    spread = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    many = left.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(spread))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*[F.col(c) for c in right.columns]), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    salted = (right.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt)
              .select(*right.columns, "_salt", F.lit(True).alias("_met")))
    rest = [c for c in right.columns if c not in keys]
    return (many.join(salted, [*keys, "_salt"], "left").where(F.col("_hot").isNull() | F.col("_met").isNotNull())
            .select(*left.columns, *rest))
