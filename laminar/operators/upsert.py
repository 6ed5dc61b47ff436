"""Upsert by key ("insert ... on conflict (keys) do update set <cols>") on DataFrames.

Parquet tables have no MERGE, so an upsert is a full outer join on the key whose
result replaces the touched data: either the whole (small) table as a new version,
or -- when the period is part of the key -- just the touched partitions with a
dynamic partition overwrite (see ``laminar.plans.tables``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, check_unique: bool = True) -> DataFrame:
    """The target after upserting ``source`` on ``keys``.

    Unmatched target rows are kept, unmatched source rows inserted, matched rows take
    ``update_cols`` from the source (default: every non-key column) and keep the
    rest.  With ``check_unique`` a source key present twice fails the job (as the
    database does) instead of picking one silently; the check is a window on the
    same key the join shuffles on, so it adds no exchange.
    """
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    update_cols = list(update_cols) if update_cols is not None else cols
    src = source.select(*keys, *[c for c in source.columns if c not in keys])
    if check_unique:
        dup = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        src = (src.withColumn("_n", dup)
               .where(F.when(F.col("_n") > 1, F.raise_error(F.lit(
                   "upsert source has a duplicate key; a row would be updated twice")))
                      .otherwise(F.lit(True)))
               .drop("_n"))
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = src.withColumn("_in_s", F.lit(True)).alias("s")
    j = t.join(s, keys, "full_outer")
    out = []
    for c in cols:
        if c in update_cols:
            out.append(F.when(F.col("s._in_s"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col("t._in_t"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return j.select(*keys, *out).select(*target.columns)
