"""Deduplicate by key, keeping one row per key.

The reference numbers rows per key with no ORDER BY, so its pick is arbitrary.
Here the kept row is the *first* under an explicit order (default: the remaining
columns left to right, ascending, NULLS LAST), so the result is reproducible.

It is expressed as an aggregate -- ``min`` over a struct of (is-null flag, value)
pairs -- not as ``row_number`` over a window: the aggregate runs a partial step in
every map task, so a key holding a third of all rows is reduced to one row per
task before the shuffle instead of being sorted whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
          any_row: bool = False) -> DataFrame:
    """One row per ``keys`` (NULL keys form one group), columns in input order.

    ``any_row=True`` keeps an arbitrary row (``dropDuplicates``), the cheapest form
    when every non-key column is functionally dependent on the key.
    """
    keys = list(keys)
    if any_row:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else rest
    carried = [c for c in rest if c not in order]
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_v{i}")]
    fields += [F.col(c).alias(f"_c{j}") for j, c in enumerate(carried)]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_first"))
    names = {c: f"_first._v{i}" for i, c in enumerate(order)}
    names.update({c: f"_first._c{j}" for j, c in enumerate(carried)})
    return picked.select(*[F.col(c) if c in keys else F.col(names[c]).alias(c) for c in df.columns])
