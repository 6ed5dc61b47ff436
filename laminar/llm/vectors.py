"""Shared by the vector searches: which vectors take part, and blocks of them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null or empty, and all components finite numbers."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & fine, F.lit(False))


def matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by length: ``{dims: (row numbers, matrix)}``."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = {}
    ends = np.cumsum(lengths)
    for dims in np.unique(lengths):
        at = np.flatnonzero(lengths == dims)
        out[int(dims)] = (at, flat[(ends[at] - dims)[:, None] + np.arange(dims)])
    return out


def distinct_ids(queries: DataFrame, key: str, vec: str) -> DataFrame:
    """One row per query id; of repeated ids the smallest vector."""
    return queries.groupBy(key).agg(F.min(vec).alias(vec))
