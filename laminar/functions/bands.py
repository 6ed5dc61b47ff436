"""Score -> class bands.

A band list is an ordered tuple of (threshold, label); the first threshold the
score is strictly greater than wins, otherwise the default label.  A NULL score
falls to the default, as the searched CASE with ELSE does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference) -------------------------------
# Bands as the cumulative query writes them: > 8 star, > 7 good, > 6 good, else bad.
AS_WRITTEN = ((8.0, "star"), (7.0, "good"), (6.0, "good"))
# Bands as the table definition states them: > 8 star, > 7 good, > 6 average, else bad.
SPEC = ((8.0, "star"), (7.0, "good"), (6.0, "average"))
DEFAULT_CLASS = "bad"
# The quality_class domain, in declaration order.
QUALITY_CLASSES = ("star", "good", "average", "bad")
# ----------------------------------------------------------------------------


def band(score: Column, bands=AS_WRITTEN, default: str = DEFAULT_CLASS) -> Column:
    expr = None
    for threshold, label in bands:
        cond = score > F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))
