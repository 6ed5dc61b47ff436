"""Array helpers with PostgreSQL-like NULL handling where the models need it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_nullsafe(left: Column, right: Column) -> Column:
    """``left || right`` where a NULL side counts as empty (Spark's concat yields NULL).

    NULL only when both sides are NULL.
    """
    return (F.when(left.isNull(), right)
             .when(right.isNull(), left)
             .otherwise(F.concat(left, right)))


def zero_prefix(n: Column, value: Column, element_type: str = "float") -> Column:
    """``n`` zeros followed by ``value``: the first array of an entity first seen on slot n."""
    return F.concat(F.array_repeat(F.lit(0).cast(element_type), n), F.array(value.cast(element_type)))


def replace_equal_to_last(arr: Column, value: Column) -> Column:
    """Replace every element equal (NULL-safe) to the last element by ``value``.

    This is what replacing "the value found in the last slot" does: equal values
    in earlier slots are replaced too.
    """
    last = F.element_at(arr, -1)
    return F.transform(arr, lambda x: F.when(x.eqNullSafe(last), value).otherwise(x))


def replace_last_slot(arr: Column, value: Column, element_type: str | None = None) -> Column:
    """Replace only the last position by ``value`` (the evident intent).  Empty stays empty."""
    n = F.size(arr)
    v = value if element_type is None else value.cast(element_type)
    return F.when(n <= 0, arr).otherwise(F.concat(F.slice(arr, 1, n - 1), F.array(v)))
