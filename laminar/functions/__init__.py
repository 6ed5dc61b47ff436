"""Column-level helpers.  Everything here is built from Spark's own expressions."""

from laminar.functions.arrays import concat_nullsafe, replace_equal_to_last, replace_last_slot, zero_prefix
from laminar.functions.bands import AS_WRITTEN, SPEC, QUALITY_CLASSES, band
from laminar.functions.bitmap import month_bitmap
from laminar.functions.dates import as_timestamp, day_of, month_of

__all__ = [
    "AS_WRITTEN", "SPEC", "QUALITY_CLASSES", "band",
    "concat_nullsafe", "replace_equal_to_last", "replace_last_slot", "zero_prefix",
    "month_bitmap", "as_timestamp", "day_of", "month_of",
]
