"""Structured Streaming driver for the day-by-day loads.

The reference has no streams: its "incremental" models are batch steps run once
per day.  ``daily`` runs those same step operators from a file stream of events
(``foreachBatch``), loading each day once it is complete.
"""

from laminar.streaming.daily import (DailyLoad, host_datelist_load, read_streamed_reduced, reduced_load, run_stream,
                                     undated)

__all__ = ["DailyLoad", "host_datelist_load", "read_streamed_reduced", "reduced_load", "run_stream", "undated"]
