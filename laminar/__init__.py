"""laminar: cumulative and dimensional data modelling as Spark DataFrame operators.

Layout
------
functions/  column-level building blocks (bands, null-safe array ops, bitmaps, dates)
sources/    declared schemas, typed readers, stand-in role views over the test tables
operators/  DataFrame -> DataFrame operators (cumulate, scd2, dedup, upsert, datelist,
            reduced facts, star reports, checks)
plans/      multi-step jobs that write between steps (incremental loops, bucketed load,
            layout trial, versioned rewrite) and the query registry
streaming/  Structured Streaming driver for the day-by-day increments
"""

from laminar.functions import (AS_WRITTEN, QUALITY_CLASSES, SPEC, band, concat_nullsafe, month_bitmap,
                               replace_equal_to_last, replace_last_slot)
from laminar.operators.checks import domain_summary, domain_violations, key_violations
from laminar.operators.cumulate import cumulate_year_step, cumulate_years, period_agg
from laminar.operators.datelist import (datelist_backfill, datelist_bitmap, datelist_step, host_activity,
                                        user_activity)
from laminar.operators.dedup import dedup
from laminar.operators.joins import bounded_broadcast, fits_broadcast, left_join
from laminar.operators.reduced import (daily_counts, explode_days, fix_last, fix_last_variants, reduce_days,
                                       reduce_month, reduce_months, reduce_step)
from laminar.operators.reports import (match_fact, medal_by_map, player_match, shared_player_match, top1,
                                       top_avg_kills, top_map, top_medal_map, top_playlist)
from laminar.operators.scd2 import scd2_backfill, scd2_increment
from laminar.operators.upsert import upsert
from laminar.plans.load import layout_report, load_bucketed, load_star, reload_dedup, rewrite_dedup

__version__ = "0.1.0"

# Names used for these operators in the blueprint.
check_domain = domain_violations
check_key = key_violations
datelist_int = datelist_bitmap
replace_last = replace_equal_to_last
load_partitioned = load_bucketed
rewrite = rewrite_dedup

__all__ = [n for n in dir() if not n.startswith("_")]
