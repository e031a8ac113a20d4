"""Presence analytics for door-badge events, expressed as Spark DataFrame operators.

    from turnstile import jobs
    jobs.run(badges, doors, frequency="Weekly")

runs the whole month; the operators below do one step each and are used with
``df.transform(...)``.
"""

from turnstile.operators.dedup import distinct_values, keep_first, keep_unique, split_by
from turnstile.operators.enrich import enrich_badges, in_batch, month_range
from turnstile.operators.grouping import (
    balanced_groups,
    batch_bounds,
    batch_members,
    batch_ranges,
    eid_month_counts,
    month_max,
)
from turnstile.operators.months import in_months, processing_months, retain
from turnstile.operators.normalise import normalise_badges, normalise_rows
from turnstile.operators.occupancy import eid_daily, expand_hours, hourly_occupancy, round_hours
from turnstile.operators.quality import (
    anomaly_stats,
    duration_profile,
    orphan_counts,
    quality_profile,
)
from turnstile.operators.rollup import peak_rollup, peak_totals, quality_rollup
from turnstile.operators.sequence import clean_sequence, mark_oversized, unknown_directions
from turnstile.operators.stays import (
    day_spans,
    flag_stays,
    impute_facility,
    impute_orphans,
    number_pairs,
    orphans,
    pair_stays,
    split_stays,
    unpaired,
)
from turnstile.plans import jobs

__all__ = [
    "anomaly_stats",
    "balanced_groups",
    "batch_bounds",
    "batch_members",
    "batch_ranges",
    "clean_sequence",
    "day_spans",
    "distinct_values",
    "duration_profile",
    "eid_daily",
    "eid_month_counts",
    "enrich_badges",
    "expand_hours",
    "flag_stays",
    "hourly_occupancy",
    "impute_facility",
    "impute_orphans",
    "in_batch",
    "in_months",
    "jobs",
    "keep_first",
    "keep_unique",
    "mark_oversized",
    "month_max",
    "month_range",
    "normalise_badges",
    "normalise_rows",
    "number_pairs",
    "orphan_counts",
    "orphans",
    "pair_stays",
    "peak_rollup",
    "peak_totals",
    "processing_months",
    "quality_profile",
    "quality_rollup",
    "retain",
    "round_hours",
    "split_by",
    "split_stays",
    "unknown_directions",
    "unpaired",
]
