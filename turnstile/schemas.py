"""Table schemas, key columns and metric names."""

from __future__ import annotations

from pyspark.sql import types as T

# A person's swipes are processed per month and group; this is the sequence key.
PERSON = ("month", "Group", "eid")

BADGES = T.StructType(
    [
        T.StructField("eid", T.StringType()),
        T.StructField("localtimestamp", T.TimestampNTZType()),
        T.StructField("direction", T.StringType()),
        T.StructField("messagetype", T.StringType()),
        T.StructField("rank", T.LongType()),
        T.StructField("month", T.DateType()),
        T.StructField("index_value", T.LongType()),
    ]
)

DOORS = T.StructType(
    [T.StructField("rank", T.LongType()), T.StructField("Door", T.StringType())]
)

# Badges after enrichment: `rank` replaced by the door name and the group.
# `oversized` marks people with more swipes in the month than a group may hold.
ENRICHED = T.StructType(
    [f for f in BADGES.fields if f.name != "rank"]
    + [
        T.StructField("Group", T.LongType()),
        T.StructField("door", T.StringType()),
        T.StructField("oversized", T.BooleanType()),
    ]
)

EID_GROUPS = T.StructType(
    [
        T.StructField("eid", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("Cumulative_Sum", T.LongType()),
        T.StructField("Group", T.LongType()),
        T.StructField("month", T.DateType()),
    ]
)

DATE_RANGE = T.StructType([T.StructField("date", T.DateType())])

# --- fixed values: quality metric names -------------------------------------
ANOMALOUS_PAIRS = "TotalPairsOfAnomalousBadges_AfterFloorImputation"
TOTAL_BADGES = "TotalBadges_AfterFloorImputation"
ORPHAN_BADGES = "No of orphan badges"
ALL_PAIRS = "All pairs of badges"
HALF_HOUR_MINUTES = 30
FIRST_HOUR = 8
LAST_HOUR = 48
# ----------------------------------------------------------------------------


def duration_buckets() -> list[str]:
    """Bucket names without the anomaly suffix, in profile order."""
    hours = [f"{h}hrTo{h + 1}hrPairsOfBadges" for h in range(FIRST_HOUR, LAST_HOUR + 1)]
    return [
        f"{HALF_HOUR_MINUTES}minsPairsOfBadges",
        *hours,
        f"MoreThan{LAST_HOUR + 1}HourPairsOfBadges",
    ]


def duration_metrics() -> list[str]:
    return [f"{b}_{s}" for b in duration_buckets() for s in ("NotAnomalous", "Anomalous")]


def quality_metrics() -> list[str]:
    return [ANOMALOUS_PAIRS, TOTAL_BADGES, ORPHAN_BADGES, ALL_PAIRS, *duration_metrics()]
