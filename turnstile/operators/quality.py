"""Badge data-quality profile per facility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile import schemas as S
from turnstile.functions import clock
from turnstile.operators import sequence, stays
from turnstile.operators.stays import _is_pair, is_orphan, pair_stays

_CELL = ("month", "Group", "Facility")
_HOUR = 60


def anomaly_stats(imputed: DataFrame) -> DataFrame:
    """Swipes and doubtful swipes per facility, after facility imputation."""
    return imputed.groupBy(*_CELL).agg(
        F.sum("Tag_Anomalous").alias(S.ANOMALOUS_PAIRS), F.count("*").alias(S.TOTAL_BADGES)
    )


def orphan_counts(orphan_rows: DataFrame) -> DataFrame:
    return orphan_rows.groupBy(*_CELL).agg(F.count("*").alias(S.ORPHAN_BADGES))


def duration_metric(minutes: Column, anomalous: Column) -> Column:
    """Name of the duration metric a stay counts for, or null."""
    hour = F.call_function("div", minutes, F.lit(_HOUR)).cast("int")
    after = S.LAST_HOUR + 1
    bucket = (
        F.when(minutes == S.HALF_HOUR_MINUTES, F.lit(f"{S.HALF_HOUR_MINUTES}minsPairsOfBadges"))
        .when(minutes >= after * _HOUR, F.lit(f"MoreThan{after}HourPairsOfBadges"))
        .when(
            minutes >= S.FIRST_HOUR * _HOUR,
            F.concat(hour, F.lit("hrTo"), hour + 1, F.lit("hrPairsOfBadges")),
        )
    )
    return F.concat(bucket, F.when(anomalous == 1, F.lit("_Anomalous")).otherwise("_NotAnomalous"))


def duration_profile(cleaned: DataFrame) -> DataFrame:
    """Stays per facility: all of them, and by length and anomaly."""
    stays = pair_stays(cleaned).withColumn(
        "metric",
        duration_metric(
            clock.stay_minutes(F.col("time_in"), F.col("time_out")), F.col("Tag_Anomalous")
        ),
    )
    counted = stays.groupBy(*_CELL, "metric").agg(F.count("*").alias("n"))
    return _pivot(
        counted,
        {S.ALL_PAIRS: F.col("n"), None: F.col("n")},
        [S.ALL_PAIRS, *S.duration_metrics()],
    )


def rejected(rows: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Normalised rows that take no part in stays: foreign directions, and pairs that lack a time."""
    columns = ("month", "Group", "eid", "Facility", "direction", "localtimestamp", "index_value")
    foreign = sequence.unknown_directions(rows).select(*columns, F.lit("direction").alias("reason"))
    incomplete = stays.unpaired(cleaned).select(*columns, F.lit("time").alias("reason"))
    return foreign.unionByName(incomplete)


def quality_profile(cleaned: DataFrame) -> DataFrame:
    """All 90 metrics per facility and group.

    One aggregate over the cleaned rows counts everything by facility and
    duration metric. What it leaves is a few hundred rows per facility and group,
    and only those are pivoted.
    """
    orphan, pair = is_orphan(), _is_pair()
    is_out = F.col("direction") == "out"
    moved = is_out & ~orphan & (F.col("Facility") != F.col("partner_Facility"))
    length = clock.stay_minutes(F.col("localtimestamp"), F.col("partner_ts"))
    anomalous = (F.col("Facility") != F.col("partner_Facility")).cast("int")
    counted = (
        cleaned.select(
            "month",
            "Group",
            F.when(moved, F.col("partner_Facility")).otherwise(F.col("Facility")).alias("Facility"),
            F.when(pair, duration_metric(length, anomalous)).alias("metric"),
            pair.alias("pair"),
            orphan.alias("orphan"),
            moved.alias("moved"),
        )
        .groupBy(*_CELL, "metric")
        .agg(
            F.count("*").alias("n"),
            F.count_if("pair").alias("pairs"),
            F.count_if("orphan").alias("orphans"),
            F.count_if("moved").alias("moved"),
        )
    )
    profile = _pivot(
        counted,
        {
            S.ANOMALOUS_PAIRS: F.col("moved"),
            S.TOTAL_BADGES: F.col("n") - F.col("orphans"),
            S.ORPHAN_BADGES: F.col("orphans"),
            S.ALL_PAIRS: F.col("pairs"),
            None: F.col("n"),
        },
        S.quality_metrics(),
    )
    return profile.select("Facility", "Group", *S.quality_metrics(), F.col("month").alias("Month"))


def _pivot(counted: DataFrame, values: dict[str | None, Column], metrics: list[str]) -> DataFrame:
    """Counts to one column per metric; the key None stands for the row's own metric."""
    cells = [
        F.struct(
            (F.col("metric") if name is None else F.lit(name)).alias("name"),
            value.alias("value"),
        )
        for name, value in values.items()
    ]
    return fill_counts(
        counted.select(*_CELL, F.inline(F.array(*cells)))
        .groupBy(*_CELL)
        .pivot("name", metrics)
        .agg(F.sum("value")),
        metrics,
    )


def fill_counts(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Missing counts become 0; counts are `bigint`."""
    return df.withColumns({m: F.coalesce(F.col(f"`{m}`"), F.lit(0)).cast("bigint") for m in metrics})
