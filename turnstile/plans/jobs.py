"""The monthly run: group people, attach groups and doors, build detail and summary tables.

Each step reads and writes tables partitioned by month. A month is always written
as a whole, so a step that is repeated, or restarted after a failure, leaves the
same tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile import schemas
from turnstile.operators import (
    enrich,
    grouping,
    months,
    normalise,
    occupancy,
    quality,
    rollup,
    sequence,
    stays,
)
from turnstile.sources import tables as io


# Cleaned swipes are bucketed by person within month folders (a bucket column cannot be a folder column).
PERSON_BUCKETS = ("Group", "eid")


@dataclass(frozen=True)
class Tables:
    """Table names of a run."""

    date_range: str = "date_range"
    eid_ranges: str = "eid_ranges"
    eid_groups: str = "eid_groups"
    grouped_badges: str = "grouped_badges"
    clean_swipes: str = "clean_swipes"
    eid_daily: str = "eid_daily"
    peak_util: str = "peak_util"
    data_quality: str = "data_quality"
    peak_util_summary: str = "peak_util_summary"
    data_quality_summary: str = "data_quality_summary"
    rejected: str = "rejected"

    def working(self) -> tuple[str, ...]:
        return (
            self.date_range,
            self.eid_ranges,
            self.eid_groups,
            self.grouped_badges,
            self.clean_swipes,
        )


def group_badges(
    badges: DataFrame,
    doors: DataFrame,
    month_list: Iterable[dt.date],
    capacity: int = grouping.GROUP_CAPACITY,
    names: Tables = Tables(),
) -> None:
    """Months, groups of people, and badges with group and door."""
    spark, dates = badges.sparkSession, sorted(set(month_list))
    io.overwrite(_date_range(spark, dates), names.date_range)
    listed = badges.where(F.col("month").isin(dates))

    def hold(df: DataFrame) -> DataFrame:
        io.overwrite(df, names.eid_ranges)
        return spark.table(names.eid_ranges)

    groups = grouping.balanced_groups(grouping.eid_month_counts(listed), capacity, hold)
    io.overwrite(groups, names.eid_groups, "month")
    grouped = enrich.enrich_badges(listed, spark.table(names.eid_groups), doors, capacity)
    # Oversized people get their own folders, which the pass over them alone reads. Files hold ranges of groups,
    # sorted, so that a range of groups skips the others. No buckets here: the person key is the normalised eid,
    # made when the rows are read.
    io.overwrite(grouped, names.grouped_badges, "month", "oversized", cluster_by=("Group", "eid"))


def build_detail(spark: SparkSession, frequency: str, names: Tables = Tables()) -> None:
    """Cleaned swipes, the three detail tables and the rejected rows for the listed months.

    The cleaned swipes are written once and feed all of them.
    """
    dates = _dates(spark, names)
    badges = spark.table(names.grouped_badges)
    rows = normalise.normalise_rows(badges)
    cleaned = sequence.clean_sequence(rows)
    # Ordinary people leave the cleaning dealt by bucket already; the detail tables read them without exchange.
    io.overwrite(cleaned, names.clean_swipes, "month", bucket_by=PERSON_BUCKETS, shuffle=False)

    cleaned = spark.table(names.clean_swipes)
    rejected = quality.rejected(rows, cleaned).withColumnRenamed("month", "Month")
    spans = stays.day_spans(cleaned)
    masks = occupancy.day_masks(occupancy.round_hours(spans))
    details = {
        names.eid_daily: occupancy.eid_daily(spans),
        names.peak_util: occupancy.occupancy_from_masks(masks),
        names.data_quality: quality.quality_profile(cleaned),
        names.rejected: rejected,
    }
    for table, detail in details.items():
        expire_months(spark, table, dates, frequency)
        # Rows per person are many and leave an exchange in good sizes; the others are few.
        io.replace_months(detail, table, dates, compact=table != names.eid_daily)


def build_summaries(spark: SparkSession, frequency: str, names: Tables = Tables()) -> None:
    """Roll-ups over groups for the listed months; working tables are dropped afterwards."""
    dates = _dates(spark, names)
    # the months as literals: the detail tables are read in the listed month folders only
    summaries = {
        names.data_quality_summary: rollup.quality_rollup(spark.table(names.data_quality), dates),
        names.peak_util_summary: rollup.peak_rollup(spark.table(names.peak_util), dates),
    }
    for table, summary in summaries.items():
        expire_months(spark, table, dates, frequency)
        io.replace_months(summary, table, dates)
    io.drop_tables(spark, *names.working())


def expire_months(
    spark: SparkSession, table: str, dates: list[dt.date], frequency: str
) -> None:
    """Retention on a month-partitioned table: whole partitions are dropped, nothing is rewritten."""
    if not spark.catalog.tableExists(table):
        return
    present = io.table_months(spark, table)
    rows = spark.createDataFrame([(m,) for m in present], "Month date")
    kept = {r.Month for r in months.retain(rows, _date_range(spark, dates), frequency).collect()}
    io.drop_months(spark, table, [m for m in present if m not in kept])


def run(
    badges: DataFrame,
    doors: DataFrame,
    date_list: str = "",
    frequency: str = "Monthly",
    today: dt.date | None = None,
    capacity: int = grouping.GROUP_CAPACITY,
    names: Tables = Tables(),
) -> list[dt.date]:
    """A whole run; returns the months it processed."""
    listed = months.processing_months(badges, date_list, frequency, today)
    dates = sorted(r.date for r in listed.collect())
    group_badges(badges, doors, dates, capacity, names)
    build_detail(badges.sparkSession, frequency, names)
    build_summaries(badges.sparkSession, frequency, names)
    return dates


def _date_range(spark: SparkSession, dates: Iterable[dt.date]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in dates], schemas.DATE_RANGE)


def _dates(spark: SparkSession, names: Tables) -> list[dt.date]:
    return sorted(r.date for r in spark.table(names.date_range).collect())
