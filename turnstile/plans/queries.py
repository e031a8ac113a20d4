"""Named queries over the test tables, one per operator."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions import clock, text
from turnstile.operators import (
    dedup,
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
from turnstile.schemas import BADGES
from turnstile.session import ensure_checkpoint_dir
from turnstile.sources import badge_view as view
from turnstile.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

MONTH = dt.date(2024, 1, 1)
BUSY = 70  # swipes per month from which the checks treat a person as oversized
EVENT_CAPACITY = 1_000
ORDER_CAPACITY = 20
LISTED_FROM = dt.date(2001, 7, 1)


# --- building blocks ---------------------------------------------------------


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalise.normalise_rows(view.grouped_badges(spark, sf))
    return sequence.clean_sequence(sequence.mark_oversized(rows, BUSY))


def _flawed(spark: SparkSession, sf: str) -> DataFrame:
    return normalise.normalise_rows(view.flawed_badges(spark, sf))


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    return stays.day_spans(_cleaned(spark, sf))


def _hourly(spans: DataFrame) -> DataFrame:
    return occupancy.occupancy_from_masks(occupancy.day_masks(occupancy.round_hours(spans)))


def _order_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalise.normalise_rows(view.order_swipes(spark, sf))
    return sequence.clean_sequence(sequence.mark_oversized(rows, BUSY))


def _order_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return _hourly(stays.day_spans(_order_cleaned(spark, sf)))


def _order_counts(spark: SparkSession, sf: str) -> DataFrame:
    return grouping.eid_month_counts(view.order_badges(spark, sf))


def _order_bounds(spark: SparkSession, sf: str) -> DataFrame:
    per_month = view.order_badges(spark, sf).groupBy("month").agg(F.count("*").alias("Group"))
    return grouping.batch_bounds(per_month, "Group")


def _listed(spark: SparkSession, sf: str) -> DataFrame:
    """The months from LISTED_FROM on, as a date range table."""
    rows = view.order_badges(spark, sf)
    return rows.where(F.col("month") >= F.lit(LISTED_FROM)).select(F.col("month").alias("date"))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    raw = view.raw_badges(spark, sf)
    groups = grouping.balanced_groups(grouping.eid_month_counts(raw), EVENT_CAPACITY)
    return enrich.enrich_badges(raw, groups, view.doors(spark), EVENT_CAPACITY)


def _enriched_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return sequence.clean_sequence(normalise.normalise_rows(_enriched(spark, sf)))


# --- queries -----------------------------------------------------------------


def badge_rows(spark, sf):
    return view.badges(spark, sf)


def month_range_scan(spark, sf):
    rows = view.grouped_badges(spark, sf)
    # Further sort columns let the range partitioning cut a large group.
    return enrich.month_range(rows, MONTH, "Group", 2, 3).orderBy(
        "Group", "index_value", "localtimestamp"
    )


def month_range_stored(spark, sf):
    """month_range_scan on grouped badges stored as the job stores them: files by range of Group."""

    def steps(rows, table):
        tables.overwrite(rows, table, "month", "oversized", cluster_by=("Group", "eid"))

    rows = view.grouped_badges(spark, sf).withColumn("oversized", F.lit(False))
    return _sink(spark, sf, steps, rows, lambda stored: enrich.month_range(stored.drop("oversized"), MONTH, "Group", 2, 3))


def month_max_index(spark, sf):
    return grouping.month_max(view.order_badges(spark, sf), "index_value")


def batch_bounds(spark, sf):
    return grouping.batch_bounds(month_max_index(spark, sf), "index_value")


def batch_ranges(spark, sf):
    return grouping.batch_ranges(_order_bounds(spark, sf))


def batch_members(spark, sf):
    return grouping.batch_members(batch_ranges(spark, sf))


def in_batch(spark, sf):
    rows = view.grouped_badges(spark, sf)
    bounds = grouping.batch_bounds(grouping.month_max(rows, "Group"), "Group")
    return enrich.in_batch(rows, grouping.batch_ranges(bounds), "Group", 2)


def eid_month_counts(spark, sf):
    return _order_counts(spark, sf)


def balanced_groups(spark, sf):
    return grouping.balanced_groups(_order_counts(spark, sf), ORDER_CAPACITY)


def balanced_groups_small(spark, sf):
    """A capacity below most counts: people above it stand alone."""
    return grouping.balanced_groups(grouping.eid_month_counts(view.badges(spark, sf)), BUSY)


def enrich_badges(spark, sf):
    return _enriched(spark, sf)


def normalise_badges(spark, sf):
    return normalise.normalise_badges(view.grouped_badges(spark, sf))


def door_names(spark, sf):
    return view.grouped_badges(spark, sf)


def text_functions(spark, sf):
    rows = view.grouped_badges(spark, sf)
    return rows.select(
        "index_value",
        text.person_id(F.col("eid")).alias("eid"),
        text.direction(F.col("direction")).alias("direction"),
        text.facility(F.col("door")).alias("Facility"),
    )


def clock_functions(spark, sf):
    ts = F.col("localtimestamp")
    return view.order_swipes(spark, sf).select(
        "index_value",
        clock.floor_minute(ts).alias("minute"),
        clock.floor_hour(ts).alias("hour"),
        clock.nearest_hour(ts).alias("nearest_hour"),
        clock.off_midnight(ts, F.lit("in")).alias("moved_in"),
        clock.off_midnight(ts, F.lit("out")).alias("moved_out"),
        clock.at_minute(ts, clock.DAY_END).alias("day_end"),
        clock.stay_minutes(clock.at_minute(ts, clock.DAY_START), ts).alias("minutes"),
        clock.time_text(ts).alias("time"),
        clock.time_group(ts).alias("time_group"),
        clock.month_start(ts).alias("month"),
    )


def keep_unique(spark, sf):
    rows = normalise_badges(spark, sf).select(
        "month", "Group", "Facility", "eid", "direction", "DateOnly", "index_value"
    )
    return dedup.keep_unique(rows, ["month", "Group", "Facility", "eid", "direction", "DateOnly"])


def keep_first(spark, sf):
    rows = normalise_badges(spark, sf).select(
        "month", "Group", "Facility", "eid", "localtimestamp", "direction", "index_value"
    )
    return dedup.keep_first(rows, ["month", "Group", "Facility", "eid"], ["localtimestamp"])


def dedup_runs(spark, sf):
    return _cleaned(spark, sf).select(
        "month", "Group", "eid", "localtimestamp", "direction", "Facility", "index_value"
    )


def first_last_tags(spark, sf):
    return _cleaned(spark, sf).drop("partner_ts", "partner_Facility")


def orphans(spark, sf):
    return stays.orphans(_cleaned(spark, sf))


def orphan_split(spark, sf):
    """Sizes of the two sides of the orphan condition."""
    side = F.when(stays.is_orphan(), "orphan").otherwise("rest")
    return _cleaned(spark, sf).groupBy(side.alias("side")).agg(F.count("*").alias("n"))


def impute_facility(spark, sf):
    return stays.impute_facility(_cleaned(spark, sf))


def pair_stays(spark, sf):
    return stays.pair_stays(_cleaned(spark, sf))


def number_pairs(spark, sf):
    return stays.number_pairs(pair_stays(spark, sf))


def flag_stays(spark, sf):
    return stays.flag_stays(pair_stays(spark, sf))


def split_stays(spark, sf):
    return stays.split_stays(_spans(spark, sf)).drop("visit_start")


def impute_orphans(spark, sf):
    return stays.impute_orphans(_spans(spark, sf)).drop("visit_start")


def eid_daily(spark, sf):
    return occupancy.eid_daily(_spans(spark, sf))


def round_hours(spark, sf):
    return occupancy.round_hours(_spans(spark, sf)).drop("visit_start")


def expand_hours(spark, sf):
    return occupancy.expand_hours(occupancy.round_hours(_spans(spark, sf)))


def hourly_occupancy(spark, sf):
    return _hourly(_spans(spark, sf))


def anomaly_stats(spark, sf):
    return quality.anomaly_stats(impute_facility(spark, sf))


def orphan_counts(spark, sf):
    return quality.orphan_counts(orphans(spark, sf))


def duration_profile(spark, sf):
    return quality.duration_profile(_cleaned(spark, sf))


def quality_profile(spark, sf):
    return quality.quality_profile(_cleaned(spark, sf))


def quality_rollup(spark, sf):
    profile = quality.quality_profile(_order_cleaned(spark, sf))
    return rollup.quality_rollup(profile, _listed(spark, sf))


def peak_rollup(spark, sf):
    return rollup.peak_rollup(_order_hourly(spark, sf), _listed(spark, sf))


def peak_totals(spark, sf):
    return rollup.peak_totals(_order_hourly(spark, sf))


def in_months(spark, sf):
    return months.in_months(_order_counts(spark, sf), _listed(spark, sf), "month")


def retain_weekly(spark, sf):
    return months.retain(_order_hourly(spark, sf), _listed(spark, sf), "Weekly")


def retain_monthly(spark, sf):
    return months.retain(_order_hourly(spark, sf), _listed(spark, sf), "Monthly")


def weekly_refresh(spark, sf):
    """An hourly table after a weekly run: what is kept, plus the listed months anew."""
    return months.refreshed(_order_hourly(spark, sf), _listed(spark, sf))


def processing_months_weekly(spark, sf):
    rows = view.order_badges(spark, sf)
    day_four = F.date_add(rows.agg(F.max("month")).scalar(), 3)
    return months.processing_months(rows, "", "Weekly", day_four)


def processing_months_empty(spark, sf):
    """Weekly, at the start of a month that has no rows yet."""
    rows = view.order_badges(spark, sf)
    next_month = F.add_months(rows.agg(F.max("month")).scalar(), 1)
    return months.processing_months(rows, "", "Weekly", F.date_add(next_month, 4))


def processing_months_monthly(spark, sf):
    rows = view.order_badges(spark, sf)
    return months.processing_months(rows, "", "Monthly", rows.agg(F.max("month")).scalar())


def processing_months_listed(spark, sf):
    """A list as text with blanks and an empty item, made from the months of the table."""
    rows = view.order_badges(spark, sf)
    newest = rows.agg(F.max("month").alias("m")).first()["m"]  # one value
    return months.processing_months(rows, f" {newest.isoformat()}, ,1999-02-01 ", "Weekly")


def text_timestamps(spark, sf):
    """Timestamps as text, some of them no timestamps."""
    ts = view.timestamp_texts(spark, sf)
    return ts.select("event_id", clock.parse(F.col("text"), T.StringType()).alias("ts"))


def complement_split(spark, sf):
    """Both sides of a condition that is sometimes null, in numbers per month."""
    met, rest = dedup.split_by(view.badges(spark, sf), F.col("direction") == "In")
    both = met.withColumn("met", F.lit(True)).unionByName(rest.withColumn("met", F.lit(False)))
    return both.groupBy("month", "met").agg(F.count("*").alias("n"))


def unknown_directions(spark, sf):
    return sequence.unknown_directions(_flawed(spark, sf)).select(
        "month", "Group", "eid", "direction", "Facility", "index_value"
    )


def rejected_rows(spark, sf):
    rows = _flawed(spark, sf)
    return quality.rejected(rows, sequence.clean_sequence(rows)).groupBy("month", "reason").agg(F.count("*").alias("n"))


def _sink(spark, sf, steps, rows: DataFrame | None = None, then=lambda df: df) -> DataFrame:
    """Run steps on a new table of the session catalog (order counts unless rows are given), apply `then` to what
    the table holds, and return that from a copy in the shared checkpoint folder; the table is dropped."""
    table = f"turnstile_sink_{uuid.uuid4().hex[:12]}"
    try:
        steps(_order_counts(spark, sf) if rows is None else rows, table)
        result = then(tables.read_table(spark, table))
        ensure_checkpoint_dir(spark)
        path = f"{spark.sparkContext.getCheckpointDir()}/sink-{uuid.uuid4().hex}"
        result.write.parquet(path)
    finally:
        tables.drop_tables(spark, table)
    return spark.read.schema(result.schema).parquet(path)


def overwritten(spark, sf):
    def steps(counts, table):
        tables.overwrite(counts.limit(1), table)
        tables.overwrite(counts, table, "month", compact=True)

    return _sink(spark, sf, steps)


def appended(spark, sf):
    def steps(counts, table):
        tables.append(counts, table)
        tables.append(counts.select("month", "count", "eid"), table)

    return _sink(spark, sf, steps)


def appended_query(spark, sf):
    def steps(counts, table):
        tables.append(counts, table)
        largest = f"SELECT eid, month, `count` + 1 AS `count` FROM {table} WHERE `count` > 1"
        tables.append_query(spark, largest, table)

    return _sink(spark, sf, steps)


def appended_batches(spark, sf):
    """Batch b1 twice, then b2 of the busier rows: b1 is there once."""

    def steps(counts, table):
        first = counts.withColumn("batch_id", F.lit("b1"))
        for _ in range(2):
            tables.append_batches(first, table)
        busy = counts.where(F.col("count") > 1).withColumn("batch_id", F.lit("b2"))
        tables.append_batches(busy.unionByName(first), table)

    return _sink(spark, sf, steps)


def months_replaced(spark, sf):
    """Twice the same months, one of which has no new rows."""

    def steps(counts, table):
        tables.replace_months(counts, table, [], "month")
        listed = [r["date"] for r in _listed(spark, sf).distinct().collect()]  # at most a few months
        fewer = months.in_months(counts, _listed(spark, sf), "month").where(F.col("month") < F.lit(max(listed)))
        for _ in range(2):
            tables.replace_months(fewer.withColumn("count", F.col("count") * 10), table, listed, "month")

    return _sink(spark, sf, steps)


def dropped(spark, sf):
    """A table that is dropped twice and made anew has only the new rows."""

    def steps(counts, table):
        tables.append(counts, table)
        tables.drop_tables(spark, table, table)
        tables.append(counts.where("`count` > 1"), table)

    return _sink(spark, sf, steps)


def quarantine_counts(spark, sf):
    """Landing rows checked against the badge schema: typed rows as `ok`, the others by reason."""
    rows = tables.checked(view.badge_texts(spark, sf), BADGES, ("eid", "localtimestamp", "direction"))
    return rows.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


def queried(spark, sf):
    name = f"turnstile_counts_{uuid.uuid4().hex[:12]}"
    _order_counts(spark, sf).createOrReplaceTempView(name)
    try:
        # the query is resolved when it is made, so the view can go at once
        return tables.query(spark, f"SELECT month, sum(`count`) AS n FROM {name} GROUP BY month")
    finally:
        spark.catalog.dropTempView(name)


def distinct_values(spark, sf):
    return dedup.distinct_values(view.badges(spark, sf), "eid")


def monthly_eid_daily(spark, sf):
    return occupancy.eid_daily(stays.day_spans(_enriched_cleaned(spark, sf)))


def monthly_peak_util(spark, sf):
    return _hourly(stays.day_spans(_enriched_cleaned(spark, sf)))


def monthly_data_quality(spark, sf):
    return quality.quality_profile(_enriched_cleaned(spark, sf))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        badge_rows,
        month_range_scan,
        month_range_stored,
        month_max_index,
        batch_bounds,
        batch_ranges,
        batch_members,
        in_batch,
        eid_month_counts,
        balanced_groups,
        balanced_groups_small,
        enrich_badges,
        normalise_badges,
        door_names,
        text_functions,
        clock_functions,
        keep_unique,
        keep_first,
        dedup_runs,
        first_last_tags,
        orphans,
        orphan_split,
        impute_facility,
        pair_stays,
        number_pairs,
        flag_stays,
        split_stays,
        impute_orphans,
        eid_daily,
        round_hours,
        expand_hours,
        hourly_occupancy,
        anomaly_stats,
        orphan_counts,
        duration_profile,
        quality_profile,
        quality_rollup,
        peak_rollup,
        peak_totals,
        in_months,
        retain_weekly,
        retain_monthly,
        weekly_refresh,
        processing_months_weekly,
        processing_months_empty,
        processing_months_monthly,
        processing_months_listed,
        text_timestamps,
        complement_split,
        unknown_directions,
        rejected_rows,
        overwritten,
        appended,
        appended_query,
        appended_batches,
        months_replaced,
        dropped,
        queried,
        quarantine_counts,
        distinct_values,
        monthly_eid_daily,
        monthly_peak_util,
        monthly_data_quality,
    )
}
