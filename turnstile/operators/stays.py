"""From cleaned swipes to stays: pairing, facility imputation, splitting at midnight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.functions import clock
from turnstile.schemas import PERSON

# Minutes from which a stay is overly long, and minutes given to an
# orphan swipe.
LONG_STAY_MINUTES = 720
ORPHAN_MINUTES = 60

# Order in which rows for the same person, facility and hour take precedence.
SAME_DAY, SECOND_DAY, FIRST_DAY, ORPHAN, LONG_IN, LONG_OUT = range(6)


def is_orphan() -> Column:
    """A leading `out` or a trailing `in`."""
    return ((F.col("direction") == "out") & (F.col("First_Tag") == 1)) | (
        (F.col("direction") == "in") & (F.col("Last_Tag") == 1)
    )


def orphans(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(is_orphan()).select(
        *PERSON, "Facility", "direction", "localtimestamp", "index_value"
    )


def impute_facility(cleaned: DataFrame) -> DataFrame:
    """Give each `out` the facility of the `in` before it; flag it if it was another one."""
    moved = (F.col("direction") == "out") & ~F.col("Facility").eqNullSafe(F.col("partner_Facility"))
    return cleaned.where(~is_orphan()).select(
        *PERSON,
        F.when(moved, F.col("partner_Facility")).otherwise(F.col("Facility")).alias("Facility"),
        F.col("Facility").alias("Original Facility"),
        "direction",
        "localtimestamp",
        moved.cast("int").alias("Tag_Anomalous"),
        "index_value",
    )


def _is_pair() -> Column:
    return (
        (F.col("direction") == "in")
        & ~is_orphan()
        & F.col("localtimestamp").isNotNull()
        & F.col("partner_ts").isNotNull()
    )


def pair_stays(cleaned: DataFrame) -> DataFrame:
    """One row per stay. The partner of each `in` is already at hand, so nothing is shuffled."""
    return cleaned.where(_is_pair()).select(
        *PERSON,
        "Facility",
        F.col("localtimestamp").alias("time_in"),
        F.col("partner_ts").alias("time_out"),
        (F.col("partner_Facility") != F.col("Facility")).cast("int").alias("Tag_Anomalous"),
        "index_value",
    )


def unpaired(cleaned: DataFrame) -> DataFrame:
    """Rows of pairs that lack a timestamp; they belong to no stay."""
    incomplete = F.col("localtimestamp").isNull() | F.col("partner_ts").isNull()
    return cleaned.where(~is_orphan() & incomplete).select(
        *PERSON, "Facility", "direction", "localtimestamp", "index_value"
    )


def number_pairs(stays: DataFrame) -> DataFrame:
    """Pair numbers 1, 3, 5, … per person.

    Counted in two steps, within each hour and over the hours, so that the first
    window is as small as an hour and the second as short as a month has hours.
    """
    sliced = stays.withColumn("hour", clock.floor_hour(F.col("time_in")))
    offsets = (
        sliced.groupBy(*PERSON, "hour")
        .agg(F.count("*").alias("n"))
        .withColumn(
            "earlier",
            F.coalesce(
                F.sum("n").over(
                    Window.partitionBy(*PERSON)
                    .orderBy("hour")
                    .rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("n")
    )
    within = F.row_number().over(Window.partitionBy(*PERSON, "hour").orderBy("time_in"))
    return (
        sliced.withColumn("within", within)
        .join(offsets, [*PERSON, "hour"])
        .withColumn("Pair", (F.col("earlier") + F.col("within")) * 2 - 1)
        .drop("hour", "within", "earlier")
    )


def flag_stays(stays: DataFrame) -> DataFrame:
    """Days touched, length, and the flags for overly long and for doubtful stays."""
    length = clock.stay_minutes(F.col("time_in"), F.col("time_out"))
    overlong = F.col("duration_mins_v2") >= LONG_STAY_MINUTES
    return (
        stays.withColumn("day_diff", F.datediff("time_out", "time_in"))
        .withColumn("duration_mins_v2", length)
        .withColumn("Tag_OverlyLongStay", overlong.cast("int"))
        .withColumn("Tag_Final", ((F.col("Tag_Anomalous") == 1) | overlong).cast("int"))
    )


def _visits(cleaned: DataFrame) -> DataFrame:
    """Stays and orphans side by side, from one pass over the cleaned rows.

    An orphan has its one swipe as `time_in` or `time_out`.
    """
    orphan, is_in = is_orphan(), F.col("direction") == "in"
    return flag_stays(
        cleaned.where(orphan | _is_pair()).select(
            *PERSON,
            "Facility",
            orphan.alias("orphan"),
            F.when(is_in, F.col("localtimestamp")).alias("time_in"),
            F.when(is_in & ~orphan, F.col("partner_ts"))
            .when(~is_in, F.col("localtimestamp"))
            .alias("time_out"),
            F.when(orphan, 1)
            .otherwise((F.col("partner_Facility") != F.col("Facility")).cast("int"))
            .alias("Tag_Anomalous"),
            "index_value",
        )
    ).withColumns(
        {
            "Tag_OverlyLongStay": F.when(F.col("orphan"), 0).otherwise(F.col("Tag_OverlyLongStay")),
            "Tag_Final": F.when(F.col("orphan"), 1).otherwise(F.col("Tag_Final")),
        }
    )


def _span(order: int, start: Column, end: Column) -> Column:
    fixed = order in (ORPHAN, LONG_IN, LONG_OUT)
    length = F.lit(ORPHAN_MINUTES).cast("bigint") if fixed else clock.stay_minutes(start, end)
    return F.struct(
        F.lit(order).alias("precedence"),
        start.alias("time_in"),
        end.alias("time_out"),
        length.alias("duration_mins"),
    )


def day_spans(cleaned: DataFrame) -> DataFrame:
    """All presence rows of the month: each lies within a day or is a one-hour stand-in.

    A stay within one day is kept, a stay over one midnight becomes two rows, and
    of a longer one only the two end swipes count, like orphans: an hour from an
    `in`, an hour up to an `out`.
    """
    t_in, t_out = F.col("time_in"), F.col("time_out")
    hour = clock.minutes(ORPHAN_MINUTES)
    spans = (
        F.when(
            F.col("orphan"),
            F.array(
                _span(
                    ORPHAN, F.coalesce(t_in, t_out - hour), F.coalesce(t_out, t_in + hour)
                )
            ),
        )
        .when(F.col("day_diff") == 0, F.array(_span(SAME_DAY, t_in, t_out)))
        .when(
            F.col("day_diff") == 1,
            F.array(
                _span(SECOND_DAY, clock.at_minute(t_out, clock.DAY_START), t_out),
                _span(FIRST_DAY, t_in, clock.at_minute(t_in, clock.DAY_END)),
            ),
        )
        .otherwise(
            F.array(
                _span(LONG_IN, t_in, t_in + hour),
                _span(LONG_OUT, t_out - hour, t_out),
            )
        )
    )
    return (
        _visits(cleaned)
        .select(
            *PERSON,
            "Facility",
            F.coalesce(t_in, t_out).alias("visit_start"),
            "Tag_Anomalous",
            "Tag_OverlyLongStay",
            "Tag_Final",
            "index_value",
            F.explode(spans).alias("span"),
        )
        .select("*", "span.*")
        .drop("span")
        .where(F.col("duration_mins") > 0)
    )


def split_stays(spans: DataFrame) -> DataFrame:
    """The rows of stays that touch at most two days."""
    return spans.where(F.col("precedence") <= FIRST_DAY)


def impute_orphans(spans: DataFrame) -> DataFrame:
    """The one-hour rows made from orphans and from the ends of longer stays."""
    return spans.where(F.col("precedence") >= ORPHAN)
