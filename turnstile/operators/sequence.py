"""Clean-up of each person's in/out sequence.

The rules look at direct neighbours in time order: of several `out` swipes in a
row the latest counts, of several `in` swipes the earliest. Rows without a
timestamp come last in both directions of time.

People within the capacity of a group are shuffled once, by person; folding of
simultaneous swipes and all windows use that partitioning and one sort. No hash
table holds a task's rows: only the sort does, and it can spill. Two things keep
one busy person from filling a task:

* Swipes of a person marked `oversized` with the same time, direction and
  facility are folded by an aggregate with map-side combine before any window
  runs. This also removes exact copies.
* Such a person is first worked on per minute. Pairs well inside a minute are
  settled there; at most the two first and two last rows of a minute go on to
  the pass over the whole person, which is thereby bounded by the minutes of a
  month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from turnstile.functions import clock
from turnstile.schemas import PERSON

DIRECTIONS = ("in", "out")
_ROW = (*PERSON, "oversized", "localtimestamp", "direction", "Facility", "index_value")


def time_order() -> list[Column]:
    """Time order; ties by direction, index value and facility (rows equal in all are alike)."""
    return [
        F.col("localtimestamp").asc_nulls_last(),
        F.col("direction").asc(),
        F.col("index_value").asc_nulls_last(),
        F.col("Facility").asc(),
    ]


def mark_oversized(badges: DataFrame, capacity: int) -> DataFrame:
    """Flag people with more than `capacity` rows in a month and group.

    Enriched badges already carry the flag; this is for other input. Few people are
    over the capacity, but nothing bounds their number, so Spark chooses the join by
    the measured size; a busy person's rows are on the outer side, which adaptive
    execution splits.
    """
    counts = badges.groupBy(*PERSON).agg(F.count("*").alias("swipes"))
    busy = counts.where(F.col("swipes") > capacity).select(*PERSON, F.lit(True).alias("busy"))
    return (
        badges.join(busy, list(PERSON), "left")
        .withColumn("oversized", F.coalesce("busy", F.lit(False)))
        .drop("busy")
    )


def fold_simultaneous(badges: DataFrame) -> DataFrame:
    """One row per person, time, direction and facility.

    Swipes of one direction at one time are neighbours, so run removal would keep
    the first `in` and the last `out` of them anyway.
    """
    return (
        badges.where(F.col("direction").isin(*DIRECTIONS))
        .groupBy(*_ROW[:-1])
        .agg(F.min("index_value").alias("first_index"), F.max("index_value").alias("last_index"))
        .select(
            *_ROW[:-1],
            F.when(F.col("direction") == "in", F.col("first_index"))
            .otherwise(F.col("last_index"))
            .alias("index_value"),
        )
    )


def first_of_moment(badges: DataFrame) -> DataFrame:
    """One row per person, time and direction: of those `fold_simultaneous` leaves, the first `in` or last `out`.

    The others are neighbours of it that run removal would drop. Windows over sorted rows take the place of an
    aggregate, so the rows leave in the order of `moment_order`, which the windows after this one need.
    """
    is_in = F.col("direction") == "in"
    moment = (*PERSON, "untimed", "localtimestamp", "direction")
    same_door, same_moment = Window.partitionBy(*moment, "Facility"), Window.partitionBy(*moment)
    index, row = F.col("index_value"), F.struct(F.col("index_value").isNull(), "index_value", "Facility")
    return (
        badges.where(F.col("direction").isin(*DIRECTIONS))
        .select(*_ROW, F.col("localtimestamp").isNull().alias("untimed"))
        .withColumn("index_value", F.when(is_in, F.min(index).over(same_door)).otherwise(F.max(index).over(same_door)))
        .withColumns(
            {
                "place": F.row_number().over(same_moment.orderBy("Facility")),
                "row": F.when(is_in, F.min(row).over(same_moment)).otherwise(F.max(row).over(same_moment)),
            }
        )
        .where(F.col("place") == 1)
        .select(*_ROW[:-2], "untimed", F.col("row.Facility").alias("Facility"), F.col("row.index_value").alias("index_value"))
    )


def moment_order() -> list[Column]:
    """Time order where a time and direction occur once."""
    return [F.col("untimed").asc(), F.col("localtimestamp").asc(), F.col("direction").asc()]


def drop_runs(rows: DataFrame, *partition: str, order: list[Column] | None = None) -> DataFrame:
    """Keep the earliest of each run of `in` and the latest of each run of `out`."""
    window = Window.partitionBy(*partition).orderBy(*(order or time_order()))
    ts, way = F.col("localtimestamp"), F.col("direction")
    context = rows.withColumns(
        {
            "before": F.lag("direction").over(window),
            "after": F.lead("direction").over(window),
            "after_ts": F.lead("localtimestamp").over(window),
            "opening": F.first(F.struct("direction", "localtimestamp")).over(
                window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        }
    )
    # Backwards in time, rows without timestamp follow the person's first timed row.
    after_is_later = (F.col("after") == "out") & (ts.isNull() == F.col("after_ts").isNull())
    behind_opening = (
        ts.isNull()
        & F.col("opening.localtimestamp").isNotNull()
        & (F.col("opening.direction") == "out")
    )
    extra_out = (way == "out") & (after_is_later | behind_opening)
    extra_in = (way == "in") & (F.col("before") == "in")
    keep = ~F.coalesce(extra_out, F.lit(False)) & ~F.coalesce(extra_in, F.lit(False))
    return context.where(keep).select(*rows.columns)


def _with_neighbours(rows: DataFrame, window: WindowSpec) -> DataFrame:
    """First/last flags and the other swipe of each row's pair.

    The partner of an `in` is the row after it, that of an `out` the row before.
    """
    is_in = F.col("direction") == "in"
    marked = rows.withColumns(
        {
            "before": F.lag("direction").over(window),
            "after": F.lead("direction").over(window),
            "before_swipe": F.lag(F.struct("localtimestamp", "Facility")).over(window),
            "after_swipe": F.lead(F.struct("localtimestamp", "Facility")).over(window),
        }
    )
    partner = F.when(is_in, F.col("after_swipe")).otherwise(F.col("before_swipe"))
    # An `out` right after an `out` is left only where timestamps are missing.
    second_out = (F.col("direction") == "out") & (F.col("before") == "out")
    return marked.where(~F.coalesce(second_out, F.lit(False))).select(
        *rows.columns,
        F.col("before").isNull().cast("int").alias("First_Tag"),
        F.col("after").isNull().cast("int").alias("Last_Tag"),
        partner["localtimestamp"].alias("partner_ts"),
        partner["Facility"].alias("partner_Facility"),
    )


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows by keys, in as many parts as the session shuffles into.

    A number that is given stays: where adaptive execution merges parts by their compressed size, a task's sort grows
    with the input up to millions of rows.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def clean_sequence(badges: DataFrame) -> DataFrame:
    """Alternating in/out rows per person, with first/last flags and each row's partner.

    Ordinary people are dealt by (Group, eid), a part of the person key: the fold and the windows need no
    exchange after this one, and the rows leave dealt as a table bucketed by (Group, eid) stores them.
    """
    flag = F.col("oversized") if "oversized" in badges.columns else F.lit(False)
    badges = badges.withColumn("oversized", F.coalesce(flag, F.lit(False)))
    ordinary = first_of_moment(_dealt(badges.where(~F.col("oversized")), *PERSON[1:]))
    window = Window.partitionBy(*PERSON).orderBy(*moment_order())
    plain = _with_neighbours(drop_runs(ordinary, *PERSON, order=moment_order()), window).drop("untimed")
    return plain.unionByName(_clean_oversized(badges.where("oversized"))).drop("oversized")


def _clean_oversized(badges: DataFrame) -> DataFrame:
    """The same for people marked oversized, by minute and then over what the minutes leave open."""
    slices = fold_simultaneous(badges).withColumn("slice", clock.floor_minute(F.col("localtimestamp")))
    parts = (*PERSON, "slice")
    window = Window.partitionBy(*parts).orderBy(*time_order())
    slices = _dealt(slices, *parts)
    local = _with_neighbours(
        drop_runs(slices, *parts).withColumns(
            {
                "two_before": F.lag("direction", 2).over(window),
                "two_after": F.lead("direction", 2).over(window),
            }
        ),
        window,
    )
    # A pair is settled within its slice if it holds neither the slice's first nor last row.
    settled_in = (F.col("First_Tag") == 0) & F.col("two_after").isNotNull()
    settled_out = (F.col("Last_Tag") == 0) & F.col("two_before").isNotNull()
    settled = F.when(F.col("direction") == "in", settled_in).otherwise(settled_out)

    columns = [c for c in local.columns if c not in ("slice", "two_before", "two_after")]
    inside = local.where(settled).select(*columns)
    edges = local.where(~settled).select(*_ROW)
    whole = Window.partitionBy(*PERSON).orderBy(*time_order())
    joined = _with_neighbours(drop_runs(_dealt(edges, *PERSON), *PERSON), whole)
    return inside.unionByName(joined.select(*columns))


def unknown_directions(badges: DataFrame) -> DataFrame:
    """Rows that are neither `in` nor `out`; they take no part in the sequence."""
    return badges.where(~F.col("direction").isin(*DIRECTIONS))
