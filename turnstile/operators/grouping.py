"""Balanced groups of people and batch bounds."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.session import ensure_checkpoint_dir

# Swipes a group may hold, and the number of batches.
GROUP_CAPACITY = 250_000
BATCHES = 5

_CHUNK = 10_000


def eid_month_counts(badges: DataFrame) -> DataFrame:
    return badges.groupBy("eid", "month").agg(F.count("*").alias("count"))


def _fill_plan(capacity: int):
    """Fold one month's histogram of swipe counts into group positions per count.

    All people of one count are alike, so a count class is placed by arithmetic:
    `first_fill` of them still fit into the open group, the others fill groups of
    `per_group` each. There are at most about sqrt(2 * swipes) classes in a month.
    """

    def plan(histogram: pd.DataFrame) -> pd.DataFrame:
        histogram = histogram.sort_values("count", ignore_index=True)
        group, used = 1, 0
        placed = []
        for count, people in zip(histogram["count"].tolist(), histogram["people"].tolist()):
            first_fill = min(people, max(capacity - used, 0) // count)
            per_group = max(capacity // count, 1)
            placed.append((group, used, first_fill, per_group))
            rest = people - first_fill
            if rest:
                opened = -(-rest // per_group)
                group += opened
                used = (rest - (opened - 1) * per_group) * count
            else:
                used += first_fill * count
        columns = ["open_group", "open_sum", "first_fill", "per_group"]
        return histogram.drop(columns="people").join(pd.DataFrame(placed, columns=columns))

    return plan


def _checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def balanced_groups(
    counts: DataFrame,
    capacity: int = GROUP_CAPACITY,
    hold: Callable[[DataFrame], DataFrame] = _checkpointed,
) -> DataFrame:
    """Fill groups up to `capacity` swipes, per month in order of (count, eid).

    A person's place follows from the rank within their count class. Ranks are
    counted per range of (month, count, eid) plus the people in earlier ranges, so
    no class needs to fit into one task. Two branches must see the same ranges, so
    `hold` keeps them: by a checkpoint, or by a working table as in the monthly job.
    Missing ids sort last in their class.
    """
    placed = hold(
        counts.repartitionByRange("month", "count", F.col("eid").asc_nulls_last()).withColumn(
            "part", F.spark_partition_id()
        )
    )
    parts = placed.groupBy("month", "count", "part").agg(F.count("*").alias("people"))
    earlier = F.sum("people").over(
        Window.partitionBy("month", "count")
        .orderBy("part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    classes = (
        parts.groupBy("month", "count")
        .agg(F.sum("people").alias("people"))
        .groupBy("month")
        .applyInPandas(
            _fill_plan(capacity),
            "month date, count bigint, open_group bigint, open_sum bigint, "
            "first_fill bigint, per_group bigint",
        )
    )
    slots = (
        parts.withColumn("earlier", F.coalesce(earlier, F.lit(0)))
        .drop("people")
        .join(classes, ["month", "count"])
    )
    rank = F.row_number().over(
        Window.partitionBy("month", "count", "part").orderBy(F.col("eid").asc_nulls_last())
    )
    ranked = placed.withColumn("rank", rank).join(slots, ["month", "count", "part"])

    place = F.col("earlier") + F.col("rank")
    beyond = place - F.col("first_fill") - 1
    fits = place <= F.col("first_fill")
    group = F.when(fits, F.col("open_group")).otherwise(
        F.col("open_group") + 1 + F.call_function("div", beyond, F.col("per_group"))
    )
    running = F.when(fits, F.col("open_sum") + place * F.col("count")).otherwise(
        (beyond % F.col("per_group") + 1) * F.col("count")
    )
    return ranked.select(
        "eid",
        "count",
        running.alias("Cumulative_Sum"),
        group.cast("bigint").alias("Group"),
        "month",
    )


def month_max(df: DataFrame, column: str) -> DataFrame:
    """Largest value per month, without sorting the month."""
    return df.groupBy("month").agg(F.max(column).alias(column))


def batch_bounds(maxima: DataFrame, column: str) -> DataFrame:
    """Last number of each of five batches over 1..N."""
    n = F.col(column)
    step = F.when((n % 5 == 0) | (n % 4 == 0), F.expr(f"`{column}` div 5")).otherwise(
        F.expr(f"`{column}` div 4")
    )

    def bound(k: int) -> Column:
        return F.greatest(step * k if k < BATCHES else n, F.lit(k)).cast("bigint")

    return maxima.select(*[bound(k).alias(f"batch{k}") for k in range(1, BATCHES + 1)], "month")


def batch_ranges(bounds: DataFrame) -> DataFrame:
    """First and last number of every batch; last < first where a batch is empty."""
    rows = [
        F.struct(
            F.lit(k).alias("batch"),
            (F.col(f"batch{k - 1}") + 1 if k > 1 else F.lit(1).cast("bigint")).alias("first"),
            F.col(f"batch{k}").alias("last"),
        )
        for k in range(1, BATCHES + 1)
    ]
    return bounds.select("month", F.inline(F.array(*rows)))


def batch_members(ranges: DataFrame) -> DataFrame:
    """Every number of every batch, unfolded in three steps: no task makes long lists for others."""
    width = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = ranges.where(F.col("first") <= F.col("last")).select("month", "batch", "first", "last")
    for step in (_CHUNK * _CHUNK, _CHUNK):
        end = F.least(F.col("start") + step - 1, F.col("last"))
        rows = (
            rows.withColumn("start", F.explode(F.sequence("first", "last", F.lit(step))))
            .select("month", "batch", F.col("start").alias("first"), end.alias("last"))
            .repartition(width, "month", "first")
        )
    return rows.select("month", "batch", F.explode(F.sequence("first", "last")).alias("number"))
