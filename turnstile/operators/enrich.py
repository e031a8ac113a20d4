"""Attach group and door name to raw badges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.operators.grouping import GROUP_CAPACITY

FIRST_INDEX = 1  # fixed value: batches of index values start here
_SALTS = 4096


def enrich_badges(
    badges: DataFrame,
    groups: DataFrame,
    doors: DataFrame,
    capacity: int = GROUP_CAPACITY,
    first_index: int | None = FIRST_INDEX,
) -> DataFrame:
    """Left joins to the groups on (eid, month) and to the door mapping on rank.

    Only rows with an index value of `first_index` or more take part, as batches run
    over 1..N; None takes all rows. Rows without an id carry a salt that matches
    nothing, which spreads them over the join. The rows of a very frequent id are on
    the outer side, so adaptive execution splits them. Neither side has a hint: Spark
    broadcasts groups or doors if their size allows.
    """
    if first_index is not None:
        badges = badges.where(F.col("index_value") >= first_index)
    wanted = groups.select("eid", "month", "Group", (F.col("count") > capacity).alias("oversized"))
    spread = F.pmod(F.xxhash64("localtimestamp", "index_value", "rank"), F.lit(_SALTS - 1)) + 1
    salted = badges.withColumn("salt", F.when(F.col("eid").isNull(), spread).otherwise(F.lit(0)))
    return (
        salted.join(wanted.withColumn("salt", F.lit(0).cast("bigint")), ["eid", "month", "salt"], "left")
        .withColumn("oversized", F.coalesce("oversized", F.lit(False)))
        .drop("salt")
        .join(doors.select("rank", F.col("Door").alias("door")), "rank", "left")
        .drop("rank")
    )


def month_range(df: DataFrame, month, column: str, first: int, last: int) -> DataFrame:
    """Rows of one month with `column` in first..last; both conditions reach the scan."""
    return df.where((F.col("month") == F.lit(month)) & F.col(column).between(first, last))


def in_batch(df: DataFrame, ranges: DataFrame, column: str, batch: int) -> DataFrame:
    """Rows of one batch in every month; one row per month is broadcast."""
    wanted = ranges.where(F.col("batch") == batch).select("month", "first", "last")
    return (
        df.join(F.broadcast(wanted), "month")
        .where(F.col(column).between(F.col("first"), F.col("last")))
        .drop("first", "last")
    )
