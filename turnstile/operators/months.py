"""Months to process, month filters and retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock, text

# Look-back of the weekly run, and months kept per mode.
WEEKLY_LOOK_BACK_DAYS = 10
KEPT_MONTHS = {"Weekly": 13, "Monthly": 12}

# Longest month list that becomes literals of a filter; a longer one stays a broadcast semi join.
MAX_LITERAL_MONTHS = 1_000


def processing_months(
    badges: DataFrame,
    date_list: str = "",
    frequency: str = "Monthly",
    today: dt.date | Column | None = None,
) -> DataFrame:
    """First days of the months to process, as column `date`.

    A given comma list wins. A weekly run takes the months of today and of ten
    days ago, without today's month as long as `badges` has no row of it; any
    other run takes the previous month.
    """
    if date_list.strip():
        one = badges.sparkSession.range(1)
        items = F.filter(text.split_list(F.lit(date_list)), lambda item: item != "")
        return one.select(F.explode(items).alias("date")).select(F.col("date").cast("date"))
    if today is None:
        today = F.current_date()
    elif isinstance(today, dt.date):
        today = F.lit(today)
    current = clock.month_start(today)
    if frequency == "Weekly":
        # One row saying whether the current month has data; reads at most one row of it.
        seen = badges.where(F.col("month") == current).limit(1).agg(F.count("*").alias("n"))
        months = F.array_distinct(
            F.array(clock.month_start(F.date_sub(today, WEEKLY_LOOK_BACK_DAYS)), current)
        )
        listed = seen.select("n", F.explode(months).alias("date"), current.alias("current"))
        return listed.where((F.col("n") > 0) | (F.col("date") != F.col("current"))).select("date")
    return badges.sparkSession.range(1).select(F.add_months(current, -1).alias("date"))


def in_months(df: DataFrame, months: DataFrame, column: str = "Month") -> DataFrame:
    """Rows of the listed months. The list is distinct dates, so it is small by nature."""
    return df.join(_month_list(months, column), column, "left_semi")


def month_literals(months: DataFrame | Iterable[dt.date]) -> list[dt.date] | None:
    """Distinct non-null months of a date list or of the `date` column of a table; None beyond MAX_LITERAL_MONTHS."""
    if isinstance(months, DataFrame):
        rows = months.select("date").where(F.col("date").isNotNull()).distinct().limit(MAX_LITERAL_MONTHS + 1).collect()
        values = {r[0] for r in rows}
    else:
        values = {m for m in months if m is not None}
    return sorted(values) if len(values) <= MAX_LITERAL_MONTHS else None


def in_listed_months(df: DataFrame, months: DataFrame | Iterable[dt.date], column: str = "Month") -> DataFrame:
    """Rows of the listed months, reading only their partitions.

    The list becomes a literal IN filter: on a table partitioned by the month column the planner keeps only the
    listed folders, and on other Parquet input the filter is pushed to the reader. A list longer than
    MAX_LITERAL_MONTHS (months a table holds are few by nature) falls back to the broadcast semi join.
    """
    values = month_literals(months)
    if values is None:
        if not isinstance(months, DataFrame):
            months = df.sparkSession.createDataFrame([(m,) for m in sorted(set(months) - {None})], "date date")
        return in_months(df, months, column)
    return df.where(F.col(column).isin(values))


def retain(df: DataFrame, months: DataFrame, frequency: str, column: str = "Month") -> DataFrame:
    """Rows that outlive a run over `months`.

    Weekly drops the listed months and everything before 13 months ago, monthly
    only what is before 12 months ago, counted from the latest listed month.
    """
    if frequency not in KEPT_MONTHS:
        return df
    latest = months.agg(F.max("date")).scalar()
    too_old = F.col(column) < F.add_months(latest, -KEPT_MONTHS[frequency])
    kept = df.where(~F.coalesce(too_old, F.lit(False)))
    if frequency == "Weekly":
        kept = kept.join(_month_list(months, column), column, "left_anti")
    return kept


def refreshed(df: DataFrame, months: DataFrame, column: str = "Month") -> DataFrame:
    """What a weekly run leaves of rows that already hold the listed months anew: all that is not too old, in one
    filter (`retain` plus the listed months)."""
    latest = months.agg(F.max("date")).scalar()
    too_old = F.col(column) < F.add_months(latest, -KEPT_MONTHS["Weekly"])
    listed = _month_list(months, "listed")
    marked = df.join(listed, df[column] == F.col("listed"), "left")
    return marked.where(~F.coalesce(too_old, F.lit(False)) | F.col("listed").isNotNull()).drop("listed")


def _month_list(months: DataFrame, column: str) -> DataFrame:
    return F.broadcast(months.select(F.col("date").alias(column)).distinct())
