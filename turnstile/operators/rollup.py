"""Roll-ups over groups for the listed months."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.operators.months import in_listed_months
from turnstile.schemas import quality_metrics


Months = DataFrame | Iterable[dt.date]


def quality_rollup(profile: DataFrame, months: Months) -> DataFrame:
    """Sums per facility and month over the listed months; only their partitions are read."""
    sums = [F.sum(f"`{m}`").alias(m) for m in quality_metrics()]
    return in_listed_months(profile, months).groupBy("Facility", "Month").agg(*sums)


def peak_rollup(hourly: DataFrame, months: Months) -> DataFrame:
    """People per facility, month, hour and day over the listed months; only their partitions are read."""
    return (
        in_listed_months(hourly, months)
        .groupBy("Facility", "Month", "Bin_time", "Time_group", "Date")
        .agg(F.sum("eid_ex").alias("eid_ex"), F.sum("eid").alias("eid"))
    )


def peak_totals(hourly: DataFrame) -> DataFrame:
    """People per facility, day and hour over all months."""
    return hourly.groupBy("Facility", "Date", "Bin_time").agg(
        F.sum("eid").alias("eid"), F.sum("eid_ex").alias("eid_ex")
    )
